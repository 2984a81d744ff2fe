from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway import functions as fn


def evaluate(spark, schema, values, expression):
    """The expression's value for each input value, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    out = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in out]


def test_strip_takes_every_kind_of_white_space(spark):
    values = [" a ", "Yes\r", "\t\n\f\va b\x1c", " 　ü ", "", "   ", None]
    assert evaluate(spark, "string", values, fn.strip) == [
        None if v is None else v.strip() for v in values
    ]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.text(alphabet=st.sampled_from(" \t\r\n\f\v\x1c\x85  　abéß漢"), max_size=8),
        min_size=1,
        max_size=60,
    )
)
def test_strip_agrees_with_python(spark, values):
    assert evaluate(spark, "string", values, fn.strip) == [v.strip() for v in values]


def test_without_prefix_is_case_sensitive(spark):
    values = ["NASAW01", "AW01", "nasAW01", "NAS", None]
    expected = ["AW01", "AW01", "nasAW01", "", None]
    assert evaluate(spark, "string", values, lambda c: fn.without_prefix(c, "NAS")) == expected


def test_code_label(spark):
    labels = {"S": "Single", "M": "Married"}
    out = evaluate(spark, "string", ["S", "M", "s", "", None], lambda c: fn.code_label(c, labels))
    assert out == ["Single", "Married", "n/a", "n/a", "n/a"]
    kept = evaluate(spark, "string", ["S", "x", None], lambda c: fn.code_label(c, labels, c))
    assert kept == ["Single", "x", None]


def test_digits_to_date(spark):
    values = [20101229, 0, 5489, 20101301, 20100230, 20100229, 20120229, 20101200, -1234567,
              99991231, 10000101, 20100431, None]
    expected = [date(2010, 12, 29), None, None, None, None, None, date(2012, 2, 29), None, None,
                date(9999, 12, 31), date(1000, 1, 1), None, None]
    assert evaluate(spark, "int", values, fn.digits_to_date) == expected


def test_digits_to_date_agrees_with_text_parsing(spark):
    days = spark.range(19_990_000, 20_051_300).select(F.col("id").cast("int").alias("v"))
    text = F.col("v").cast("string")
    different = days.where(
        ~fn.digits_to_date(F.col("v")).eqNullSafe(F.try_to_date(text, "yyyyMMdd"))
    )
    assert different.count() == 0


def test_lenient_dates_never_raise(spark):
    values = ["2020-01-03", "0000-00-00", "x", "", None, "2020-01-03 10:00:00"]
    assert evaluate(spark, "string", values, fn.lenient_date) == [
        date(2020, 1, 3), None, None, None, None, date(2020, 1, 3)
    ]
    assert evaluate(spark, "string", values, fn.lenient_timestamp) == [
        datetime(2020, 1, 3), None, None, None, None, datetime(2020, 1, 3, 10)
    ]


def test_not_in_future(spark):
    values = [date(2026, 1, 2), date(2026, 1, 1), date(1970, 1, 1), None]
    for as_of in (date(2026, 1, 1), datetime(2026, 1, 1, 8)):
        out = evaluate(spark, "date", values, lambda c, a=as_of: fn.not_in_future(c, a))
        assert out == [None, date(2026, 1, 1), date(1970, 1, 1), None]
    today = evaluate(spark, "date", [date(2999, 1, 1)], lambda c: fn.not_in_future(c, None))
    assert today == [None]


def test_quotient_cuts_toward_zero(spark):
    df = spark.createDataFrame([(-7, 2), (7, 2), (1, 0), (None, 2)], "a bigint, b bigint")
    out = [r[0] for r in df.select(fn.quotient(F.col("a"), F.col("b"))).collect()]
    assert out == [-3, 3, None, None]


def test_rank_text_orders_like_the_columns(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2011-07-01 00:00:00' AS a, 'BK' AS b")
    assert df.select(fn.rank_text(F.col("a"), F.col("b"))).first()[0] == "2011-07-01 00:00:00_BK"


def test_clip_text_cuts_silently(spark):
    assert evaluate(spark, "string", ["x" * 60, "y", None], fn.clip_text) == ["x" * 50, "y", None]


@pytest.mark.parametrize("given_ts", [None, datetime(2026, 1, 1, 12)])
def test_stamp(spark, given_ts):
    stamped = fn.stamp(spark.range(3), given_ts)
    values = {r["dwh_create_date"] for r in stamped.collect()}
    assert len(values) == 1
    assert given_ts is None or values == {given_ts}
