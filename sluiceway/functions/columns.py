"""Column -> Column building blocks of the cleaners and the dimension builders.

Everything here is a built-in Spark expression, so each transform stays inside
whole-stage code generation. ANSI mode raises on bad casts, hence ``try_*`` on
anything that comes from a source system.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.schemas import AUDIT_COLUMN, VARCHAR_LIMIT

MISSING = "n/a"

# Every character Unicode calls white space; the last one is U+3000. Spark's
# plain ``trim`` removes only the space character and would leave ``\r`` behind.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())


def strip(c: Column) -> Column:
    """Trim white space of any kind from both ends.

    Text of single-byte characters only, the usual case, is compared with the short
    list, which is about four times faster.
    """
    return F.when(
        F.octet_length(c) == F.char_length(c), F.btrim(c, F.lit(_ASCII_WHITESPACE))
    ).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def without_prefix(c: Column, prefix: str) -> Column:
    """Drop a case-sensitive leading marker, otherwise leave the value alone."""
    rest = c.substr(F.lit(len(prefix) + 1), F.length(c))
    return F.when(c.startswith(prefix), rest).otherwise(c)


def code_label(code: Column, labels: Mapping[str, str], default: Column | str = MISSING) -> Column:
    """Translate exact codes; every other value, null included, takes ``default``."""
    first, *others = labels.items()
    chain = F.when(code == first[0], first[1])
    for key, label in others:
        chain = chain.when(code == key, label)
    return chain.otherwise(F.lit(default) if isinstance(default, str) else default)


def fallback_label(primary: Column, secondary: Column) -> Column:
    """The master value unless it is missing, then the other source, then ``n/a``."""
    return F.when(primary != MISSING, primary).otherwise(F.coalesce(secondary, F.lit(MISSING)))


def lenient_date(c: Column) -> Column:
    return c.try_cast("date")


def lenient_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def digits_to_date(c: Column) -> Column:
    """Decode ``YYYYMMDD`` numbers; anything that is not a calendar date is null.

    Eight digits are split by arithmetic, which costs about an eighth of parsing text.
    The inner guard keeps ``make_date`` from ever seeing an impossible month.
    """
    number = c.try_cast("int")
    year, month, day = (
        F.call_function("div", number, F.lit(10_000)).cast("int"),
        F.call_function("div", number % 10_000, F.lit(100)).cast("int"),
        number % 100,
    )
    month_start = F.when(
        number.between(10_000_000, 99_999_999) & month.between(1, 12),
        F.make_date(year, month, F.lit(1)),
    )
    return F.when(
        day.between(1, F.dayofmonth(F.last_day(month_start))), F.date_add(month_start, day - 1)
    )


def not_in_future(c: Column, as_of: date | datetime | None) -> Column:
    """Null out dates after ``as_of`` (the run's own day when not given)."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.when(c <= today, c)


def quotient(dividend: Column, divisor: Column) -> Column:
    """Whole-number quotient, cut toward zero. Null for a zero divisor."""
    return F.call_function("div", dividend, F.nullif(divisor, F.lit(0)))


def repaired_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Trust the amount only if it is positive and agrees with |price| x quantity."""
    expected = F.abs(price) * quantity
    return F.when(
        sales.isNull() | (sales <= 0) | (sales != expected), expected
    ).otherwise(sales)


def repaired_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Derive a missing or non-positive price from an already repaired amount."""
    return F.when(
        (price.isNull() | (price <= 0)) & (quantity != 0), quotient(sales, quantity)
    ).otherwise(price)


def rank_text(start: Column, key: Column) -> Column:
    """``"<timestamp>_<key>"``, the text form of the product ordering; null if either is."""
    text = F.date_format(start, "yyyy-MM-dd HH:mm:ss")
    return F.when(start.isNotNull() & key.isNotNull(), F.concat_ws("_", text, key))


def clip_text(c: Column, limit: int = VARCHAR_LIMIT) -> Column:
    """What an explicit ``VARCHAR(n)`` cast does; Spark's own cast keeps the full text."""
    return F.left(c.cast("string"), F.lit(limit))


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to exactly ``schema``: its columns, its order, its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def stamp(df: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """Append the audit column: one value for the whole run."""
    value = F.current_timestamp() if batch_ts is None else F.lit(batch_ts).cast("timestamp")
    return df.withColumn(AUDIT_COLUMN, value)
