"""Columns named like an operator's own, in every operator and stage; the filter on judged rows."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluiceway.llm import (
    bpe,
    language_crf,
    mixing,
    near_duplicates,
    pii,
    quality_rules,
    secret_scan,
    token_counts,
    toxicity,
)
import public_tokenizers

# Names that operators use, or used, for themselves; with an underscore more they still clash.
NAMES = (
    "text_result n words lines text windows repeat judged found sorted left id row size copy source"
    " key same_text own_key this_text weight place limit draw by spans class label value h rank"
).split()
INTERNAL = [f"_{n}" for n in NAMES] + [f"__{n}" for n in NAMES[:8]] + ["line", "at", "here"]
OUTPUTS = ["copies", "size", "rate", "target", "source_size", "n_words", "kept", "cleaned", "rows"]

TEXT = "A plain sentence with quite enough words to stay in the corpus as it is, number {}."


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [
        (i, None if i == 5 else TEXT.format("x" * i + str(i)), "en", "s", *[7] * len(INTERNAL))
        for i in range(6)
    ]
    columns = ", ".join(f"`{n}` int" for n in INTERNAL)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {columns}")


OPERATORS = {
    "op4": lambda df: token_counts.count_tokens(
        df, "text", public_tokenizers.path("byte_bpe_50k.json"), limit=512
    ),
    "op5": lambda df: pii.find_personal_data(df, "text", out="out"),
    "op6": lambda df: bpe.token_digests(df, "text", public_tokenizers.path("word_bpe_49k.json")),
    "op7": lambda df: toxicity.score_toxicity(
        df, "text", toxicity.fit_toxicity(df, df.select("doc_id", F.lit(1).alias("t")), "doc_id", "text", "t")
    ),
    "op8": lambda df: quality_rules.judge(df, "text"),
    "op9": lambda df: mixing.plan_mix(df, "doc_id", "text", "source"),
    "op9 repeated": lambda df: mixing.repeat_rows(df.withColumn("times", F.lit(1)), "times"),
    "op2": lambda df: near_duplicates.keep_one(df, "doc_id", "text"),
    "op10": lambda df: secret_scan.find_secrets(df, "text", out="out"),
    "op12": lambda df: language_crf.identify(
        df, "text", language_crf.fit_languages(df, "text", "lang")
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_stay_as_they_are(clashing, name):
    got = OPERATORS[name](clashing)
    assert set(INTERNAL) <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    found = got.select("doc_id", *[f"`{n}`" for n in INTERNAL]).collect()
    assert found and all(set(r[1:]) == {7} for r in found)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_named_like_results(spark, clashing, stage):
    named = clashing.select("*", *[F.lit(9).alias(n) for n in OUTPUTS])
    got = stage[1](spark, named, "")
    assert got.columns == named.columns
    rows = got.collect()
    assert rows and all(r[n] == 9 for r in rows for n in OUTPUTS)
    assert all(r[n] == 7 for r in rows for n in INTERNAL)


@pytest.mark.parametrize("column", quality_rules.FIELDS)
def test_filters_on_judged_columns_do_not_repeat_the_work(spark, column):
    """A filter pushed below the named steps once made the time grow with the cube of the text."""
    text = " ".join(f"word{i % 1500}" for i in range(5000)) + ".\n" + TEXT * 3
    df = spark.createDataFrame([(1, text)], "id long, text string")
    begin = time.perf_counter()
    rows = quality_rules.judge(df, "text").where(F.col(column).isNotNull()).collect()
    assert len(rows) == 1 and time.perf_counter() - begin < 20
