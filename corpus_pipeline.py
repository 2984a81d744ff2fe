"""A training corpus from raw documents, in five stages; each is written and read again.

quality rules -> near-duplicates -> secrets -> mixing of sources -> tokens. All stages but the
last return the columns of the documents. SQL cannot express the near-duplicate stage, so there
is no ``ORACLE_SQL``; tests compare the run with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import bpe, mixing, near_duplicates, quality_rules, secret_scan
from sluiceway.llm.texts import fresh
from sluiceway.operators import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL: str | None = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose the lines that failed.

    A null text counts as empty and is rejected. Repeated rows are judged alike.
    """
    held, own = _held_back(docs, quality_rules.FIELDS)
    kept = quality_rules.judge(held, "text").where("kept")
    cleaned = kept.withColumn("text", F.col("cleaned")).select(*held.columns)
    return _as_documents(cleaned.withColumnsRenamed(own), docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies stays: the one with the smallest id, nulls last.

    Null texts are equal empty ones. Of repeated rows one stays.
    """
    return near_duplicates.keep_one(docs, "doc_id", "text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes. A null text stays null."""
    (spans,) = fresh(docs, "spans")
    found = secret_scan.find_secrets(docs, "text", out=spans)
    return _as_documents(secret_scan.redact(found, "text", spans), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources come near their target weights.

    A null source is a source of its own; a text without words counts nothing and is taken as
    often as its source's rate says. Rows of one id are drawn alike.
    """
    held, own = _held_back(docs, ("size", *mixing.PLAN, "copies"))
    planned = mixing.plan_mix(held, "doc_id", "text", "source")
    taken = mixing.repeat_rows(planned.select(*held.columns, "copies"), "copies")
    return taken.withColumnsRenamed(own).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text, of every copy; null is empty."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.token_digests(docs.select("doc_id", "lang", "source", "text"), "text", path).drop(
        "text"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicate),
    ("secret_scan", secrets),
    ("mix_sources", mix),
    ("bpe_codec", tokens),
]


def _held_back(docs: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns that an operator would replace under other names, and their own."""
    others = dict(zip(names, fresh(docs, *names), strict=True))
    clashing = {c: others[c] for c in docs.columns if c in others}
    return docs.withColumnsRenamed(clashing), {other: c for c, other in clashing.items()}


def _as_documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` of the new text where there is such a column."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        df = df.withColumn("n_chars", F.length("text").cast(kind))
    return df.select(*docs.columns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents.

    What a stage writes on its way goes with the stage, and its result when the next one's is
    written, so the disk holds two stages' documents at most.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: Scratch | None = None
    for name, step in STAGES[:-1]:
        kept = Scratch(spark, f"pipeline-{name}")
        with Scratch(spark, f"pipeline-{name}-own"):
            docs = kept.stage(step(spark, docs, sf_dir), "documents")
        if before is not None:
            before.release()
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
