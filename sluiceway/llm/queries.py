"""One query per operator over the driver's whole tables, with the expected SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import (
    bpe,
    conversation_repair,
    language_crf,
    mixing,
    near_duplicates,
    neighbours,
    pii,
    prefix_trie,
    quality_rules,
    secret_scan,
    token_counts,
    toxicity,
    warc,
)
from sluiceway.operators.staging import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classify(table(spark, sf_dir, "documents"), "doc_id", "text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark)}/warc-{uuid4().hex}"
    pages = table(spark, sf_dir, "pages")
    manifest = warc.write_archive(warc.describe(pages, "page_id", "url", "html"), folder)
    read = warc.read_archive(manifest, folder, payloads=False)
    return read.drop("payload", "url")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(docs, "text", path, limit=512).drop("text")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, "text", out="found").drop("text")
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[_count("found", kind) for kind in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("found")).alias("spans"),
        pii.scores(F.col("found")).alias("scores"),
    )


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.token_digests(docs, "text", path).drop("text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    held_out = crc % 5 == 0
    machine = toxicity.fit_toxicity(docs, labels.where(~held_out), "doc_id", "text", "toxic")
    scored = toxicity.score_toxicity(docs, "text", machine)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, "text").drop("text", "cleaned")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    planned = mixing.plan_mix(docs, "doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken, "copies")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, "text", out="found").drop("text")
    base = F.filter("found", lambda s: s["kind"].isin(*secret_scan.KINDS))
    return found.select(
        "doc_id",
        *[_count("found", kind) for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("found")).alias("spans"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("conv_id", "turn", "role", "text")
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"), *columns)
    return conversation_repair.repair(damaged, *columns, present=F.col("present"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    held_out = crc % 4 == 2
    field = language_crf.fit_languages(docs.where(~held_out), "text", "lang")
    found = language_crf.identify(docs.select("doc_id", "text"), "text", field)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    rebuilt = prefix_trie.shared_openings(talks, "conv_id", "turn", "role", "text")
    return prefix_trie.trie_nodes(rebuilt)


QUERIES: dict[str, Query] = {
    "op1_nearest": op1_nearest,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_warc": op3_warc,
    "op4_token_counts": op4_token_counts,
    "op5_pii": op5_pii,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_language_id": op12_language_id,
    "op13_prefix_trie": op13_prefix_trie,
}
