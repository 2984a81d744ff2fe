"""Nearest neighbours of repeated rows and keys, and recall at a larger size."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from sluiceway.llm import neighbours
from sluiceway.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>"


def _brute(rows, query, k):
    """(key, cosine) of the k nearest other keys, each at its nearest vector."""
    best = {}
    for asked in (v for key, v in rows if key == query):
        for key, v in rows:
            if key != query:
                score = float(np.dot(asked, v) / np.linalg.norm(asked) / np.linalg.norm(v))
                best[key] = max(best.get(key, -2.0), score)
    return sorted(best.items(), key=lambda f: (-round(f[1], 12), f[0]))[:k]


def _found(df, k=5):
    out = defaultdict(list)
    got = neighbours.nearest(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=k)
    for r in got.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("times", [1, 5])
def test_repeated_rows_take_no_places(spark, times):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    # One vector under several keys, and one key with several vectors.
    rows += [(1000 + i, rows[50][1]) for i in range(8)]
    rows += [(100, [2 * x for x in rows[7][1]]), (7, rows[9][1])]
    got = _found(spark.createDataFrame(rows * times, SCHEMA))
    assert set(got) == {i for i, _ in rows if i % 50 == 0}
    for query, found in got.items():
        wanted = _brute(rows, query, 5)
        assert [key for key, _ in found] == [key for key, _ in wanted]
        assert [s for _, s in found] == pytest.approx([s for _, s in wanted])


def test_a_key_ten_times_leaves_room_for_another(spark):
    rows = [(0, [1.0, 0.0])] + [(7, [1.0, 0.1])] * 10 + [(8, [1.0, 0.1])]
    got = _found(spark.createDataFrame(rows, SCHEMA))
    assert [key for key, _ in got[0]] == [7, 8]


def test_recall_at_the_next_size(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
            if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()
            and np.any(r.embedding)]
    got = defaultdict(set)
    for r in QUERIES["op1_nearest"](spark, sf_dir).collect():
        got[r.query_id].add(r.vec_id)
    keys = np.array([key for key, _ in rows])
    vectors = np.array([v for _, v in rows])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    asked = np.flatnonzero(keys % 50 == 0)
    hits = 0
    for at in asked:
        score = vectors @ vectors[at]
        score[keys == keys[at]] = -2
        hits += len(got[keys[at]] & set(keys[np.lexsort((keys, -score))[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(asked)
