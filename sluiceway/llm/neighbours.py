"""Approximate nearest neighbours: stable projections, kd-trees and a chi-square stopping test.

Vectors of length one are projected to ``DIMENSIONS`` directions drawn from the normal
distribution, which is 2-stable: the squared projected distance of a pair, divided by its
squared true distance, is chi-square distributed. So once the projected distance of the next
candidate exceeds the distance of the k-th best by more than the test's quantile allows, a
better neighbour would have a projection too unlikely to occur, and the search stops.

The projected space is cut by the upper levels of one kd-tree, fitted on a bounded sample, into
cells; every vector is indexed in its cell, and a large cell is dealt into several blocks. A
query first searches one block of its own cell, which bounds its k-th distance, then visits
just those cells whose boxes the test does not exclude. Within a block a kd-tree yields the
projected neighbours in growing distance, and they are verified on the original vectors until
the test holds.

Cosine order equals the order of distances between vectors of length one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.texts import bounded_batches, quoted
from sluiceway.operators import stage

#: Directions of projection.
DIMENSIONS = 8
#: Least probability that a neighbour at the distance of the k-th best passes the test.
CONFIDENCE = 0.99
#: Vectors on which the cells are fitted, at most; cells; vectors of a block; queries at a time.
SAMPLE = 8192
CELLS = 64
BLOCK = 8192
QUERIES = 2048
#: Vectors of a leaf of a block's tree.
_LEAF = 256
_SLACK = 1e-9


def chi_square_quantile(probability: float, freedom: int) -> float:
    """The quantile, for even degrees of freedom, by bisection of the closed distribution."""
    half, low, high = freedom // 2, 0.0, 1e3

    def cumulative(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, half):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cumulative(middle) < probability else (low, middle)
    return high


def directions(dim: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, DIMENSIONS))


class Tree:
    """A kd-tree over points; inner nodes split the widest side at its median."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self.cuts: list[tuple[int, float]] = []
        self._points = points
        if len(points):
            self._add(np.arange(len(points)), leaf)

    def _add(self, rows: np.ndarray, leaf: int) -> int:
        own = self._points[rows]
        node = len(self.rows)
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(rows)
        axis = int(np.argmax(high - low))
        cut = float(np.median(own[:, axis]))
        self.cuts.append((axis, cut))
        below = own[:, axis] < cut
        if len(rows) > leaf and below.any():
            left = self._add(rows[below], leaf)
            right = self._add(rows[~below], leaf)
            self.children[node] = (left, right)
            self.rows[node] = rows[:0]
        return node

    def leaves_from(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Rows of leaves by growing distance of their boxes, with that distance squared."""
        if not self.rows:
            return
        heap = [(self._distance(0, point), 0)]
        while heap:
            distance, node = heapq.heappop(heap)
            if self.children[node] is None:
                yield distance, self.rows[node]
                continue
            for child in self.children[node]:
                heapq.heappush(heap, (self._distance(child, point), child))

    def _distance(self, node: int, point: np.ndarray) -> float:
        gap = np.maximum(0.0, np.maximum(self.low[node] - point, point - self.high[node]))
        return float(gap @ gap)


class Cells:
    """The upper levels of a kd-tree over the projected space; every point has a cell."""

    def __init__(self, points: np.ndarray, cells: int):
        self._tree = Tree(points, max(1, -(-len(points) // cells)))
        leaves = [i for i, c in enumerate(self._tree.children) if c is None]
        self._number = {node: i for i, node in enumerate(leaves)}
        self.count = max(1, len(leaves))

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        if not self._tree.rows:
            return out
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if self._tree.children[node] is None:
                out[rows] = self._number[node]
                continue
            axis, cut = self._tree.cuts[node]
            below = points[rows, axis] < cut
            left, right = self._tree.children[node]
            waiting += [(left, rows[below]), (right, rows[~below])]
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, the same value for equal rows wherever they stand."""
    products = (rows * query).sum(axis=1)
    return products / (np.sqrt((rows * rows).sum(axis=1)) * math.sqrt(float((query * query).sum())))


def _different(found: list[tuple[float, int]]) -> list[tuple[float, int]]:
    """The first of each key: a key with several vectors counts once, at its nearest."""
    seen: set[int] = set()
    return [f for f in found if not (f[1] in seen or seen.add(f[1]))]


def search_block(
    ids: list[list[int]], vectors: np.ndarray, tree: Tree, projected: np.ndarray,
    own: int, query: np.ndarray, bound: float, k: int, quantile: float,
) -> list[tuple[float, int]]:
    """The k best (score, id) of a block for one query, itself left out.

    ``bound`` is a squared distance between unit vectors within which k others are known.
    """
    best: list[tuple[float, int]] = []
    worst = bound
    for reach, rows in tree.leaves_from(projected):
        # The test: could a vector nearer than the k-th best have so large a projection?
        if reach > worst * quantile + _SLACK:
            break
        scores = cosine(query, vectors[rows])
        least = 1 - worst / 2 - _SLACK
        for row, score in zip(rows, scores):
            if score >= least:
                best += [(-float(score), i) for i in ids[row] if i != own]
        best = _different(sorted(best))[:k]
        if len(best) == k:
            worst = min(worst, max(0.0, 2 + 2 * best[-1][0]))
    return [(-score, i) for score, i in best]


_INDEXED = "members array<long>, embedding array<double>, cell int, place array<double>"


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    df: DataFrame, key: str, vector: str, is_query: Column, k: int = 5, seed: int = 5
) -> DataFrame:
    """The ``k`` nearest other rows of every query: ``query_id, rank, <key>, score``.

    ``is_query`` is a condition on the columns of ``df``. Nearness is the cosine, in double
    precision, ties to the smaller key. Rows whose key or vector is null, whose vector is zero,
    has no or a null or non-finite component, or a length other than the most frequent one,
    take no part. A key is one candidate, at its nearest vector, however often it occurs, and none for
    its own query. An empty table, or one without queries, gives an empty table.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    rows = df.select(
        F.col(quoted(key)).cast("long").alias("id"),
        F.col(quoted(vector)).cast("array<double>").alias("embedding"),
        is_query.alias("asks"),
    ).where(F.col("id").isNotNull() & _usable(F.col("embedding")))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").head()
    dim = length["n"] if length else 1
    rows = rows.where(F.size("embedding") == dim)

    # Equal vectors become one point with its k + 1 smallest keys: no other key of them can be
    # among the k nearest of any query. Repeated rows are one before that, or they would take
    # the places of other keys. The rank limit applies within each task already.
    same = Window.partitionBy("embedding").orderBy("id")
    smallest = rows.select("id", "embedding").distinct().withColumn("_r", F.row_number().over(same))
    points = stage(
        smallest.where(F.col("_r") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("id")).alias("members")),
        "points",
    )
    turn = directions(dim, seed)
    drawn = points.orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).select("embedding")
    sample = np.array([r[0] for r in drawn.collect()]).reshape(-1, dim)
    cells = Cells(_unit(sample) @ turn if len(sample) else sample[:, :0], CELLS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            projected = _unit(flat.reshape(-1, dim)) @ turn
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("members"),
                    batch.column("embedding"),
                    pa.array(cells.of(projected), pa.int32()),
                    pa.array(list(projected), pa.list_(pa.float64())),
                ],
                names=["members", "embedding", "cell", "place"],
            )

    indexed = stage(points.select("members", "embedding").mapInArrow(place, _INDEXED), "indexed")
    bounds = indexed.groupBy("cell").agg(
        F.count("*").alias("n"),
        *[F.min(F.col("place")[i]).alias(f"low{i}") for i in range(DIMENSIONS)],
        *[F.max(F.col("place")[i]).alias(f"high{i}") for i in range(DIMENSIONS)],
    )
    # At most CELLS rows.
    boxes = sorted(bounds.collect(), key=lambda r: r["cell"])
    blocks = {r["cell"]: -(-r["n"] // BLOCK) for r in boxes}
    per_cell = F.create_map(*[F.lit(x) for pair in (blocks or {0: 1}).items() for x in pair])
    block = F.pmod(F.xxhash64("embedding"), F.element_at(per_cell, F.col("cell"))).cast("int")
    placed = stage(indexed.withColumn("block", block), "blocks")

    asking = rows.where("asks").select(F.col("id").alias("query_id"), "embedding").distinct()
    queries = stage(
        asking.join(placed.select("embedding", "cell", "block", "place"), "embedding"), "queries"
    )
    quantile = chi_square_quantile(CONFIDENCE, DIMENSIONS)
    first = stage(
        _searched(queries.withColumn("bound", F.lit(4.0)), placed, k, quantile), "first"
    )
    # Squared distance of the k-th best so far; without k of them every distance is possible.
    reached = first.groupBy("query_id", "embedding").agg(
        F.when(F.count("*") >= k, 2 - 2 * F.min("score")).otherwise(4.0).alias("found")
    )
    bounded = queries.join(reached, ["query_id", "embedding"], "left").withColumn(
        "bound", F.greatest(F.lit(0.0), F.coalesce("found", F.lit(4.0)))
    )
    low = np.array([[r[f"low{i}"] for i in range(DIMENSIONS)] for r in boxes])
    high = np.array([[r[f"high{i}"] for i in range(DIMENSIONS)] for r in boxes])
    numbers = [r["cell"] for r in boxes]
    visited = "query_id long, embedding array<double>, place array<double>, bound double, cell int, block int"

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for q in batch.to_pylist():
                gap = np.maximum(0.0, np.maximum(low - q["place"], np.array(q["place"]) - high))
                near = np.flatnonzero((gap * gap).sum(axis=1) <= q["bound"] * quantile + _SLACK)
                home = (q.pop("cell"), q.pop("block"))
                for cell in (numbers[i] for i in near):
                    for b in range(blocks[cell]):
                        if (cell, b) != home:
                            out.append(q | {"cell": cell, "block": b})
            for begin in range(0, len(out), 4096):
                yield pa.RecordBatch.from_pylist(out[begin : begin + 4096], schema=_VISIT)

    asked = bounded.select("query_id", "embedding", "place", "bound", "cell", "block")
    second = _searched(asked.mapInArrow(visits, visited), placed, k, quantile)
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    both = first.unionByName(second).groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = both.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")


_VISIT = pa.schema(
    [("query_id", pa.int64()), ("embedding", pa.list_(pa.float64())),
     ("place", pa.list_(pa.float64())), ("bound", pa.float64()), ("cell", pa.int32()),
     ("block", pa.int32())]
)
_FOUND = pa.schema(
    [("query_id", pa.int64()), ("embedding", pa.list_(pa.float64())), ("id", pa.int64()),
     ("score", pa.float64())]
)


def _searched(asked: DataFrame, placed: DataFrame, k: int, quantile: float) -> DataFrame:
    """Search the block named by each row of ``asked``.

    A group holds one block and at most about ``QUERIES`` of the queries that visit it: a block
    with more of them is repeated, once for each share.
    """
    asked = stage(
        asked.select("query_id", "embedding", "place", "bound", "cell", "block"), "asked"
    )
    shares = asked.groupBy("cell", "block").agg(
        F.ceil(F.count("*") / QUERIES).cast("int").alias("shares")
    )
    dealt = asked.join(shares, ["cell", "block"]).select(
        *asked.columns, F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int").alias("share")
    )
    copies = shares.toDF("cell", "block", "copies")
    repeated = placed.join(copies, ["cell", "block"]).select(
        *placed.columns, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("share")
    )
    group = ["cell", "block", "share"]

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if block.num_rows and queries.num_rows:
            ids = block.column("members").to_pylist()
            vectors = np.array(block.column("embedding").to_pylist())
            tree = Tree(np.array(block.column("place").to_pylist()), _LEAF)
            for q in queries.to_pylist():
                found = search_block(
                    ids, vectors, tree, np.array(q["place"]), q["query_id"],
                    np.array(q["embedding"]), q["bound"], k, quantile,
                )
                out += [
                    {"query_id": q["query_id"], "embedding": q["embedding"], "id": i, "score": s}
                    for s, i in found
                ]
        return pa.Table.from_pylist(out, schema=_FOUND)

    return (
        repeated.groupBy(*group)
        .cogroup(dealt.groupBy(*group))
        .applyInArrow(search, "query_id long, embedding array<double>, id long, score double")
    )
