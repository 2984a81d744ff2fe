"""Connected components of a graph of links, by hooking to smaller neighbours and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.operators import Scratch


def components(links: DataFrame, scratch: Scratch, known: DataFrame | None = None) -> DataFrame:
    """``id`` and ``class`` (smallest id of its component) for every end of a link (a, b).

    A link of a node with itself counts for nothing.
    ``known`` are the classes of other links, as this function gives them: they are carried on,
    so only what ``links`` add is worked on, and their ids are listed too.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the hooks
    to their ends, and puts these in the place of the nodes. Links within one tree of hooks
    vanish and equal ones become one, so a link is joined once and not in every round: a group
    of copies is one node after the first. At least half of the linked nodes go in a round, so
    their number grows with the logarithm of the nodes. Links and labels are written each round,
    so the plan stays short and a lost executor costs one round. A node with very many links is
    only ever the key of a plain join of two written tables, which adaptive execution splits.
    """
    edges = scratch.stage(_ordered(links), "edges")
    if known is not None:
        edges = _contracted(edges, known, scratch)
    found = known
    while found is None or not edges.isEmpty():
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("other"))
        roots = _followed(
            scratch.stage(hooks.select("id", F.least("id", "other").alias("class")), "hooks"),
            scratch,
        )
        found = roots if found is None else _moved(found, roots, scratch)
        edges = _contracted(edges, roots, scratch)
    return found


def _ordered(links: DataFrame) -> DataFrame:
    """Different links, their smaller end first; none of a node with itself."""
    return (
        links.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _followed(hooks: DataFrame, scratch: Scratch) -> DataFrame:
    """The end of every node's chain of hooks; a pass halves what is left of a chain."""
    while True:
        onward = hooks.select(F.col("id").alias("_id"), F.col("class").alias("_class"))
        passed = scratch.stage(hooks.join(onward, hooks["class"] == onward["_id"]), "followed")
        hooks = passed.select("id", F.col("_class").alias("class"))
        if passed.where("class != _class").isEmpty():
            return hooks


def _contracted(edges: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The links between different labels; an end that has none stands for itself."""
    for end, other in (("a", "b"), ("b", "a")):
        edges = scratch.stage(
            edges.join(labels, edges[end] == labels["id"], "left")
            .select(F.coalesce("class", end).alias(end), other)
            .where("a != b")
            .distinct(),
            "half-edges",
        )
    return scratch.stage(_ordered(edges), "edges")


def _moved(found: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """Classes after those in ``roots`` have got new ones, and the nodes that had none."""
    new = roots.select(F.col("id").alias("_id"), F.col("class").alias("_class"))
    old = found.join(new, found["class"] == new["_id"], "left").select(
        "id", F.coalesce("_class", "class").alias("class")
    )
    return scratch.stage(old.union(roots.join(found, "id", "left_anti")), "classes")
