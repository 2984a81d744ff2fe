"""A prefix trie over conversations, packed into double arrays shard by shard.

A node is a sequence of first turns (role and text) that at least one conversation starts with.

1. A sorted stream cuts every conversation into segments of at most 64 turns, each with a digest
   of all turns before it, and notes the digest of the whole. Texts stay where they are: only the
   digest and the length of a turn travel.
2. Equal segments collapse before they are shuffled, so copies cost one row a task.
3. Segments with the same digest before them and the same first turns form a shard. A shard with
   too many turns is split by twice as many first turns, again and again, so none is too large
   for a task, whatever a popular opening draws.
4. In a shard, turns get dense ids, the segments are packed into arrays BASE and CHECK, and a walk
   along each segment adds its conversations to the nodes it meets. Nodes from the shard's own
   prefix down are complete there, with the sums of their subtrees.
5. Nodes above, met in several shards, are merged by their digest. They and the shards hang in a
   small tree, whose sums are taken by pointer doubling: a few rounds, however deep it is. The
   same sums are handed down into shards whose conversations go on in a further segment.

No step holds a whole conversation, or all that follows a popular turn, in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.texts import quoted
from sluiceway.operators import stage

#: Turns of a segment, and turns (of different segments) that a shard may hold.
SEGMENT = 64
SHARD_TURNS = 200_000

NODE = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)

_ROOT = hashlib.blake2b(b"root", digest_size=16).digest()
_EMPTY = hashlib.sha256(b"").hexdigest()
# Places a node with several children tries before it goes behind the last one taken.
_TRIES = 32


def _below(node: bytes, item: bytes) -> bytes:
    """Digest of the sequence that ends with one more turn."""
    return hashlib.blake2b(node + item, digest_size=16).digest()


class DoubleArray:
    """A trie over sequences of ids from 1: child c of state s is t = BASE[s] + c, CHECK[t] = s.

    State 0 is the root; ``order`` has the others, parents before children.
    """

    def __init__(self, sequences: list[tuple[int, ...]]):
        """Pack sorted, different sequences."""
        self.base, self.check, self.order = [0], [0], []
        self._free = 1
        level = [(0, 0, len(sequences))]
        depth = 0
        while level:
            below = []
            for state, begin, end in level:
                at, children = begin, []
                while at < end:
                    if len(sequences[at]) <= depth:
                        at += 1
                        continue
                    code, first = sequences[at][depth], at
                    while at < end and sequences[at][depth] == code:
                        at += 1
                    children.append((code, first, at))
                if children:
                    self._place(state, [c for c, _, _ in children])
                    for code, first, after in children:
                        child = self.base[state] + code
                        self.order.append(child)
                        below.append((child, first, after))
            level, depth = below, depth + 1

    def _place(self, state: int, codes: list[int]) -> None:
        check = self.check
        while self._free < len(check) and check[self._free] >= 0:
            self._free += 1
        slot, base = self._free, None
        for _ in range(_TRIES):
            if all(
                slot + c - codes[0] >= len(check) or check[slot + c - codes[0]] < 0
                for c in codes
            ):
                base = slot - codes[0]
                break
            slot += 1
            while slot < len(check) and check[slot] >= 0:
                slot += 1
        if base is None:
            base = len(check) - codes[0]
        short = base + codes[-1] + 1 - len(check)
        if short > 0:
            check.extend([-1] * short)
            self.base.extend([0] * short)
        self.base[state] = base
        for c in codes:
            check[base + c] = state

    def child(self, state: int, code: int) -> int | None:
        """The state after one more id, or None."""
        at = self.base[state] + code
        found = 0 < at < len(self.check) and self.check[at] == state
        return at if found else None


_SEGMENTS = (
    "conv_id long, block long, prefix binary, items array<binary>, chars array<long>,"
    " ends boolean, last binary"
)
_SEGMENTS_TYPE = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("prefix", pa.binary()),
     ("items", pa.list_(pa.binary())), ("chars", pa.list_(pa.int64())), ("ends", pa.bool_()),
     ("last", pa.binary())]
)


def _segments(turns: DataFrame, size: int) -> DataFrame:
    """Segments of every conversation; the last one has the digest of all its turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        current, open_ = None, False
        block, prefix, node, items, chars = 0, _ROOT, _ROOT, [], []

        def sent() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            ready.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SEGMENTS_TYPE, strict=True)],
                schema=_SEGMENTS_TYPE,
            )

        for batch in batches:
            for conv, item, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not open_ or conv != current:
                    if open_:
                        ready.append((current, block, prefix, items, chars, True, node))
                    current, open_ = conv, True
                    block, prefix, node, items, chars = 0, _ROOT, _ROOT, [], []
                if item is not None:
                    # A full segment goes out only when a further turn shows that it is not the last.
                    if len(items) == size:
                        ready.append((current, block, prefix, items, chars, False, None))
                        block, prefix, items, chars = block + 1, node, [], []
                    node = _below(node, item)
                    items.append(item)
                    chars.append(n)
                if len(ready) >= 1000:
                    yield sent()
        if open_:
            ready.append((current, block, prefix, items, chars, True, node))
        if ready:
            yield sent()

    return turns.mapInArrow(run, _SEGMENTS)


_NODES = (
    "node binary, parent binary, unit binary, depth long, n_convs long, conv_id long,"
    " parent_conv_id long, chars long, owned boolean, top boolean, goes_on boolean,"
    " n_children long, n_leaves long, saved long, up array<binary>"
)
_NODES_TYPE = pa.schema(
    [("node", pa.binary()), ("parent", pa.binary()), ("unit", pa.binary()), ("depth", pa.int64()),
     ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
     ("chars", pa.int64()), ("owned", pa.bool_()), ("top", pa.bool_()), ("goes_on", pa.bool_()),
     ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
     ("up", pa.list_(pa.binary()))]
)


def _shard_nodes(
    prefix: bytes, block: int, split: int, size: int, segments: list[tuple]
) -> list[tuple]:
    """Nodes of a shard; ``segments`` are (items, chars, ends, n, conv_id), items may repeat.

    Nodes of at least ``split`` turns below the prefix are owned: all their conversations are here.
    """
    different = sorted({item for segment in segments for item in segment[0]})
    ids = {item: at + 1 for at, item in enumerate(different)}
    coded = [(tuple(ids[item] for item in segment[0]), segment) for segment in segments]
    trie = DoubleArray(sorted({codes for codes, _ in coded}))
    n = len(trie.check)
    convs, least, depth = np.zeros(n, np.int64), [None] * n, [0] * n
    chars, goes_on, digest = np.zeros(n, np.int64), np.zeros(n, bool), [b""] * n
    item_of: list[bytes] = [b""] * n
    for codes, (_, lengths, ends, count, conv) in coded:
        state = 0
        for code, length in zip(codes, lengths, strict=True):
            state = trie.child(state, code)
            convs[state] += count
            chars[state] = length
            item_of[state] = different[code - 1]
            if least[state] is None or conv < least[state]:
                least[state] = conv
        if not ends:
            goes_on[state] = True
    digest[0] = prefix
    for state in trie.order:
        parent = trie.check[state]
        depth[state] = depth[parent] + 1
        digest[state] = _below(digest[parent], item_of[state])
    children, leaves = np.zeros(n, np.int64), np.zeros(n, np.int64)
    saved = (convs - 1) * chars
    for state in reversed(trie.order):
        parent = trie.check[state]
        if not children[state] and not goes_on[state]:
            leaves[state] = 1
        children[parent] += 1
        if parent:
            leaves[parent] += leaves[state]
            saved[parent] += saved[state]
    rows, top = [], None
    for state in trie.order:
        parent, owned = trie.check[state], depth[state] >= split
        if depth[state] == split:
            top = digest[state]
        up = None
        if owned and depth[state] == size:
            up, at = [], state
            while at and depth[at] >= split:
                up.append(digest[at])
                at = trie.check[at]
        rows.append(
            (digest[state], digest[parent], top if owned else digest[state],
             block * size + depth[state], int(convs[state]), least[state],
             least[parent] if depth[state] > split else None, int(chars[state]), owned,
             depth[state] == split, bool(goes_on[state]),
             *((int(children[state]), int(leaves[state]), int(saved[state])) if owned
               else (None, None, None)),
             up)
        )
    return rows


def _packed(segments: DataFrame, size: int) -> DataFrame:
    """Nodes of all shards; ``segments`` are dealt and sorted by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def sent(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(rows), 10_000):
                columns = zip(*rows[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _NODES_TYPE, strict=True)],
                    schema=_NODES_TYPE,
                )

        ready: list[tuple] = []
        for batch in batches:
            for shard, prefix, block, split, *segment in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                key = (shard, prefix, block, split)
                if key != current:
                    if held:
                        ready += _shard_nodes(*current[1:], size, held)
                    if len(ready) >= 10_000:
                        yield from sent(ready)
                        ready = []
                    current, held = key, []
                held.append(tuple(segment))
        if held:
            ready += _shard_nodes(*current[1:], size, held)
        yield from sent(ready)

    return segments.mapInArrow(run, _NODES)


def _split(segments: DataFrame, size: int, most: int) -> DataFrame:
    """Segments with ``split``, the number of first turns that make a shard of at most ``most``.

    Every pass looks at all segments of the shards that are still too large; a shard of whole
    segments is one segment, so the doubling ends.
    """
    placed, split = segments.withColumn("split", F.lit(1).cast("long")), 1
    key = F.array_join(F.transform(F.expr("slice(items, 1, int(split))"), F.hex), "")
    while split < size:
        open_ = placed.where(F.col("split") == split).groupBy("prefix", key.alias("opening"))
        large = stage(
            open_.agg(F.sum(F.size("items")).alias("n")).where(F.col("n") > most).select(
                F.col("prefix").alias("_prefix"), F.col("opening").alias("_opening")
            ),
            "trie-large",
        )
        if large.isEmpty():
            break
        hit = (
            (F.col("prefix") == F.col("_prefix"))
            & (key == F.col("_opening"))
            & (F.col("split") == split)
        )
        split = min(2 * split, size)
        wider = F.when(F.col("_prefix").isNotNull(), F.lit(split)).otherwise(F.col("split"))
        placed = (
            placed.join(large, hit, "left")
            .withColumn("split", wider.cast("long"))
            .drop("_prefix", "_opening")
        )
    return placed.withColumn("shard", F.sha2(F.concat(F.hex("prefix"), F.lit(":"), key), 256))


def _subtree_sums(units: DataFrame) -> DataFrame:
    """``unit``, ``leaves`` and ``saved`` summed over each unit's subtree, by pointer doubling.

    After round k a unit has the sums of all units less than 2^k steps below and a pointer 2^k
    steps up; sums are combined on the map side, so a unit with many below it is no burden.
    """
    held = stage(units.select("unit", "above", "leaves", "saved"), "trie-units")
    while not held.where(F.col("above").isNotNull()).isEmpty():
        gained = (
            held.where(F.col("above").isNotNull())
            .groupBy(F.col("above").alias("_unit"))
            .agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        )
        further = held.where(F.col("above").isNotNull()).select(
            F.col("unit").alias("_at"), F.col("above").alias("_above")
        )
        held = stage(
            held.join(gained, F.col("unit") == F.col("_unit"), "left")
            .join(further, F.col("above") == F.col("_at"), "left")
            .select(
                "unit",
                F.col("_above").alias("above"),
                (F.col("leaves") + F.coalesce("_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"),
            ),
            "trie-units",
        )
    return held.drop("above")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``node`` and the digest of the keys that end there, streamed in order of the keys."""
    kind = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, ready = None, None, []
        for batch in batches:
            nodes, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for node, conv in zip(nodes, convs, strict=True):
                if digest is None or node != current:
                    if digest is not None:
                        ready.append({"node": current, "ends_sha256": digest.hexdigest()})
                    current, digest = node, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema=kind)
                ready = []
        if digest is not None:
            ready.append({"node": current, "ends_sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(ready, schema=kind)

    dealt = ends.select("last", "conv_id").repartition("last")
    return dealt.sortWithinPartitions("last", "conv_id").mapInArrow(
        run, "node binary, ends_sha256 string"
    )


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of role and text in hexadecimal digits; the role's length keeps pairs apart."""
    return F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)


def trie_nodes(
    turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per node of the trie over ``turns``.

    ``turns`` has ``conv_id`` (integer), ``place`` (the order of its turns), ``digest``
    (hexadecimal, of role and text) and ``chars``; a row with null digest only says that the
    conversation exists. Rows with null ``conv_id`` belong to no conversation. Turns of the
    same place are taken by digest; repeated rows are turns of their own. An empty table has no
    node, not even a root.

    Result: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree), ``saved_tokens``
    (the subtree's ``(n_convs - 1) * chars``) and ``ends_sha256`` of the conversations that end
    here.
    """
    item = F.unhex(F.substring("digest", 1, 32))
    dealt = (
        turns.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "place",
            "digest",
            item.alias("item"),
            F.col("chars").cast("long").alias("chars"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("place"), "digest")
        .select("conv_id", "item", "chars")
    )
    cut = stage(_segments(dealt, segment), "trie-segments")
    different = stage(
        cut.where(F.size("items") > 0)
        .groupBy("prefix", "block", "items", "ends")
        .agg(
            F.max("chars").alias("chars"),
            F.count("*").alias("n"),
            F.min("conv_id").alias("conv_id"),
        ),
        "trie-different",
    )
    placed = _split(different, segment, shard_turns)
    columns = ("shard", "prefix", "block", "split", "items", "chars", "ends", "n", "conv_id")
    nodes = stage(
        _packed(
            placed.select(*columns).repartition("shard").sortWithinPartitions("shard"), segment
        ),
        "trie-nodes",
    )
    ends = cut.where(F.col("last").isNotNull())
    root = ends.agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    ).where(F.col("n_convs") > 0)
    upper = stage(
        nodes.where(~F.col("owned"))
        .groupBy("node", "parent", "depth", "chars")
        .agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
        .unionByName(
            root.select(
                F.lit(_ROOT).alias("node"),
                F.lit(None).cast("binary").alias("parent"),
                F.lit(0).cast("long").alias("depth"),
                F.lit(0).cast("long").alias("chars"),
                "n_convs",
                "conv_id",
            )
        ),
        "trie-upper",
    )
    tops = nodes.where("owned AND top")
    # Nodes at the end of a segment that goes on: their children lie in other shards.
    edges = nodes.where("owned AND goes_on").select("node", "unit", "conv_id", "up")
    children = (
        upper.select("parent").unionByName(tops.select("parent")).where("parent IS NOT NULL")
    ).groupBy(F.col("parent").alias("_node")).agg(F.count("*").alias("_children"))
    upper = stage(
        upper.join(children, F.col("node") == F.col("_node"), "left").select(
            *upper.columns, F.coalesce("_children", F.lit(0)).cast("long").alias("n_children")
        ),
        "trie-upper",
    )
    own = upper.select(
        F.col("node").alias("unit"),
        "parent",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    ).unionByName(tops.select("unit", "parent", F.col("n_leaves").alias("leaves"), "saved"))
    homes = edges.select(F.col("node").alias("_edge"), F.col("unit").alias("_unit"))
    units = own.join(homes, F.col("parent") == F.col("_edge"), "left").withColumn(
        "above", F.coalesce("_unit", "parent")
    )
    sums = _subtree_sums(units)

    handed = (
        edges.select("node", F.explode("up").alias("_node"))
        .join(own.select("unit", F.col("parent").alias("_edge")), F.col("node") == F.col("_edge"))
        .drop("node")
        .join(sums, "unit")
        .groupBy("_node")
        .agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    )
    parents = upper.select("node", "conv_id").unionByName(edges.select("node", "conv_id"))
    parents = parents.select(F.col("node").alias("_parent"), F.col("conv_id").alias("_parent_conv"))
    more = children.withColumnRenamed("_node", "_edge")
    owned = (
        nodes.where("owned")
        .join(handed, F.col("node") == F.col("_node"), "left")
        .join(more, F.col("goes_on") & (F.col("node") == F.col("_edge")), "left")
        .select(
            "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs",
            (F.col("n_children") + F.coalesce("_children", F.lit(0))).alias("n_children"),
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
        )
    )
    above = upper.join(sums, F.col("node") == F.col("unit")).select(
        "node", "parent", "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
    )
    found = _end_digests(ends).withColumnRenamed("node", "_end")
    # Only shard tops and nodes above them have their parent elsewhere.
    search = F.col("parent_conv_id").isNull() & (F.col("parent") == F.col("_parent"))
    return (
        owned.unionByName(above)
        .join(parents, search, "left")
        .join(found, F.col("node") == F.col("_end"), "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent_conv"))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
        .select(*NODE)
    )


def shared_openings(
    df: DataFrame, conv: str, turn: str, role: str, text: str, block: int = 100, most: int = 6
) -> DataFrame:
    """Conversations rebuilt so that they share openings, as ``trie_nodes`` takes them.

    Conversation c starts with the first h turns of c - c % block (all if fewer, none if there
    is no such conversation) and goes on with its own turns after its first h, where h is
    ``crc32`` of c in decimal digits, modulo ``most``. Turns are ordered by ``turn``, null first,
    then by the digest of role and text. A null role or text is empty; rows with a null key are
    left out, as they belong to no conversation. Other columns take no part.
    """
    said = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role, text)]
    rows = df.select(
        F.col(quoted(conv)).cast("long").alias("conv_id"),
        F.col(quoted(turn)).cast("long").alias("turn"),
        turn_digest(*said).alias("digest"),
        F.length(said[1]).cast("long").alias("chars"),
    ).where(F.col("conv_id").isNotNull())
    skipped = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    # A struct puts a null first and then orders by number and digest.
    at = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "digest")
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(at)) - 1
    numbered = rows.withColumn("number", number)
    opening = numbered.where(F.col("number") < most - 1).select(
        F.col("conv_id").alias("_from"), F.col("number").alias("_number"),
        F.col("digest").alias("_digest"), F.col("chars").alias("_chars"),
    )
    convs = rows.select("conv_id").distinct().withColumn("skipped", skipped)
    borrowed = convs.join(
        opening,
        (F.col("conv_id") - F.col("conv_id") % block == F.col("_from"))
        & (F.col("_number") < F.col("skipped")),
        "left",
    ).select(
        "conv_id",
        (F.col("_number") - most).cast("long").alias("place"),
        F.col("_digest").alias("digest"),
        F.col("_chars").alias("chars"),
    )
    own = numbered.where(F.col("number") >= skipped).select(
        "conv_id", F.col("number").cast("long").alias("place"), "digest", "chars"
    )
    return borrowed.unionByName(own)
