"""Near-duplicates by order MinHash and banded alignment.

A text is its sequence of words; its k-mers are five-word shingles, labelled with their
occurrence number so that repeated ones stay apart. Each of ``SKETCHES`` sketches keeps the
``MINIMA`` labelled shingles of smallest hash *in text order*. Two texts agree on a sketch
only if they share those shingles in the same order, so the chance follows edit similarity
rather than mere overlap. Texts that agree on a sketch are candidates.

Candidates are verified on their words: similarity is 1 - distance / length of the longer,
with the Levenshtein distance of the word sequences, found by an alignment whose band is the
number of edits that 0.8 allows.

Classes are the connected components of verified pairs. Not all pairs of a sketch are tried:
first every member is compared with the most central member of its sketch; then members of one
sketch that are still in different classes are compared with each other, so no link that could
join two classes is left out, while a large group of copies costs one comparison per member.
Pairs that cannot be similar, by their lengths or by ``BITS`` bits that their words set (a
lower bound of the distance), are never formed, and those of the second step are first aligned
on one byte per word, which can only come out nearer than the words. Large sketches that share
texts are taken as one group, so two texts meet once and not in every sketch they share, and only
texts of similar lengths meet.

Two texts of 500 words in which a share of the words is replaced at random agree on a sketch, and
are thus found, with a probability of 0.9 at a similarity of 0.8, 0.96 at 0.82 and 0.99 from 0.85 on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from sluiceway.llm.components import components
from sluiceway.llm.texts import Worker, bounded_batches, fresh, quoted, text_udf
from sluiceway.operators import Scratch, stage

#: Words of a shingle, shingles in a sketch, sketches of a text.
SHINGLE = 5
MINIMA = 2
SKETCHES = 64
#: Bits that a text's words set, by hash.
BITS = 4096
#: Members of a sketch that are compared with as many others at a time.
BLOCK = 512
#: Words of a block, where its texts are long.
BLOCK_WORDS = 4_000_000
#: Least similarity of a pair.
SIMILARITY = 0.8
# Lengths of a pair differ by less than this ratio, so they lie in one band or two neighbouring ones.
_BAND = 1 / SIMILARITY + 1e-4
# Block numbers of a band.
_BAND_BLOCKS = 1 << 32

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MAX_REMEMBERED = 300_000
# Hashes that are compared at once.
_AT_ONCE = 1 << 20
_TAKEN = np.uint32(0xFFFFFFFF)
# Rows of a block whose bits are compared at once.
_ROWS = 32


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a fixed number."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= _MAX_REMEMBERED:
            self.clear()
        self[word] = found
        return found


_hashes = _Hashes()
_random = np.random.default_rng(20240229)
_MULTIPLIERS = _random.integers(0, 1 << 31, SKETCHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _random.integers(0, 1 << 32, SKETCHES, dtype=np.uint32)
_SPREAD = np.uint32(0x9E3779B1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingles(own: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles in text order, those that repeat told apart by occurrence.

    ``own`` are the hashes of the words. A text of fewer words is one shingle; a text without
    words has none.
    """
    if not len(own):
        return np.zeros(0, np.uint64)
    size = min(size, len(own))
    total = np.zeros(len(own) - size + 1, np.uint64)
    for k in range(size):
        total = total * _BASE + own[k : len(own) - size + 1 + k]
    total = _mixed(total)
    return labelled(total)


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes told apart by occurrence, so that repeated ones differ."""
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    again = np.flatnonzero(sorted_[1:] == sorted_[:-1]) + 1
    occurrence = np.zeros(len(hashes), np.uint64)
    if len(again):
        first = np.arange(len(hashes))
        first[again] = 0
        first = np.maximum.accumulate(first)
        occurrence[order] = (np.arange(len(hashes)) - first).astype(np.uint64)
    return _mixed(hashes + occurrence * np.uint64(0xD6E8FEB86659FD93))


def sketches(shingled: np.ndarray) -> list[int]:
    """One signed 64-bit key per sketch; none for a text without shingles.

    The order of a sketch is that of 32 mixed bits; equal ones go by place in the text.
    """
    if not len(shingled):
        return []
    short = (shingled >> np.uint64(32)).astype(np.uint32)
    keys = []
    step = max(1, _AT_ONCE // len(short))
    for begin in range(0, SKETCHES, step):
        hashed = (short ^ _OFFSETS[begin : begin + step, None]) * _MULTIPLIERS[
            begin : begin + step, None
        ]
        hashed ^= hashed >> np.uint32(15)
        hashed *= _SPREAD
        rows, places = np.arange(len(hashed)), []
        for _ in range(min(MINIMA, len(short))):
            places.append(hashed.argmin(axis=1))
            hashed[rows, places[-1]] = _TAKEN
        chosen = shingled[np.sort(np.stack(places, axis=1), axis=1)]
        key = np.arange(begin, begin + len(chosen), dtype=np.uint64)
        for k in range(chosen.shape[1]):
            key = _mixed(key * _BASE + chosen[:, k])
        keys += key.view(np.int64).tolist()
    return keys


def distance_within(a: Sequence[int], b: Sequence[int], limit: int) -> int | None:
    """Levenshtein distance if it is at most ``limit``: bit-parallel alignment in a band.

    The differences between neighbouring cells of a column are two bit vectors, as wide as the
    band of ``limit`` diagonals to either side, which moves down one place a step. The distance
    is followed along the lower edge of the band to the last row, then along that row.
    """
    begin, n, m = 0, len(a), len(b)
    while begin < n and begin < m and a[begin] == b[begin]:
        begin += 1
    while n > begin and m > begin and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[begin:n], b[begin:m]
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > limit:
        return None
    if not m:
        return n
    band = min(limit, n)
    if not band:
        return None
    places: dict[int, int] = {}
    for at, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << at
    width = 2 * band + 1
    full = (1 << width) - 1
    up, down = full ^ ((1 << band) - 1), 0
    edge, row = 1 << (width - 1), 1 << (width - 2)
    distance = band
    # Beyond this the rest of the way cannot bring the distance back to the limit.
    most = band + m - (n - band)
    for at, word in enumerate(b):
        found = places.get(word, 0)
        found = (found >> (at - band) if at >= band else found << (band - at)) & full
        diagonal = ((((found & up) + up) ^ up) | found | down) & full
        right = (down | ~(diagonal | up)) & full
        left = diagonal & up
        if at < n - band:
            distance += not diagonal & edge
        else:
            distance += bool(right & row) - bool(left & row)
            row >>= 1
        if distance > most:
            return None
        shifted = diagonal >> 1
        up = (left | ~(shifted | right)) & full
        down = shifted & right
    return distance if distance <= limit else None


def alike(a: str, b: str, least: float = SIMILARITY) -> bool:
    """Whether the word sequences have an edit similarity of at least ``least``."""
    left, right = _WORD.findall(a), _WORD.findall(b)
    longer = max(len(left), len(right))
    limit = int((1 - least) * longer + 1e-9)
    if abs(len(left) - len(right)) > limit:
        return False
    # Words that one text lacks cost an edit each, so this is a lower bound of the distance.
    common = (Counter(left) & Counter(right)).total()
    if longer - common > limit:
        return False
    number: dict[str, int] = {}
    coded = [[number.setdefault(w, len(number)) for w in side] for side in (left, right)]
    return distance_within(*coded, limit) is not None


_SKETCH = StructType(
    [
        StructField("n", IntegerType()),
        StructField("bits_set", IntegerType()),
        StructField("bits", ArrayType(LongType())),
        StructField("codes", BinaryType()),
        StructField("keys", ArrayType(LongType())),
    ]
)


def word_bits(own: np.ndarray) -> tuple[int, list[int]]:
    """Bits set by the words, repeated ones told apart: their number, and 64 to a number."""
    bits = np.zeros(BITS, bool)
    bits[(labelled(own) % np.uint64(BITS)).astype(np.int64)] = True
    return int(bits.sum()), np.packbits(bits).view(np.int64).tolist()


def coded(own: np.ndarray) -> bytes:
    """A text's words as one byte each."""
    return (own & np.uint64(0xFF)).astype(np.uint8).tobytes()


def _sketch_worker() -> Worker:
    def work(texts: list[str]) -> dict[str, list[Any]]:
        hashed = [word_hashes(_WORD.findall(t)) for t in texts]
        bits = list(map(word_bits, hashed))
        return {
            "n": list(map(len, hashed)),
            "bits_set": [n for n, _ in bits],
            "bits": [packed for _, packed in bits],
            "codes": list(map(coded, hashed)),
            "keys": [sketches(shingles(h)) for h in hashed],
        }

    return work


def codes_alike(a: bytes, b: bytes, least: float = SIMILARITY) -> bool:
    """False only if the texts behind two codes are not alike.

    Different words may have one code, so the distance of codes is at most that of the words.
    """
    longer = max(len(a), len(b))
    return distance_within(a, b, int((1 - least) * longer + 1e-9)) is not None


@F.arrow_udf(BooleanType())
def _alike(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(
        [alike(a.as_py(), b.as_py()) for a, b in zip(left, right)], pa.bool_()
    )


def _text_id(text: Column) -> Column:
    """128 bits that stand for a text; equal texts are one from here on."""
    return F.unhex(F.md5(text.cast("binary")))


def _common_bits(a: Column, b: Column) -> Column:
    total = F.lit(0)
    for at in range(BITS // 64):
        total = total + F.bit_count(a[at].bitwiseAND(b[at]))
    return total


def _may_be_alike(a: str, b: str) -> Column:
    """Whether two members (structs of n, bits_set and bits) can be similar: false only if not.

    A bit that only one text sets comes from a word that the other lacks there, which costs an
    edit.
    """
    one, two = F.col(a), F.col(b)
    limit = F.floor(F.greatest(one["n"], two["n"]) * (1 - SIMILARITY) + F.lit(1e-9))
    set_most = F.greatest(one["bits_set"], two["bits_set"])
    return (F.abs(one["n"] - two["n"]) <= limit) & (
        set_most - _common_bits(one["bits"], two["bits"]) <= limit
    )


@dataclass
class _Block:
    """Members of one group that are compared with each other: two blocks of them, or one twice.

    A group is a sketch, or several (``merged``).
    """

    group: int
    twice: bool
    merged: bool
    ids: list[bytes] = field(default_factory=list)
    classes: list[bytes] = field(default_factory=list)
    first: list[bool] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    bits_set: list[int] = field(default_factory=list)
    bits: list[list[int]] = field(default_factory=list)
    codes: list[bytes] = field(default_factory=list)
    keys: list[list[int]] = field(default_factory=list)
    gathered: list[list[int]] = field(default_factory=list)

    def pairs(self) -> Iterator[tuple[bytes, bytes]]:
        """Pairs of different classes that may be alike, by ``_may_be_alike`` and by their codes.

        A pair that agrees on several sketches is formed at the one of smallest key, or in the
        merged group if one of them went into it.
        """
        n, bits_set = np.array(self.n), np.array(self.bits_set)
        bits = np.array(self.bits, np.int64).view(np.uint64)
        numbers = {c: i for i, c in enumerate(sorted(set(self.classes)))}
        classes = np.array([numbers[c] for c in self.classes])
        first, places = np.array(self.first), np.arange(len(n))
        keys, gathered = list(map(set, self.keys)), list(map(set, self.gathered))
        left, right = (places, places) if self.twice else (places[first], places[~first])
        for begin in range(0, len(left), _ROWS):
            rows = left[begin : begin + _ROWS]
            limit = np.floor(np.maximum(n[rows, None], n[right]) * (1 - SIMILARITY) + 1e-9)
            near = np.abs(n[rows, None] - n[right]) <= limit
            near &= classes[rows, None] != classes[right]
            if self.twice:
                near &= rows[:, None] < right
            if not near.any():
                continue
            common = np.bitwise_count(bits[rows, None] & bits[right]).sum(axis=2, dtype=np.int64)
            near &= np.maximum(bits_set[rows, None], bits_set[right]) - common <= limit
            for i, j in zip(*np.nonzero(near), strict=True):
                x, y = rows[i], right[j]
                here = self.merged
                if here == gathered[x].isdisjoint(gathered[y]):
                    continue
                here = here or min(keys[x] & keys[y]) == self.group
                if here and codes_alike(self.codes[x], self.codes[y]):
                    yield tuple(sorted((self.ids[x], self.ids[y])))


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _verified(
    pairs: DataFrame, texts: DataFrame, scratch: Scratch, own: Scratch, label: str
) -> DataFrame:
    """The pairs (a, b) whose texts are alike; what it takes is staged in ``own``."""
    pairs = own.stage(pairs, f"{label}-pairs")
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    held = own.stage(
        texts.join(needed, "id", "left_semi").dropDuplicates(["id"]), f"{label}-texts"
    )
    left = held.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    # Few bytes may be much work, so pairs are dealt evenly before they are aligned.
    both = pairs.join(left, "a").join(right, "b").repartition(_tasks(pairs.sparkSession))
    return scratch.stage(
        both.where(_alike(F.col("text_a"), F.col("text_b"))).select("a", "b"), f"{label}-links"
    )


def classes(df: DataFrame, text: str) -> DataFrame:
    """Class of every distinct text with a partner: ``id`` (of the text) and ``class``.

    Texts that are not listed are alone in their class. The result is staged in the caller's
    scope; everything on the way to it is removed.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    whole = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    texts = df.select(_text_id(whole).alias("id"), whole.alias("text"))
    scratch = Scratch(spark, "near-duplicates")
    try:
        sketch = text_udf(_sketch_worker, _SKETCH)
        sketched = texts.select("id", sketch(F.col("text")).alias("s")).select("id", "s.*")
        distinct = scratch.stage(sketched.dropDuplicates(["id"]), "sketches")
        rows = distinct.select("id", F.explode("keys").alias("key"))
        # Sketches that texts share; most belong to one text.
        shared = scratch.stage(
            rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared"
        )
        members = scratch.stage(rows.join(shared, "key"), "members")
        figures = distinct.select("id", F.struct("n", "bits_set", "bits").alias("own"))
        alone = distinct.select("id", F.col("id").alias("class")).limit(0)
        with Scratch(spark, "near-duplicates-central") as own:
            central = _with_central(members, figures, own)
            links = _verified(central, texts, scratch, own, "central")
        # Members of one class need not meet.
        found = alone if links.isEmpty() else components(links, scratch)
        with Scratch(spark, "near-duplicates-across") as own:
            full = distinct.select("id", F.struct("n", "bits_set", "bits", "codes").alias("own"))
            apart = _apart(members, found, full, own)
            if not apart.isEmpty():
                more = _verified(_across(apart), texts, scratch, own, "across")
                if not more.isEmpty():
                    found = components(more, scratch, None if links.isEmpty() else found)
        return stage(found, "near-duplicate-classes")
    finally:
        scratch.release()


def _apart(
    members: DataFrame, found: DataFrame, figures: DataFrame, scratch: Scratch
) -> DataFrame:
    """Members (key, id, class, own) of the sketches that hold more than one class.

    ``own`` has a member's figures and all its keys of such sketches, at most ``SKETCHES``.
    """
    placed = scratch.stage(
        members.select("key", "id").join(found, "id", "left").select(
            "key", "id", F.coalesce("class", "id").alias("class")
        ),
        "placed",
    )
    mixed = scratch.stage(
        placed.groupBy("key")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low != high")
        .select("key"),
        "mixed",
    )
    held = scratch.stage(placed.join(mixed, "key", "left_semi"), "mixed-members")
    keys = held.groupBy("id").agg(F.collect_list("key").alias("keys"))
    own = keys.join(figures, "id").select("id", F.struct("own.*", "keys").alias("own"))
    return scratch.stage(held.join(own, "id"), "apart")


def _with_central(members: DataFrame, figures: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of every member of a sketch with its most central one, that may be alike.

    The central member shares most sketches with others. In a group of copies that is the text
    they come from, which is closer to each of them than they are to one another. Pairs are
    formed on ids alone; the figures are joined once per different pair.
    """
    popular = members.groupBy("id").agg(F.sum("size").alias("popularity"))
    pivots = (
        members.select("key", "id")
        .join(popular, "id")
        .groupBy("key")
        .agg(F.max(F.struct("popularity", "id"))["id"].alias("pivot"))
    )
    pairs = scratch.stage(
        members.select("key", "id")
        .join(pivots, "key")
        .where("id != pivot")
        .select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
        .distinct(),
        "central-pairs",
    )
    one = figures.select(F.col("id").alias("a"), F.col("own").alias("own_a"))
    two = figures.select(F.col("id").alias("b"), F.col("own").alias("own_b"))
    both = pairs.join(one, "a").join(two, "b")
    return both.where(_may_be_alike("own_a", "own_b")).select("a", "b")


def _merged(apart: DataFrame) -> DataFrame | None:
    """Members (id, group, gathered) of sketches that are taken together; None if none are.

    Texts around one long passage share many sketches. Sketches of more than ``BLOCK`` members
    that are connected by common ones become one group if its pairs are no more than those of the
    sketches one by one, counting a pair for every sketch. ``gathered`` are the member's sketches
    in the group, ``group`` is the smallest of all its sketches.
    """
    counted = apart.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    large = stage(counted, "large-sketches")
    if large.isEmpty():
        return None
    crowd = stage(
        apart.select("key", "id")
        .join(large, "key", "left_semi")
        .groupBy("id")
        .agg(F.min("key").alias("head"), F.collect_list("key").alias("gathered")),
        "crowd",
    )
    links = crowd.select(F.col("head").alias("a"), F.explode("gathered").alias("b"))
    links = stage(links.where("a != b").distinct(), "sketch-links")
    if links.isEmpty():
        return None
    scratch = Scratch(apart.sparkSession, "near-duplicates-groups")
    try:
        found = components(links, scratch).select(
            F.col("id").alias("head"), F.col("class").alias("group")
        )
        grouped = stage(crowd.join(found, "head").select("id", "group", "gathered"), "grouped")
        pairs = F.col("size").cast("double") * F.col("size")
        singly = large.join(found, large["key"] == found["head"]).groupBy("group").agg(
            F.sum(pairs).alias("singly")
        )
        together = grouped.groupBy("group").agg(F.count("*").alias("size"))
        fewer = together.join(singly, "group").where(pairs <= F.col("singly")).select("group")
        return stage(grouped.join(fewer, "group", "left_semi"), "merged")
    finally:
        scratch.release()


def _dealt(apart: DataFrame) -> DataFrame:
    """Members in the groups in which they are compared: two blocks (``low``, ``high``) of a key."""
    merged = _merged(apart)
    none = F.array().cast("array<bigint>")
    if merged is None:
        placed = apart.select("*", none.alias("gathered"), F.lit(False).alias("merged"))
    else:
        gathered = F.coalesce("gathered", none)
        inside = F.array_contains(gathered, F.col("key"))
        placed = (
            apart.join(merged, "id", "left")
            # A member of several sketches of a group comes once.
            .where(~inside | (F.col("key") == F.array_min(gathered)))
            .select(
                F.when(inside, F.col("group")).otherwise(F.col("key")).alias("key"),
                "id",
                "class",
                "own",
                gathered.alias("gathered"),
                inside.alias("merged"),
            )
        )
    band = F.floor(F.log(F.greatest(F.col("own.n"), F.lit(1))) / F.log(F.lit(_BAND)))
    placed = placed.withColumn("band", band)

    def size(members: Column, words: Column) -> Column:
        return F.ceil(F.greatest(members / BLOCK, words / BLOCK_WORDS))

    figures = F.count("*").alias("members"), F.sum("own.n").alias("words")
    bands = placed.groupBy("key", "band").agg(*figures)
    blocks = F.struct("band", size(F.col("members"), F.col("words")).alias("blocks"))
    plans = bands.groupBy("key").agg(
        (size(F.sum("members"), F.sum("words")) == 1).alias("one"),
        F.collect_list(blocks).alias("bands"),
    )
    met = placed.join(plans, "key")
    zero, single = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    whole = F.array(F.struct(zero.alias("band"), single.alias("blocks")))
    met = met.withColumns(
        {
            "band": F.when(F.col("one"), zero).otherwise(F.col("band")),
            "bands": F.when(F.col("one"), whole).otherwise(F.col("bands")),
        }
    )
    own_blocks = F.filter("bands", lambda b: b["band"] == F.col("band"))[0]["blocks"]
    near = F.filter("bands", lambda b: F.abs(b["band"] - F.col("band")) <= 1)
    others = F.flatten(
        F.transform(
            near,
            lambda b: F.transform(
                F.sequence(zero, b["blocks"] - 1),
                lambda k: b["band"] * _BAND_BLOCKS + k,
            ),
        )
    )
    met = met.select(
        "*",
        (F.col("band") * _BAND_BLOCKS + F.pmod(F.xxhash64("id"), own_blocks)).alias("block"),
        F.explode(others).alias("other"),
    )
    return met.select(
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") <= F.col("other")).alias("first"),
        "merged",
        "id",
        "class",
        "own.n",
        "own.bits_set",
        "own.bits",
        "own.codes",
        "own.keys",
        "gathered",
    )


def _across(apart: DataFrame) -> DataFrame:
    """All pairs of members of one sketch in different classes that may be alike.

    The members of a sketch, or of several that are ``_merged``, are dealt by length: those of
    one band of lengths into blocks of about ``BLOCK`` members or ``BLOCK_WORDS`` words, and every
    two blocks of one band or of neighbouring ones meet in a group of their own, so no group grows
    with the sketch. Texts of other bands cannot be alike. What is compared travels with the
    members, not with the pairs.
    """
    group = ("key", "low", "high")
    dealt = _dealt(apart).repartition(*group).sortWithinPartitions(*group)
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block, ready = None, None, []

        def sent() -> pa.RecordBatch:
            columns = [pa.array(c, pa.binary()) for c in zip(*ready, strict=True)]
            ready.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for key, low, high, first, merged, *member in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if (key, low, high) != current:
                    for pair in block.pairs() if block else ():
                        ready.append(pair)
                        if len(ready) >= 10_000:
                            yield sent()
                    current, block = (key, low, high), _Block(key, low == high, merged)
                block.first.append(first)
                columns = (
                    block.ids, block.classes, block.n, block.bits_set, block.bits, block.codes,
                    block.keys, block.gathered,
                )
                for column, value in zip(columns, member, strict=True):
                    column.append(value)
        for pair in block.pairs() if block else ():
            ready.append(pair)
            if len(ready) >= 10_000:
                yield sent()
        if ready:
            yield sent()

    return dealt.mapInArrow(run, "a binary, b binary")


def classify(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per row of ``df``: ``key``, ``class_id`` (smallest key of its class), ``class_size``.

    Equal texts share a class; so do texts linked by pairs of edit similarity 0.8 or more.
    A null text is the empty text; texts without words are only equal to the same text. A
    null key is passed over in ``class_id``, which is null if all keys of the class are.
    Repeated rows count in ``class_size`` and stay. An empty table gives an empty table;
    other columns take no part.
    """
    found = classes(df, text)
    whole = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    ids = df.select(F.col(quoted(key)).alias("_key"), _text_id(whole).alias("id"))
    placed = stage(
        ids.join(found, "id", "left").select(
            "_key", F.coalesce(F.col("class"), F.col("id")).alias("class")
        ),
        "near-duplicate-rows",
    )
    heads = stage(
        placed.groupBy("class").agg(
            F.min("_key").alias("class_id"), F.count("*").alias("class_size")
        ),
        "near-duplicate-heads",
    )
    return placed.join(heads, "class").select(F.col("_key").alias(key), "class_id", "class_size")


def keep_one(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each class the one of smallest key stays.

    Null keys come last. Among rows of that key in the class the one with the smallest text
    digest stays, and of repeated rows, or rows that differ in other columns only, exactly one:
    that of the smallest values, column by column.
    """
    found = classes(df, text)
    whole = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    same, own, here = fresh(df, "same_text", "own_key", "this_text")
    ids = df.select(F.col(quoted(key)).alias("own"), _text_id(whole).alias("id"))
    kept = stage(
        ids.join(found, "id", "left")
        .groupBy(F.coalesce("class", "id").alias("class"))
        .agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "id")).alias("first"))
        .select(F.col("first.id").alias(same), F.col("first.own").alias(own)),
        "near-duplicate-kept",
    )
    columns = [F.col(quoted(c)) for c in df.columns]
    row, wanted = F.struct(*columns), F.col(quoted(key)).eqNullSafe(F.col(own))
    # Texts are dealt once: the rows of a text stay together for the last choice.
    chosen = (
        df.withColumn(here, _text_id(whole))
        .join(kept, (F.col(here) == F.col(same)) & wanted, "left_semi")
        .groupBy(here)
        .agg(F.min(row).alias("row"))
    )
    return chosen.select(*[F.col("row")[c].alias(c) for c in df.columns])
