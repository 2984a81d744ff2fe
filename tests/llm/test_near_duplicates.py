"""Near-duplicates against all pairs, the recall of sketches, and the bounds that skip pairs."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import near_duplicates
from sluiceway.llm.components import components
from sluiceway.operators import Scratch

SF_DIR = "/root/testdata/sf0.001"


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance_against_full_alignment():
    rng = random.Random(1)
    for _ in range(4000):
        a = [rng.randrange(4) for _ in range(rng.randrange(0, 16))]
        b = list(a) if rng.random() < 0.7 else [rng.randrange(4) for _ in range(rng.randrange(16))]
        for _ in range(rng.randrange(5)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(4))
            if rng.random() < 0.6:
                b.pop(rng.randrange(len(b)))
        limit, distance = rng.randrange(10), _levenshtein(a, b)
        wanted = distance if distance <= limit else None
        assert near_duplicates.distance_within(a, b, limit) == wanted


def test_distance_of_long_texts_ends_soon():
    rng = random.Random(2)
    a = [rng.randrange(50_000) for _ in range(40_000)]
    b = list(a)
    changed = rng.sample(range(len(b)), 6000)
    for at in changed:
        b[at] = -1
    assert near_duplicates.distance_within(a, b, 8000) <= 6000


@pytest.mark.parametrize("similarity,least", [(0.95, 0.99), (0.85, 0.95), (0.8, 0.85)])
def test_recall_of_sketches(similarity, least):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]

    def keys(text):
        return set(near_duplicates.sketches(near_duplicates.shingles(near_duplicates.word_hashes(text))))

    hits = 0
    for _ in range(150):
        text = [rng.choice(words) for _ in range(300)]
        other = list(text)
        for at in rng.sample(range(300), round(300 * (1 - similarity))):
            other[at] = f"new{rng.randrange(10**9)}"
        hits += bool(keys(text) & keys(other))
    assert hits >= least * 150


def test_order_of_shingles_counts():
    """The same shingles in another order share fewer sketches than in the same order."""
    words = [f"w{i}" for i in range(400)]
    turned = words[200:] + words[:200]
    one, two = (
        set(near_duplicates.sketches(near_duplicates.shingles(near_duplicates.word_hashes(w))))
        for w in (words, turned)
    )
    assert len(one & two) < 0.75 * len(one)


def test_skipped_pairs_are_never_alike(spark):
    """The bounds by bits and by codes are at most the distance, also for many equal words."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    pairs = []
    for _ in range(120):
        a = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))]
        if rng.random() < 0.2:
            a += ["the"] * rng.randrange(100, 400)
        b = [w for w in a if rng.random() > 0.1] + rng.choices(vocabulary, k=rng.randrange(4))
        rng.shuffle(b) if rng.random() < 0.3 else None
        pairs.append((a, b))

    def figures(words):
        return len(words), *near_duplicates.word_bits(near_duplicates.word_hashes(words))

    kind = "struct<n:int,bits_set:int,bits:array<bigint>>"
    rows = [(i, figures(a), figures(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}, y {kind}")
    may, turned = near_duplicates._may_be_alike("x", "y"), near_duplicates._may_be_alike("y", "x")
    common = near_duplicates._common_bits(F.col("x.bits"), F.col("y.bits"))
    found = df.select("i", may.alias("may"), turned.alias("turned"), common.alias("common"))
    got = {r.i: r for r in found.collect()}
    refused = 0
    for i, (a, b) in enumerate(pairs):
        sets = [
            {int(h) % near_duplicates.BITS for h in
             near_duplicates.labelled(near_duplicates.word_hashes(w)).tolist()} for w in (a, b)
        ]
        assert got[i].common == len(sets[0] & sets[1])
        apart = max(map(len, sets)) - len(sets[0] & sets[1])
        limit = int(0.2 * max(len(a), len(b)) + 1e-9)
        assert apart <= _levenshtein(a, b)
        assert got[i].may == got[i].turned == (max(apart, abs(len(a) - len(b))) <= limit)
        refused += not got[i].may
        codes = [near_duplicates.coded(near_duplicates.word_hashes(w)) for w in (a, b)]
        if near_duplicates.alike(" ".join(a), " ".join(b)):
            assert got[i].may and near_duplicates.codes_alike(*codes)
    assert refused > 10


def _classes_by_all_pairs(texts):
    """Smallest index of the class of every text, with all pairs compared."""
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if texts[a] == texts[b] or near_duplicates.alike(texts[a], texts[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return [root(x) for x in range(len(texts))]


def _smallest_of_components(links):
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


def test_components_by_contraction(spark):
    """Chains, stars, cycles and random links, also where they come in two lots."""
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(70, 130)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300)]
    links += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(70)]
    rng.shuffle(links)
    with Scratch(spark, "components") as scratch:

        def found(rows, known=None):
            return components(spark.createDataFrame(rows, "a long, b long"), scratch, known)

        wanted = _smallest_of_components([(a, b) for a, b in links if a != b])
        assert {r["id"]: r["class"] for r in found(links).collect()} == wanted
        both = found(links[::2], found(links[1::2]))
        assert sorted(map(tuple, both.select("id", "class").collect())) == sorted(wanted.items())


def test_links_of_a_group_of_copies_are_joined_once(spark, monkeypatch):
    """A group whose members are linked to several others leaves no link after one round."""
    links = [(pivot, i) for pivot in range(5) for i in range(pivot + 1, 300)]
    rows = []
    with Scratch(spark, "components") as scratch:
        stage = scratch.stage

        def counted(df, label):
            staged = stage(df, label)
            rows.append((label, staged.count()))
            return staged

        monkeypatch.setattr(scratch, "stage", counted)
        df = spark.createDataFrame(links, "a long, b long")
        assert {r["class"] for r in components(df, scratch).collect()} == {0}
    assert [n for label, n in rows if label == "edges"] == [len(links), 0]


def test_classes_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    texts = [r.text or "" for r in docs]
    wanted = _classes_by_all_pairs(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in near_duplicates.classify(df, "doc_id", "text").collect()}
    together, missed = defaultdict(set), 0
    for i, label in enumerate(wanted):
        together[label].add(i)
    for i, label in enumerate(wanted):
        # Nothing is linked that all pairs do not link.
        assert got[i].class_id in together[label]
        missed += got[i].class_id != label
    assert sum(len(c) > 1 for c in together.values()) > 3
    assert missed <= 0.05 * sum(len(c) for c in together.values() if len(c) > 1)


def test_blocks_form_every_pair_once(spark, monkeypatch):
    """All pairs of a sketch in different classes that may be alike, whatever the block size."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(40)]
    texts = [[rng.choice(base) if rng.random() < 0.12 else w for w in base] for _ in range(20)]
    rows = []
    for i, words in enumerate(texts):
        hashes = near_duplicates.word_hashes(words)
        own = len(words), *near_duplicates.word_bits(hashes), near_duplicates.coded(hashes)
        held = [1, 2, 3] if i % 2 else [2, 3]
        rows += [(key, bytes([i]), bytes([i // 3]), (*own, held)) for key in held]
    kind = "struct<n:int,bits_set:int,bits:array<bigint>,codes:binary,keys:array<bigint>>"
    apart = spark.createDataFrame(rows, f"key long, id binary, class binary, own {kind}")
    got = sorted((r.a[0], r.b[0]) for r in near_duplicates._across(apart).collect())
    own = {row[1][0]: row[3] for row in rows}
    wanted = []
    for a, b in itertools.combinations(range(20), 2):
        bits = [np.array(own[i][2], np.int64).view(np.uint64) for i in (a, b)]
        apart_by = max(own[a][1], own[b][1]) - int(np.bitwise_count(bits[0] & bits[1]).sum())
        if a // 3 != b // 3 and apart_by <= 8 and near_duplicates.codes_alike(own[a][3], own[b][3]):
            wanted.append((a, b))
    assert got == wanted and 0 < len(wanted) < 150


def test_a_passage_that_many_share_does_not_join_them(spark):
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [
        (i, " ".join(passage + [f"x{v}" for v in rng.integers(0, 10**6, 40 + i)])) for i in range(60)
    ]
    rows += [(100, " ".join(passage)), (101, " ".join([*passage, "more"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.classify(df, "doc_id", "text").collect()}
    assert got == {i: i for i in range(60)} | {100: 100, 101: 100}


def test_keep_one_with_clashing_names_nulls_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text, 1), (2, text + " more", 2), (2, text + " more", 2), (2, text + " more", 1),
            (None, text, 0), (None, None, 5), (None, None, 5), (9, "alone", None)]
    df = spark.createDataFrame(rows, "_key long, text string, _same_text int")
    got = near_duplicates.keep_one(df, "_key", "text")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(2, text + " more", 1), (None, None, 5), (9, "alone", None)], key=repr
    )
    assert near_duplicates.keep_one(df.limit(0), "_key", "text").count() == 0


def _apart(spark, texts, keys_of):
    """Members of sketches as ``_across`` takes them, each in a class of its own."""
    rows = []
    for i, words in enumerate(texts):
        hashes = near_duplicates.word_hashes(words)
        own = len(words), *near_duplicates.word_bits(hashes), near_duplicates.coded(hashes)
        rows += [(key, bytes([i]), bytes([i]), (*own, keys_of(i))) for key in keys_of(i)]
    kind = "struct<n:int,bits_set:int,bits:array<bigint>,codes:binary,keys:array<bigint>>"
    return spark.createDataFrame(rows, f"key long, id binary, class binary, own {kind}")


def test_large_sketches_with_common_texts_meet_once_and_by_length(spark, monkeypatch):
    """Each text is dealt to few blocks, however many sketches it shares, and no pair is lost."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(130)]
    texts = [
        [rng.choice(base) if rng.random() < 0.05 else w for w in base[: 20 + 11 * (i % 10)]]
        for i in range(60)
    ]

    def keys_of(i):
        # Ten large sketches with common texts, a small one that some share besides, and a
        # large one that shares no text with others of them.
        if i >= 50:
            return [90]
        return [k for k in range(10) if (i + k) % 7] + ([-5] if i < 4 else [])

    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    apart = _apart(spark, texts, keys_of)
    dealt = near_duplicates._dealt(apart)
    # One by one the sketches' members meet all their blocks: 43 members, 6 blocks, ten times.
    assert dealt.count() < 700
    assert dealt.groupBy("key", "low", "high").count().agg(F.max("count")).head()[0] <= 40
    got = sorted((r.a[0], r.b[0]) for r in near_duplicates._across(apart).collect())

    monkeypatch.setattr(near_duplicates, "BLOCK", 1000)
    plain = sorted((r.a[0], r.b[0]) for r in near_duplicates._across(apart).collect())
    assert got == plain and len(plain) > 50
    for a, b in itertools.combinations(range(60), 2):
        if set(keys_of(a)) & set(keys_of(b)) and near_duplicates.alike(*map(" ".join, (texts[a], texts[b]))):
            assert (a, b) in got
