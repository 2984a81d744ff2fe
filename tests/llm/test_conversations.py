"""Conversation repair and prefix tries against exhaustive search, SQL and awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from sluiceway.llm import conversation_repair, expected, prefix_trie
from verification.compare import connect

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
TARGET = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def _repairs(rows):
    """Every sensible sequence of edits of (role, text, must go, truncated) rows: cost and result."""
    choices = []
    for role, text, must_go, cut in rows:
        options = [("D", 3, None)]
        if not must_go:
            options.append(("K", cut, (role, text)))
            options += [("R", 2 + cut, (full, text)) for full in ("user", "assistant")]
        choices.append(options)
    inserted = [("I", 2, (full, "")) for full in ("user", "assistant")]
    runs = [run for n in range(3) for run in itertools.product(inserted, repeat=n)]
    for edits in itertools.product(*choices):
        for before in itertools.product(runs, repeat=len(edits) + 1):
            flat = list(before[0])
            for edit, run in zip(edits, before[1:], strict=True):
                flat += [edit, *run]
            yield flat


def _cheapest(rows):
    best = None
    for edits in _repairs(rows):
        kept = [row for _, _, row in edits if row is not None]
        if TARGET.fullmatch("".join(role[:1] or " " for role, _ in kept)):
            found = (sum(e[1] for e in edits), "".join(e[0] for e in edits), kept)
            if best is None or found[:2] < best[:2]:
                best = found
    return best


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        blank, again = not last, (role, text) in seen
        seen.add((role, text))
        out.append((blank, again and not blank, not blank and not again and last not in ".!?"))
    return out


def _case(rng, conv):
    n = rng.randrange(0, 4)
    texts = ["a.", "b", " \t", "c! \n", "", "a."]
    return [(conv, i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(texts))
            for i in range(n)]


def test_repair_is_the_cheapest(spark):
    rng = random.Random(5)
    cases = {conv: _case(rng, conv) for conv in range(60)}
    rows = [row for case in cases.values() for row in case]
    df = spark.createDataFrame(rows, SCHEMA)
    for limits in ({}, {"held_bytes": 1, "held_steps": 1}):
        got = {
            r.conv_id: r
            for r in conversation_repair.repair(
                df, "conv_id", "turn", "role", "text", **limits
            ).collect()
        }
        assert set(got) == {conv for conv, case in cases.items() if case}
        for conv, case in cases.items():
            if not case:
                continue
            plain = [(role, text) for _, _, role, text in case]
            faults = _faults(plain)
            cost, audit, kept = _cheapest(
                [(*row, b or d, int(t)) for row, (b, d, t) in zip(plain, faults, strict=True)]
            )
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
            row = got[conv]
            assert (row.cost, row.audit, row.repaired_sha256) == (cost, audit, digest)
            assert (row.blank, row.duplicate, row.truncated) == tuple(map(sum, zip(*faults)))


def test_repaired_turns_are_the_rows_behind_the_digest(spark):
    rng = random.Random(6)
    rows = [row for conv in range(30) for row in _case(rng, conv)]
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ("conv_id", "turn", "role", "text")
    turns = conversation_repair.repaired_turns(df, *columns).collect()
    for r in conversation_repair.repair(df, *columns).collect():
        mine = sorted((t.place, t.role, t.text) for t in turns if t.conv_id == r.conv_id)
        body = "\n".join(f"{role}:{text}" for _, role, text in mine)
        assert hashlib.sha256(body.encode()).hexdigest() == r.repaired_sha256


def test_long_conversation_crosses_batches_and_spills(spark):
    roles = ["user", "assistant"]
    rows = [(7, i, roles[i % 2], f"turn {i}.") for i in range(5000)]
    rows += [(8, i, roles[i % 2], f"turn {i}.") for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        found = conversation_repair.repair(
            df, "conv_id", "turn", "role", "text", held_bytes=500, held_steps=100
        ).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    by_key = {r.conv_id: r for r in found}
    assert by_key[7].audit == "K" * 5000 and by_key[7].cost == 0
    assert by_key[8].audit == "KKKI" and by_key[8].cost == 2
    body = "\n".join(f"{role}:{text}" for _, _, role, text in rows[:5000])
    assert by_key[7].repaired_sha256 == hashlib.sha256(body.encode()).hexdigest()


AWKWARD = [
    (1, None, None, None), (1, 0, "user", "x."), (1, 0, "user", "x."), (1, 2, "assistant", ""),
    (None, 1, "user", "hé \U0001f600!"), (None, 2, "assistant", "b"), (2, 5, "", "y" * 9000),
    (2, 9, "system", "."), (3, 1, "user", None), (3, 2, None, "z."), (-5, 1, "a:b", "c"),
    (-5, 1, "a", "b:c"), (-5, 1, "a", "b:c"), (2**60, 2**60, "user", "q?"),
]


def _with_sql(spark, name, rows, query):
    """Rows of a query over ``rows`` as the table conversations, and those of its SQL."""
    df = spark.createDataFrame(rows, SCHEMA)
    with connect("/root/testdata/sf0.001") as con:
        con.execute("DROP VIEW IF EXISTS conversations")
        con.execute(
            "CREATE OR REPLACE TEMP TABLE conversations"
            " (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)"
        )
        if rows:
            con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
        result = con.execute(expected.STATEMENTS[name])
        columns = [d[0] for d in result.description]
        wanted = [dict(zip(columns, row, strict=True)) for row in result.fetchall()]
    got = [r.asDict() for r in query(df).select(*columns).collect()]
    return sorted(map(repr, got)), sorted(map(repr, wanted))


def _repair_damaged(df):
    columns = ("conv_id", "turn", "role", "text")
    return conversation_repair.repair(
        conversation_repair.damage(df, *columns), *columns, present=_present()
    )


def _present():
    from pyspark.sql import functions as F

    return F.col("present")


@pytest.mark.parametrize("rows", [AWKWARD, AWKWARD * 2, []], ids=["once", "twice", "empty"])
def test_repair_of_awkward_rows(spark, rows):
    got, wanted = _with_sql(spark, "op11_conversation_repair", rows, _repair_damaged)
    assert got == wanted


def test_repair_with_clashing_names(spark):
    rows = [(c, t, r, x, True, 5, "k") for c, t, r, x in AWKWARD]
    named = spark.createDataFrame(
        rows, "same long, again long, role string, blank string, present boolean, key long, _key string"
    )
    plain = spark.createDataFrame(AWKWARD, SCHEMA)
    got = conversation_repair.repair(named, "same", "again", "role", "blank").collect()
    wanted = conversation_repair.repair(plain, "conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, wanted), key=repr)


# --- prefix trie ----------------------------------------------------------------------------


def _trie(**limits):
    def run(df):
        rebuilt = prefix_trie.shared_openings(df, "conv_id", "turn", "role", "text")
        return prefix_trie.trie_nodes(rebuilt, **limits)

    return run


def _talks(rng, convs, longest, words):
    return [
        (conv * 7, turn, rng.choice(["user", "assistant"]), rng.choice(words))
        for conv in range(convs)
        for turn in range(rng.randrange(0, longest + 1))
    ]


@pytest.mark.parametrize("limits", [{}, {"segment": 2, "shard_turns": 1}, {"segment": 4, "shard_turns": 9}],
                         ids=["usual", "smallest", "small"])
@pytest.mark.parametrize("longest,words", [(9, "ab"), (4, "a"), (12, "abcdefgh")])
def test_trie_against_sql(spark, limits, longest, words):
    rows = _talks(random.Random(longest), 45, longest, words)
    got, wanted = _with_sql(spark, "op13_prefix_trie", rows, _trie(**limits))
    assert got == wanted


@pytest.mark.parametrize("rows", [AWKWARD, AWKWARD * 2, []], ids=["once", "twice", "empty"])
def test_trie_of_awkward_rows(spark, rows):
    got, wanted = _with_sql(spark, "op13_prefix_trie", rows, _trie())
    assert got == wanted


def test_trie_of_one_long_conversation_and_its_copies(spark):
    rows = [(c, i, "user", f"turn {i}") for c in (1, 2, 3) for i in range(300)]
    rows += [(4, i, "user", f"turn {i}") for i in range(290)] + [(4, 290, "user", "other")]
    got, wanted = _with_sql(spark, "op13_prefix_trie", rows, _trie(segment=8, shard_turns=5))
    assert got == wanted


def test_trie_with_clashing_names(spark):
    rows = [(*row, 1, "x", 3) for row in AWKWARD]
    named = spark.createDataFrame(
        rows, "place long, digest long, role string, chars string, conv_id int, _from string, number int"
    )
    plain = spark.createDataFrame(AWKWARD, SCHEMA)
    one = prefix_trie.shared_openings(named, "place", "digest", "role", "chars").collect()
    two = prefix_trie.shared_openings(plain, "conv_id", "turn", "role", "text").collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_double_array_holds_exactly_its_sequences():
    rng = random.Random(3)
    sequences = sorted(
        {tuple(rng.randrange(1, 30) for _ in range(rng.randrange(1, 5))) for _ in range(400)}
    )
    trie = prefix_trie.DoubleArray(sequences)
    prefixes = {s[:n] for s in sequences for n in range(1, len(s) + 1)}
    assert len(trie.order) == len(set(trie.order)) == len(prefixes)

    def found(sequence):
        state = 0
        for code in sequence:
            state = trie.child(state, code)
            if state is None:
                return False
        return True

    assert all(map(found, prefixes))
    for sequence in itertools.product(range(1, 30), repeat=2):
        assert found(sequence) == (sequence in prefixes)
