"""Inferred secret formats against direct likelihoods, and candidates of any length."""

from __future__ import annotations

import math
import random
import string

import pytest

from sluiceway.llm import secret_scan


def _tokens(rng, n, length=40):
    alphabet = string.ascii_letters + string.digits
    return ["".join(rng.choices(alphabet, k=length)) for _ in range(n)]


def _words(rng, n):
    parts = ["super", "cali", "fragi", "listic", "expi", "ali", "docious", "under", "stand"]
    return ["".join(rng.choices(parts, k=5)) for _ in range(n)]


def test_unmerged_automaton_gives_the_frequencies_of_the_strings(monkeypatch):
    """Without merging a state is a prefix, so a string's likelihood is a product of counts."""
    monkeypatch.setattr(secret_scan.Automaton, "_merge_states", lambda self: None)
    strings = ["ab", "ab", "abc", "b", "b"]
    automaton = secret_scan.Automaton(strings)

    def direct(value):
        total = 0.0
        for at in range(len(value) + 1):
            through = [s for s in strings if s.startswith(value[:at])]
            ends = sum(s == value[:at] for s in through)
            if at == len(value):
                total += math.log2((ends + 0.02) / (len(through) + 1))
            else:
                onward = sum(s.startswith(value[: at + 1]) for s in through)
                total += math.log2(onward / (len(through) + 1))
        return total / (len(value) + 1)

    for value in ("ab", "abc", "b"):
        assert automaton.bits(value) == pytest.approx(direct(value))
    # A symbol never seen costs what its state has left, and the string goes on at the start.
    unseen = (math.log2(0.01 / 6) + math.log2(0.02 / 6)) / 2
    assert automaton.bits("x") == pytest.approx(unseen)


def test_merging_finds_the_loop_of_a_format():
    rng = random.Random(1)
    strings = ["k" + "d" * (1 + int(rng.expovariate(0.1))) for _ in range(400)]
    automaton = secret_scan.Automaton(strings)
    assert automaton.size < 12
    # Longer than any example, yet typical.
    assert automaton.bits("k" + "d" * 300) > automaton.bits("k" + "x" * 20) + 1


def test_candidates_of_any_length_are_scored(spark):
    rng = random.Random(2)
    tokens, words = _tokens(rng, 300), _words(rng, 300)
    rows = [(i, f"token = {t} and {w} here") for i, (t, w) in enumerate(zip(tokens, words))]
    long_tokens = [_tokens(rng, 1, n)[0] for n in (40, 240, 5000, 200_000)]
    rows += [(1000 + i, f"see {t} there") for i, t in enumerate(long_tokens)]
    rows += [(2000, " ".join(words[:40])), (2001, None), (2002, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {
        r.doc_id: [(s.kind, s.start, s.end) for s in r.secret_spans]
        for r in secret_scan.find_secrets(df, "text").collect()
    }
    for i, t in enumerate(long_tokens):
        assert found[1000 + i] == [("format", 4, 4 + len(t))]
    assert found[2000] == found[2001] == found[2002] == []
    assert all([k for k, _, _ in found[i]] == ["assign"] for i in range(300))


def test_free_candidates_touch_no_span():
    text = "a" * 20 + " token=" + "b" * 30 + " " + "c" * 20
    spans = secret_scan.base_spans(text)
    free = [m.span() for m in secret_scan.free_candidates(text, spans)]
    touched = [(s, e) for _, s, e, _ in spans]
    assert free == [(0, 20), (len(text) - 20, len(text))]
    assert all(e <= a or b <= s for s, e in free for a, b in touched)


def test_table_without_credentials_has_no_formats(spark):
    df = spark.createDataFrame([(1, "plain text"), (2, None)], "doc_id long, text string")
    formats = secret_scan.fit_formats(df, "text")
    assert not formats.credentials
    got = secret_scan.find_secrets(df.limit(0), "text")
    assert got.columns == ["doc_id", "text", "secret_spans"] and got.count() == 0
