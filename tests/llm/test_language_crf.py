"""The language field against enumeration, held-out accuracy and awkward texts."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from sluiceway.llm import language_crf
from sluiceway.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return language_crf.fit_languages(docs, "text", "lang", sample_texts=80)


def _enumerated(emissions, starts, transitions):
    """Label probabilities and log normalizer over all label sequences."""
    steps, size = emissions.shape
    total, each = 0.0, np.zeros((steps, size))
    for labels in itertools.product(range(size), repeat=steps):
        score = starts[labels[0]] + sum(emissions[t, k] for t, k in enumerate(labels))
        score += sum(transitions[a, b] for a, b in itertools.pairwise(labels))
        weight = np.exp(score)
        total += weight
        for t, k in enumerate(labels):
            each[t, k] += weight
    return each / total, np.log(total)


def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    lengths, size = np.array([5, 3, 3, 1]), 3
    emissions = rng.normal(size=(5, 4, size))
    starts, transitions = rng.normal(size=size), rng.normal(size=(size, size))
    given, norm = language_crf.forward_backward(emissions, lengths, starts, transitions)
    for s, n in enumerate(lengths):
        wanted, log_total = _enumerated(emissions[:n, s], starts, transitions)
        assert given[:n, s] == pytest.approx(wanted)
        assert norm[s] == pytest.approx(log_total)
        assert not given[n:, s].any()


def test_pieces_of_a_long_text_give_the_same(field, monkeypatch):
    docs = ["the that and inthe. ", "les eaux que elle ", "nicht und die "]
    text = "".join(docs[i % 3] * 5 for i in range(30))
    whole = language_crf._Tagger(field).shares([text])
    monkeypatch.setattr(language_crf, "_PIECE", 7)
    monkeypatch.setattr(language_crf, "_LONG_TEXT", 10)
    assert language_crf._Tagger(field).shares([text]) == pytest.approx(whole)


def test_gradient_of_the_transitions():
    """Expected pairs are the derivative of the log normalizer by the transitions."""
    rng = np.random.default_rng(2)
    lengths, size = np.array([4, 2]), 3
    emissions = rng.normal(size=(4, 2, size))
    made = language_crf.Field(["a", "b", "c"], [], np.zeros((0, size)), rng.normal(size=size),
                              rng.normal(size=(size, size)))

    def norm():
        return language_crf.forward_backward(emissions, lengths, made.starts, made.transitions)

    pairs = language_crf._pairs(emissions, norm()[0], lengths, made)
    for i, j in itertools.product(range(size), repeat=2):
        made.transitions[i, j] += 1e-5
        above = norm()[1].sum()
        made.transitions[i, j] -= 2e-5
        below = norm()[1].sum()
        made.transitions[i, j] += 1e-5
        assert pairs[i, j] == pytest.approx((above - below) / 2e-5, abs=1e-5)


def test_held_out_accuracy(spark):
    langs = {
        r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    }
    rows = QUERIES["op12_language_id"](spark, SF_DIR).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out and langs[r.doc_id] is not None]
    assert len(held) > 100
    right = sum(r.lang_pred == langs[r.doc_id] for r in held)
    assert right >= 0.97 * len(held)


def test_code_switched_text_is_labelled_run_by_run(spark, field):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    parts = [next(r.text[:400] for r in docs if r.lang == lang and len(r.text) > 800)
             for lang in ("de", "es", "en")]
    text = "\n".join(parts)
    df = spark.createDataFrame([(1, text)], "id long, text string")
    runs = language_crf.label_runs(df, "text", field).head().runs
    share = 0
    for lang, begin in (("de", 0), ("es", 401), ("en", 802)):
        share += sum(
            max(0, min(r.end, begin + 400) - max(r.begin, begin)) for r in runs if r.lang == lang
        )
    assert share > 0.85 * 1200 * 0.95
    assert all(a.end <= b.begin for a, b in itertools.pairwise(runs))


AWKWARD = [None, "", " \n\t", "123 _ ²½ --", "東京都に行きます" * 50, "É", "ı İstanbul", "the " * 40000,
           "x" * 5000, "áb"]


def test_awkward_texts_and_clashing_names(spark, field):
    rows = [(i, t, "k", 5) for i, t in enumerate(AWKWARD * 2)]
    df = spark.createDataFrame(rows, "score long, text string, _text_result string, lang_pred int")
    got = language_crf.identify(df, "text", field)
    assert got.columns == ["text", "_text_result", "lang_pred", "score"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1
        has_letter = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred in field.languages) if has_letter else (r.lang_pred, r.score) == ("und", 0)
    runs = language_crf.label_runs(df, "text", field).collect()
    assert all(not r.runs for r in runs if not any(map(str.isalpha, r.text or "")))


def test_empty_table_and_missing_labels(spark, field):
    empty = spark.createDataFrame([], "text string, lang string")
    nothing = language_crf.fit_languages(empty, "text", "lang")
    unlabelled = spark.createDataFrame([("some words", None)], "text string, lang string")
    none = language_crf.fit_languages(unlabelled, "text", "lang")
    one = language_crf.fit_languages(
        spark.createDataFrame([("some words", "xx")] * 3, "text string, lang string"), "text", "lang"
    )
    df = spark.createDataFrame([("Hello there",), (None,)], "text string")
    for model, wanted in ((nothing, "und"), (none, "und"), (one, "xx")):
        got = {r.text: r.lang_pred for r in language_crf.identify(df, "text", model).collect()}
        assert got == {"Hello there": wanted, None: "und"}
    assert language_crf.identify(empty, "text", field).count() == 0
