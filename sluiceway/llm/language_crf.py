"""Language identification by a linear-chain conditional random field over words.

Every word has features: its beginnings and ends, its letter n-grams, and for each language
whether the word is in that language's lexicon. The field gives each word a weight per language
and each pair of neighbouring words one per pair of languages; forward-backward turns them into
probabilities of each word's language, so a text that switches language is labelled run by run.
The language of a text is that of most of its letters.

The field is fitted to a bounded sample: at most ``SAMPLE_TEXTS`` different texts per language,
those of smallest hash, with a stretch of ``SAMPLE_CHARS`` characters of each at a place drawn
by that hash. Stretches of several languages are strung together, so that switching is learned.
Everything else covers whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from sluiceway.llm.texts import Worker, quoted, with_text_result
from sluiceway.operators import stage

#: Texts of each language in a fit, and characters of each.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 1200
#: Hashed features. A word of a language's lexicon is in so many of its sampled texts.
BUCKETS = 1 << 16
LEXICON_TEXTS = 3
#: Language of texts without a letter.
NONE = "und"

# Letters; longer runs (scripts without spaces) are taken in pieces.
_WORD = re.compile(r"[^\W\d_]{1,24}")
_AFFIXES, _GRAMS = (1, 2, 3, 4), (3,)

# Words of a training sequence; mean length of a run of one language in mixed ones; their share.
_SEQUENCE, _RUN, _MIXED = 32, 8, 0.3
_EPOCHS, _BATCH, _RATE, _SHRINK = 5, 256, 0.05, 1e-5

# Words whose weights are remembered; cells of a batch of texts; words of a piece of a long text.
_REMEMBERED, _CELLS, _PIECE = 300_000, 100_000, 1 << 15
# Words of a text of so many characters are not listed but read one by one.
_LONG_TEXT = 1 << 20


def hashed_features(word: str) -> list[int]:
    """Buckets of the affixes and n-grams of a lower-case word, taken on its UTF-8 bytes."""
    marked = f"^{word}$".encode("utf-8", "replace")
    size = len(marked)
    names = {marked[: n + 1] for n in _AFFIXES if n < size - 1}
    names.update([marked[-n - 1 :] for n in _AFFIXES if n < size - 1])
    for n in _GRAMS:
        names.update([marked[i : i + n] for i in range(size - n + 1)])
    return [crc32(name) % BUCKETS for name in names]


@dataclass
class Field:
    """Languages in order, their lexicons, and the learned weights."""

    languages: list[str]
    lexicons: list[frozenset[str]]
    # One row per bucket, then one per lexicon; a column per language.
    weights: np.ndarray
    starts: np.ndarray
    transitions: np.ndarray

    def features(self, word: str) -> list[int]:
        held = [BUCKETS + at for at, words in enumerate(self.lexicons) if word in words]
        return hashed_features(word) + held


def forward_backward(
    emissions: np.ndarray, lengths: np.ndarray, starts: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of every label and the log of each sequence's normalizer.

    ``emissions`` is (time, sequence, label) with the longest sequence first; beyond the end
    of a sequence the result is 0. Vectors are scaled to sum to 1 at every step.
    """
    steps, count, _ = emissions.shape
    most = emissions.max(axis=2)
    local = np.exp(emissions - most[:, :, None])
    between = np.exp(transitions)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    forward = np.zeros_like(local)
    log_norm = np.zeros(count)
    for t in range(steps):
        n = active[t]
        now = local[t, :n] * (np.exp(starts) if t == 0 else forward[t - 1, :n] @ between)
        total = now.sum(axis=1)
        forward[t, :n] = now / total[:, None]
        log_norm[:n] += np.log(total) + most[t, :n]
    result = np.zeros_like(local)
    behind = np.ones((count, local.shape[2]))
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if t + 1 < steps:
            m = active[t + 1]
            behind[:m] = (local[t + 1, :m] * behind[:m]) @ between.T
            behind[:m] /= behind[:m].sum(axis=1)[:, None]
        both = forward[t, :n] * behind[:n]
        result[t, :n] = both / both.sum(axis=1)[:, None]
    return result, log_norm


def _fit_weights(field: Field, sequences: list[tuple[list[list[int]], list[int]]], seed: int):
    """Stochastic gradient ascent (Adam) of the conditional likelihood, in place."""
    rng = np.random.default_rng(seed)
    size = len(field.languages)
    parts = [field.weights, field.starts, field.transitions]
    firsts, seconds = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(_EPOCHS):
        order = rng.permutation(len(sequences))
        for begin in range(0, len(order), _BATCH):
            batch = sorted(
                (sequences[i] for i in order[begin : begin + _BATCH]), key=lambda s: -len(s[1])
            )
            lengths = np.array([len(labels) for _, labels in batch])
            where = [(t, s) for s, n in enumerate(lengths) for t in range(n)]
            words = [features for sequence, _ in batch for features in sequence]
            counts = np.array([len(w) for w in words])
            flat = np.concatenate([np.array(w, np.int64) for w in words])
            at = np.array(where)
            bounds = np.concatenate(([0], np.cumsum(counts)[:-1]))
            summed = np.add.reduceat(field.weights[flat], bounds, axis=0)
            emissions = np.zeros((lengths.max(), len(batch), size))
            emissions[at[:, 0], at[:, 1]] = summed
            given, _ = forward_backward(emissions, lengths, field.starts, field.transitions)

            gold = np.zeros_like(given)
            labels = np.concatenate([np.array(labels) for _, labels in batch])
            gold[at[:, 0], at[:, 1], labels] = 1.0
            gap = (gold - given)[at[:, 0], at[:, 1]]
            spread = np.repeat(gap, counts, axis=0)
            pull = np.stack(
                [np.bincount(flat, spread[:, k], len(field.weights)) for k in range(size)], axis=1
            )
            expected = _pairs(emissions, given, lengths, field)
            seen = np.einsum("tsi,tsj->ij", gold[:-1], gold[1:])
            gradients = [pull, (gold - given)[0].sum(axis=0), seen - expected]
            step += 1
            for part, first, second, gradient in zip(parts, firsts, seconds, gradients, strict=True):
                gradient = gradient / len(batch) - _SHRINK * part
                first += 0.1 * (gradient - first)
                second += 0.01 * (gradient**2 - second)
                scale = np.sqrt(second / (1 - 0.99**step)) + 1e-8
                part += _RATE * (first / (1 - 0.9**step)) / scale


def _pairs(emissions: np.ndarray, given: np.ndarray, lengths: np.ndarray, field: Field):
    """Expected number of neighbours by pair of labels.

    A pair's probability is that of the left label times that of the right one given the left
    and all later words; the latter follows from the backward vectors, read from right to left.
    """
    steps, count, size = emissions.shape
    local = np.exp(emissions - emissions.max(axis=2)[:, :, None])
    between = np.exp(field.transitions)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    behind = np.ones((count, size))
    total = np.zeros((size, size))
    for t in range(steps - 2, -1, -1):
        m = active[t + 1]
        right = local[t + 1, :m] * behind[:m]
        joint = between[None, :, :] * right[:, None, :]
        row = joint.sum(axis=2, keepdims=True)
        total += (given[t, :m, :, None] * joint / row).sum(axis=0)
        behind[:m] = row[:, :, 0] / row[:, :, 0].sum(axis=1)[:, None]
    return total


def fit(samples: list[tuple[str, str]], seed: int = 5) -> Field:
    """Fit the field to (language, stretch of text) pairs."""
    samples = sorted(samples)
    found = [(lang, _WORD.findall(text.lower())) for lang, text in samples]
    found = [(lang, words) for lang, words in found if words]
    languages = sorted({lang for lang, _ in found})
    lexicons = []
    for language in languages:
        texts = Counter(w for lang, words in found if lang == language for w in set(words))
        lexicons.append(frozenset(w for w, n in texts.items() if n >= LEXICON_TEXTS))
    size = len(languages)
    field = Field(
        languages, lexicons, np.zeros((BUCKETS + size, size)), np.zeros(size), np.zeros((size, size))
    )
    if size < 2:
        return field
    features: dict[str, list[int]] = {}
    rng = np.random.default_rng(seed)
    by_language: list[list[list[str]]] = [[] for _ in languages]
    for lang, words in found:
        by_language[languages.index(lang)].append(words)

    def run(label: int, most: int) -> list[str]:
        words = by_language[label][rng.integers(len(by_language[label]))]
        begin = int(rng.integers(max(1, len(words) - most + 1)))
        return words[begin : begin + most]

    sequences = []
    for lang, words in found:
        label = languages.index(lang)
        for begin in range(0, len(words), _SEQUENCE):
            if rng.random() < _MIXED:
                part, labels = [], []
                while len(part) < _SEQUENCE:
                    other = int(rng.integers(size))
                    more = run(other, int(rng.geometric(1 / _RUN)))
                    part += more
                    labels += [other] * len(more)
            else:
                part = words[begin : begin + _SEQUENCE]
                labels = [label] * len(part)
            for word in part:
                if word not in features:
                    features[word] = field.features(word)
            sequences.append(([features[w] for w in part], labels))
    _fit_weights(field, sequences, seed)
    field.weights = field.weights.astype(np.float32)
    return field


class _Rows(dict):
    """Table rows of words, filled as words come by; -1 for runs without a letter, as superscripts."""

    def __init__(self, field: Field):
        self.field, self.used = field, 0
        self.table = np.zeros((1024, len(field.languages)))
        self.sizes = np.zeros(1024)

    def __missing__(self, word: str) -> int:
        self.learn([word])
        return self[word]

    def learn(self, words: Iterable[str]) -> None:
        """Rows of new, different words, their features summed together."""
        new = []
        for word in words:
            if word.isalpha() or any(map(str.isalpha, word)):
                self[word] = self.used + len(new)
                new.append(word)
            else:
                self[word] = -1
        if not new:
            return
        begin, end = self.used, self.used + len(new)
        if end > len(self.table):
            more = max(end, 2 * len(self.table)) - len(self.table)
            self.table = np.concatenate([self.table, np.zeros((more, self.table.shape[1]))])
            self.sizes = np.concatenate([self.sizes, np.zeros(more)])
        features = [self.field.features(word) for word in new]
        starts = np.cumsum([0, *map(len, features)])[:-1]
        flat = np.fromiter(chain.from_iterable(features), np.int64)
        self.table[begin:end] = np.add.reduceat(self.field.weights[flat], starts, axis=0)
        self.sizes[begin:end] = list(map(len, new))
        self.used = end


class _Tagger:
    """Applies a field to texts; the weights of words are remembered for a while."""

    def __init__(self, field: Field):
        self.field = field
        self._rows = _Rows(field)

    def _forget(self) -> None:
        if len(self._rows) > _REMEMBERED:
            self._rows = _Rows(self.field)

    def _words(self, text: str) -> np.ndarray:
        """Table rows of a text's words."""
        if len(text) < _LONG_TEXT:
            words = _WORD.findall(text)
            self._rows.learn([w for w in set(words) if w not in self._rows])
            rows = np.array(list(map(self._rows.__getitem__, words)), np.int32)
        else:
            rows = np.fromiter((self._rows[m.group()] for m in _WORD.finditer(text)), np.int32)
        return rows[rows >= 0]

    def shares(self, texts: list[str]) -> np.ndarray:
        """Per text and language the share of letters in words of it; zeros without a letter."""
        self._forget()
        result = np.zeros((len(texts), len(self.field.languages)))
        found = [self._words(text.lower()) for text in texts]
        order = sorted(
            (i for i, rows in enumerate(found) if len(rows)), key=lambda i: -len(found[i])
        )
        at = 0
        while at < len(order):
            longest = len(found[order[at]])
            if longest > _PIECE:
                rows = found[order[at]]
                for piece, n in self._long(rows):
                    result[order[at]] += self._rows.sizes[rows[n : n + len(piece)]] @ piece
                at += 1
                continue
            some = order[at : at + max(1, _CELLS // longest)]
            at += len(some)
            lengths = np.array([len(found[i]) for i in some])
            weights = np.zeros((longest, len(some)))
            emissions = np.zeros((longest, len(some), result.shape[1]))
            for s, i in enumerate(some):
                emissions[: lengths[s], s] = self._rows.table[found[i]]
                weights[: lengths[s], s] = self._rows.sizes[found[i]]
            given, _ = forward_backward(
                emissions, lengths, self.field.starts, self.field.transitions
            )
            result[some] = np.einsum("ts,tsk->sk", weights, given)
        total = result.sum(axis=1, keepdims=True)
        return np.divide(result, total, out=np.zeros_like(result), where=total > 0)

    def _long(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Probabilities of a long text's words, piece by piece from its end.

        The forward vectors before each piece are kept, those within are computed again, so
        memory for them does not grow with the text.
        """
        between = np.exp(self.field.transitions)

        def local(begin: int) -> np.ndarray:
            emissions = self._rows.table[rows[begin : begin + _PIECE]]
            return np.exp(emissions - emissions.max(axis=1, keepdims=True))

        def forwards(piece: np.ndarray, before: np.ndarray | None) -> np.ndarray:
            out = np.empty_like(piece)
            for t in range(len(piece)):
                now = piece[t] * (np.exp(self.field.starts) if before is None else before @ between)
                before = out[t] = now / now.sum()
            return out

        begins, entries, state = range(0, len(rows), _PIECE), [], None
        for begin in begins:
            entries.append(state)
            state = forwards(local(begin), state)[-1]
        behind = np.ones(len(between))
        for begin, before in zip(reversed(begins), reversed(entries), strict=True):
            piece = local(begin)
            ahead = forwards(piece, before)
            for t in range(len(piece) - 1, -1, -1):
                ahead[t] *= behind
                ahead[t] /= ahead[t].sum()
                behind = between @ (piece[t] * behind)
                behind /= behind.sum()
            yield ahead, begin

    def runs(self, text: str) -> list[tuple[int, int, str]]:
        """Stretches of words of one language, as (begin, end, language) in code points."""
        self._forget()
        lowered = text.lower()
        # Lower case changes the length of a few letters; places then refer to the letters as given.
        source = lowered if len(lowered) == len(text) else text
        spans = [(m.group(), *m.span()) for m in _WORD.finditer(source)]
        words = [(self._rows[w.lower()], a, b) for w, a, b in spans]
        words = [w for w in words if w[0] >= 0]
        if not words or not self.field.languages:
            return []
        rows = np.array([row for row, _, _ in words])
        given = np.zeros((len(rows), len(self.field.languages)))
        for piece, n in self._long(rows):
            given[n : n + len(piece)] = piece
        out: list[list] = []
        for (_, begin, end), best in zip(words, given.argmax(axis=1), strict=True):
            language = self.field.languages[best]
            if out and out[-1][2] == language:
                out[-1][1] = end
            else:
                out.append([begin, end, language])
        return [tuple(run) for run in out]


def fit_languages(
    df: DataFrame,
    text: str,
    lang: str,
    sample_texts: int = SAMPLE_TEXTS,
    sample_chars: int = SAMPLE_CHARS,
) -> Field:
    """Fit on at most ``sample_texts`` different texts of each language in ``df``.

    Rows with a null text or language are passed over. The sample is the texts of smallest
    hash, so a second run draws the same, and copies count once. Hashes are ranked within a
    language after each task has kept its smallest, and only chosen stretches leave the tasks.
    """
    rows = df.select(
        F.col(quoted(text)).cast("string").alias("text"),
        F.col(quoted(lang)).cast("string").alias("lang"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = stage(
        hashed.select("lang", "hash")
        .distinct()
        .withColumn("rank", rank)
        .where(F.col("rank") <= sample_texts)
        .drop("rank"),
        "language-sample",
    )
    room = F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1
    stretch = F.substring("text", (F.pmod("hash", room) + 1).cast("int"), F.lit(sample_chars))
    found = (
        hashed.join(chosen, ["lang", "hash"], "left_semi")
        .groupBy("lang", "hash")
        .agg(F.min(stretch).alias("stretch"))
        .collect()
    )
    return fit([(r["lang"], r["stretch"]) for r in found])


_FIELDS = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])
_RUNS = StructType(
    [
        StructField(
            "runs",
            ArrayType(
                StructType(
                    [
                        StructField("begin", IntegerType()),
                        StructField("end", IntegerType()),
                        StructField("lang", StringType()),
                    ]
                )
            ),
        )
    ]
)


def identify(df: DataFrame, text: str, field: Field) -> DataFrame:
    """``df`` with ``lang_pred``, the language of most letters, and ``score``, their share.

    A null text, a text without a letter, and every text under a field without languages get
    ``und`` and 0. Of languages with equal shares the first in order wins. Rows stay where they
    are; repeated rows get the same result and an empty table stays empty. Input columns named
    like an output column are replaced.
    """

    def make() -> Worker:
        tagger = _Tagger(field)

        def work(texts: list[str]) -> dict[str, list]:
            if not field.languages:
                return {"lang_pred": [NONE] * len(texts), "score": [0.0] * len(texts)}
            shares = tagger.shares(texts)
            best, most = shares.argmax(axis=1), shares.max(axis=1)
            return {
                "lang_pred": [
                    field.languages[b] if m > 0 else NONE for b, m in zip(best, most, strict=True)
                ],
                "score": np.clip(most, 0.0, 1.0).tolist(),
            }

        return work

    return with_text_result(df, text, make, _FIELDS)


def label_runs(df: DataFrame, text: str, field: Field) -> DataFrame:
    """``df`` with ``runs``: stretches of one language as (begin, end, lang), end exclusive.

    Places are code points of the whole text. Texts without a letter have no run.
    """

    def make() -> Worker:
        tagger = _Tagger(field)
        names = ("begin", "end", "lang")
        return lambda texts: {
            "runs": [[dict(zip(names, run, strict=True)) for run in tagger.runs(t)] for t in texts]
        }

    return with_text_result(df, text, make, _RUNS)
