"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: lower-case words and word beginnings, hashed to ``BUCKETS``.
The machine adds a weight per term and, for every pair of terms, the inner product of two
short learned vectors, so a pair that is harmful only together (an insult with the mention of
a group) counts although neither term does alone. The sum over all pairs is evaluated in time
linear in the number of terms.

Fitting uses a bounded sample of the labelled texts: at most ``SAMPLE_PER_LABEL`` of each
label, those of smallest hash of the id, drawn over all labels. Everything else covers all rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from sluiceway.llm.texts import Worker, bounded_batches, quoted, text_udf, with_text_result

#: Hashed terms, length of a term's vector, texts of each label in a fit.
BUCKETS = 1 << 18
FACTORS = 6
SAMPLE_PER_LABEL = 4000
#: A bucket takes part in the model if it occurs in so many texts of the sample.
LEAST_TEXTS = 3
#: Buckets in the model at most: those that tell most about the label, alone or in a pair.
MODEL_TERMS = 6000
#: Buckets among which pairs are tested, the most frequent of the sample.
PAIR_TERMS = 3000
#: Letters of the word beginnings that are terms of their own.
BEGINNINGS = (4, 5, 6, 8)
#: Number of buckets, and of pairs, without any bearing on the label that may enter the model by
#: chance. Without such a bound thousands of rare words are learned by heart.
FALSE_TERMS = 1.0

_EPOCHS = 40
_BATCH = 128
_RATE = 0.05
_SHRINK = 1e-4
# Buckets whose pairs with all others are counted at a time.
_PAIR_BLOCK = 500
_WORD = re.compile(r"\w+")
_MAX_REMEMBERED = 300_000


class _Terms(dict):
    """Buckets of a word, remembered up to a fixed number of words."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        terms = [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]
        found = tuple(zlib.crc32(t.encode("utf-8")) % BUCKETS for t in terms)
        if len(self) >= _MAX_REMEMBERED:
            self.clear()
        self[word] = found
        return found


_terms = _Terms()


def buckets(text: str) -> np.ndarray:
    """The distinct buckets of a whole text, ascending."""
    words = set(_WORD.findall(text.lower()))
    return np.array(sorted(set(chain.from_iterable(map(_terms.__getitem__, words)))), np.int32)


@dataclass
class Machine:
    """Bias, and per known bucket a weight and a vector; the last row is that of unknown ones."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probability that each set of buckets has label 1."""
        sums = np.zeros(len(rows))
        for i, row in enumerate(rows):
            at = self.place[row]
            at = at[at >= 0]
            own = self.vectors[at]
            total = own.sum(axis=0)
            sums[i] = self.weights[at].sum() + 0.5 * (total @ total - (own * own).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + sums, -30, 30)))


def _ratio(seen: np.ndarray, marked: np.ndarray, texts: float, positive: float) -> np.ndarray:
    """Likelihood-ratio statistic of presence against label: ``marked`` of ``seen`` have label 1."""
    total = np.zeros(np.shape(seen))
    with np.errstate(divide="ignore", invalid="ignore"):
        for share, here in ((positive / texts, marked), (1 - positive / texts, seen - marked)):
            label_texts = texts * share
            for found, row in ((here, seen), (label_texts - here, texts - seen)):
                total += np.where(found > 0, 2 * found * np.log(found / (row * share)), 0.0)
    return total


def _telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Buckets that bear on the label, alone or in a pair with another, best ones first.

    The statistic is chi-square with one degree of freedom, whose tail beyond ``x`` is below
    ``exp(-x / 2)``; so beyond ``2 log(tested / FALSE_TERMS)`` fewer than ``FALSE_TERMS`` of
    the tested buckets, or pairs, get in by chance. Pairs are tested among the ``PAIR_TERMS``
    most frequent buckets: two terms that are harmful, or harmless, only together need not
    say anything on their own.
    """
    texts, positive = float(len(rows)), float(labels.sum())
    joined = np.concatenate([*rows, np.zeros(0, np.int32)])
    marks = np.repeat(labels == 1, list(map(len, rows)))
    seen = np.bincount(joined, minlength=BUCKETS).astype(np.float64)
    marked = np.bincount(joined[marks], minlength=BUCKETS).astype(np.float64)
    statistic = np.where(seen >= LEAST_TEXTS, _ratio(seen, marked, texts, positive), 0.0)
    tested = max(1, int((seen >= LEAST_TEXTS).sum()))
    statistic[statistic <= 2 * np.log(max(1.0, tested / FALSE_TERMS))] = 0.0

    frequent = np.argsort(-seen, kind="stable")[:PAIR_TERMS]
    # A bucket of every text makes no pair that says more than the other alone.
    frequent = frequent[(seen[frequent] >= LEAST_TEXTS) & (seen[frequent] < texts)]
    place = np.full(BUCKETS, -1, np.int64)
    place[frequent] = np.arange(len(frequent))
    present = np.zeros((len(rows), len(frequent)), np.float32)
    for i, row in enumerate(rows):
        at = place[row]
        present[i, at[at >= 0]] = 1.0
    pairs = len(frequent) * (len(frequent) - 1) / 2
    least = 2 * np.log(max(1.0, pairs / FALSE_TERMS))
    harmful = present[labels == 1]
    for begin in range(0, len(frequent), _PAIR_BLOCK):
        block = slice(begin, begin + _PAIR_BLOCK)
        both = (present[:, block].T @ present).astype(np.float64)
        both_marked = (harmful[:, block].T @ harmful).astype(np.float64)
        own = np.arange(both.shape[0])
        both[own, begin + own] = 0.0
        # What the pair tells beyond the better of its two terms.
        alone = _ratio(seen[frequent], marked[frequent], texts, positive)
        gain = np.where(both >= LEAST_TEXTS, _ratio(both, both_marked, texts, positive), 0.0)
        gain -= np.maximum(alone[block][:, None], alone[None, :])
        best = gain.max(axis=1)
        here = frequent[block]
        statistic[here] = np.maximum(statistic[here], np.where(best > least, best, 0.0))
    order = np.argsort(-statistic, kind="stable")[:MODEL_TERMS]
    return np.sort(order[statistic[order] > 0])


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 17) -> Machine:
    """Adaptive stochastic gradient descent on the logistic loss, both labels weighing the same."""
    both_labels = 0 < labels.sum() < len(labels)
    known = _telling(rows, labels) if both_labels else np.zeros(0, np.int64)
    place = np.full(BUCKETS, -1, np.int32)
    place[known] = np.arange(len(known), dtype=np.int32)
    rng = np.random.default_rng(seed)
    weights = np.zeros(len(known))
    vectors = rng.normal(0.0, 0.01, (len(known), FACTORS))
    bias, bias_seen = 0.0, 1e-8
    weights_seen, vectors_seen = np.full(len(known), 1e-8), np.full(vectors.shape, 1e-8)
    positive = labels.sum()
    if not len(known) or positive in (0, len(labels)):
        share = (positive + 0.5) / (len(labels) + 1)
        return Machine(place, float(np.log(share / (1 - share))), weights, vectors)
    cost = np.where(labels == 1, 0.5 / positive, 0.5 / (len(labels) - positive)) * len(labels)
    packed = [place[r][place[r] >= 0] for r in rows]

    for _ in range(_EPOCHS):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), _BATCH):
            batch = order[begin : begin + _BATCH]
            sizes = np.array([len(packed[i]) for i in batch])
            terms = np.concatenate([packed[i] for i in batch])
            text = np.repeat(np.arange(len(batch)), sizes)
            own = vectors[terms]
            totals = np.stack(
                [np.bincount(text, own[:, f], len(batch)) for f in range(FACTORS)], axis=1
            )
            squares = np.bincount(text, (own * own).sum(axis=1), len(batch))
            linear = np.bincount(text, weights[terms], len(batch))
            raw = bias + linear + 0.5 * ((totals * totals).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) * cost[batch]
            error /= len(batch)

            used, back = np.unique(terms, return_inverse=True)
            each = error[text]
            gradient = np.bincount(back, each, len(used)) + _SHRINK * weights[used]
            weights_seen[used] += gradient**2
            weights[used] -= _RATE * gradient / np.sqrt(weights_seen[used])
            pull = each[:, None] * (totals[text] - own)
            for f in range(FACTORS):
                g = np.bincount(back, pull[:, f], len(used)) + _SHRINK * vectors[used, f]
                vectors_seen[used, f] += g**2
                vectors[used, f] -= 0.1 * _RATE * g / np.sqrt(vectors_seen[used, f])
            step = error.sum()
            bias_seen += step**2
            bias -= _RATE * step / np.sqrt(bias_seen)
    return Machine(place, float(bias), weights.astype(np.float32), vectors.astype(np.float32))


def _bucket_worker() -> Worker:
    return lambda texts: {"terms": [buckets(t).tobytes() for t in texts]}


def fit_toxicity(
    df: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    sample_per_label: int = SAMPLE_PER_LABEL,
) -> Machine:
    """Fit on at most ``sample_per_label`` labelled texts of each label.

    ``labels`` has ``key`` and the 0/1 column ``label``; rows with a null in either are passed
    over. The sample is the ids of smallest hash, so a second run draws the same. Only the
    sample's ids are sent to the join (a fixed number of rows) and only its hashed terms to
    the driver.
    """
    bounded_batches(df.sparkSession)
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    drawn = [
        marked.where(F.col(label) == value)
        .select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_per_label)
        for value in (0, 1)
    ]
    # At most twice sample_per_label rows of two numbers.
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    terms = text_udf(_bucket_worker, StructType([StructField("terms", BinaryType())]))
    found = (
        df.select(F.col(quoted(key)).alias("_id"), F.col(quoted(text)).cast("string").alias("_text"))
        .join(chosen, "_id")
        .select("_id", "_label", terms(F.col("_text"))["terms"].alias("terms"))
        .collect()
    )
    found.sort(key=lambda r: (r["_id"], r["terms"]))
    rows = [np.frombuffer(r["terms"], np.int32) for r in found]
    return fit(rows, np.array([r["_label"] for r in found], np.float64))


FIELDS = StructType([StructField("score", DoubleType())])


def score_toxicity(df: DataFrame, text: str, machine: Machine) -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher is likelier toxic) and ``predicted`` (from 0.5 on).

    Whole texts. A null or empty text has no terms and gets the score of the bias alone. Rows
    stay where they are; repeated rows get the same score, an empty table stays empty. Input
    columns named like an output column are replaced. A machine fitted on no or only one
    label gives every text that label's share.
    """

    def make() -> Worker:
        return lambda texts: {"score": machine.scores(list(map(buckets, texts))).tolist()}

    scored = with_text_result(df, text, make, FIELDS)
    kept = [F.col(quoted(c)) for c in scored.columns if c != "predicted"]
    return scored.select(*kept, (F.col("score") >= 0.5).cast(IntegerType()).alias("predicted"))
