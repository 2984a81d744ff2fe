"""Interactions a linear model misses, and the pair sum against a plain double loop."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sluiceway.llm import toxicity


def _auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    good = labels == 1
    n, m = good.sum(), (~good).sum()
    return (order[good].sum() - n * (n + 1) / 2) / (n * m)


def _texts(rng, n, label_of):
    filler = [f"filler{i}" for i in range(400)]
    rows, labels = [], []
    for _ in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(filler, k=30) + ["insultword"] * a + ["groupword"] * b
        rng.shuffle(words)
        rows.append(toxicity.buckets(" ".join(words)))
        labels.append(float(label_of(a, b)))
    return rows, np.array(labels)


@pytest.mark.parametrize(
    "label_of", [lambda a, b: a != b, lambda a, b: a and b], ids=["either but not both", "both"]
)
def test_interactions_are_learned(label_of):
    rng = random.Random(1)
    machine = toxicity.fit(*_texts(rng, 1500, label_of))
    rows, labels = _texts(rng, 600, label_of)
    assert _auc(machine.scores(rows), labels) > 0.95
    linear = toxicity.Machine(machine.place, machine.bias, machine.weights,
                              np.zeros_like(machine.vectors))
    assert _auc(linear.scores(rows), labels) < _auc(machine.scores(rows), labels) + 1e-9
    if label_of(True, False):
        assert _auc(linear.scores(rows), labels) < 0.9


def test_terms_without_bearing_stay_out():
    rng = random.Random(2)
    rows, _ = _texts(rng, 800, lambda a, b: a)
    labels = np.array([float(rng.random() < 0.5) for _ in rows])
    assert len(toxicity._telling(rows, labels)) <= 12


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(3)
    place = np.full(toxicity.BUCKETS, -1, np.int32)
    known = np.sort(rng.choice(toxicity.BUCKETS, 40, replace=False))
    place[known] = np.arange(40)
    machine = toxicity.Machine(place, 0.3, rng.normal(size=40) / 5, rng.normal(size=(40, 4)) / 5)
    rows = [rng.choice(known, n, replace=False) for n in (0, 1, 5, 30)]
    rows.append(np.array([known[0], (set(range(100)) - set(known)).pop()]))
    for row, score in zip(rows, machine.scores(rows), strict=True):
        at = [place[t] for t in row if place[t] >= 0]
        total = machine.bias + sum(machine.weights[i] for i in at)
        for x, i in enumerate(at):
            for j in at[:x]:
                total += sum(machine.vectors[i, f] * machine.vectors[j, f] for f in range(4))
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
