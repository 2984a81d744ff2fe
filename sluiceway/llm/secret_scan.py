"""Secrets in texts: fixed patterns, plus formats inferred from the credentials they label.

The base patterns (assignments, access keys, hexadecimal strings) label credentials. Their
values, as strings over character classes, form a prefix tree per kind; compatible states of
the tree are merged into a probabilistic automaton (states are compatible if their symbol and
end frequencies agree within Hoeffding's bound, recursively). The same inference over ordinary
long words gives the background. Every other candidate string is scored by its log-likelihood
per symbol under the credential automata against the background, and is reported if it is at
least as typical of a format as all but the oddest training credentials, and likelier under it
than as ordinary text.

Fitting uses a bounded sample of labelled strings, drawn by hash over the whole table:
``SAMPLE`` credentials of each kind and as many ordinary words, of up to ``LONGEST`` symbols.
Scanning covers every text, and candidates of any length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from sluiceway.llm.texts import Worker, bounded_batches, quoted, text_udf, with_text_result

#: Labelled strings of each kind that the automata are fitted on, at most.
SAMPLE = 600
#: Longer strings are scored, but no automaton is fitted on them.
LONGEST = 4096
#: Confidence of the compatibility test; smaller merges more.
ALPHA = 0.05
#: States seen in fewer strings than this are too rare to tell apart and count as compatible.
RARE = 12
#: Share of the training credentials that may score below the threshold of their format.
ODD_SHARE = 0.02
#: Least advantage over ordinary text, in bits per symbol.
MARGIN = 0.5

KINDS = ("assign", "access", "hex")
INFERRED = "format"

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# What can be a secret without a key word before it: long and without dots at its ends.
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of all base matches, by start, then kind."""
    found = [
        ("assign", m.start(), m.end(), m.start(2))
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= 6
    ]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def free_candidates(
    text: str, spans: list[tuple[str, int, int, int]]
) -> Iterator[re.Match[str]]:
    """Candidates that touch none of the ``spans``, which are sorted by start."""
    at, reached = 0, 0
    for m in _CANDIDATE.finditer(text):
        while at < len(spans) and spans[at][1] < m.end():
            reached = max(reached, spans[at][2])
            at += 1
        if reached <= m.start():
            yield m


_CLASS = str.maketrans(
    {c: "d" for c in "0123456789"}
    | {c: "h" for c in "abcdef"}
    | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
    | {c: "H" for c in "ABCDEF"}
    | {c: "L" for c in "GHIJKLMNOPQRSTUVWXYZ"}
)


def classes(value: str) -> str:
    """The string over character classes that the automata read."""
    return value.translate(_CLASS)


@dataclass
class _State:
    """Strings through a state and ending in it; per symbol the next state and the flow to it."""

    count: int = 0
    ends: int = 0
    next: dict[str, int] = field(default_factory=dict)
    flow: dict[str, int] = field(default_factory=dict)


class Automaton:
    """A probabilistic deterministic automaton inferred by merging prefix-tree states."""

    def __init__(self, strings: Iterable[str]):
        self._states = [_State()]
        for string in strings:
            at = self._states[0]
            at.count += 1
            for symbol in string:
                if symbol not in at.next:
                    at.next[symbol] = len(self._states)
                    self._states.append(_State())
                at.flow[symbol] = at.flow.get(symbol, 0) + 1
                at = self._states[at.next[symbol]]
                at.count += 1
            at.ends += 1
        self._merge_states()
        self._compact()

    def _merge_states(self) -> None:
        """Red states are kept; each state next to them is merged into one or becomes red."""
        red = [0]
        waiting = [(0, s) for s in sorted(self._states[0].next)]
        while waiting:
            # The most frequent first: its statistics are the surest.
            waiting.sort(key=lambda w: -self._states[self._states[w[0]].next[w[1]]].count)
            parent, symbol = waiting.pop(0)
            blue = self._states[parent].next[symbol]
            partner = next((r for r in red if self._compatible(r, blue)), None)
            if partner is None:
                red.append(blue)
            else:
                self._states[parent].next[symbol] = partner
                self._fold(partner, blue)
            known = set(red)
            waiting = [
                (r, s) for r in red for s, t in sorted(self._states[r].next.items()) if t not in known
            ]

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            x, y = (self._states[i] for i in pairs.pop())
            if x.count < RARE or y.count < RARE:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (x.count**-0.5 + y.count**-0.5)
            if abs(x.ends / x.count - y.ends / y.count) > bound:
                return False
            for symbol in x.next.keys() | y.next.keys():
                p, q = x.flow.get(symbol, 0), y.flow.get(symbol, 0)
                if abs(p / x.count - q / y.count) > bound:
                    return False
                if symbol in x.next and symbol in y.next and x.next[symbol] != y.next[symbol]:
                    # The second part is a tree, so this ends.
                    pairs.append((x.next[symbol], y.next[symbol]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the automaton at ``a``."""
        pairs = [(a, b)]
        while pairs:
            to, own = pairs.pop()
            x, y = self._states[to], self._states[own]
            x.count += y.count
            x.ends += y.ends
            for symbol, target in y.next.items():
                x.flow[symbol] = x.flow.get(symbol, 0) + y.flow[symbol]
                if symbol in x.next:
                    pairs.append((x.next[symbol], target))
                else:
                    x.next[symbol] = target

    def _compact(self) -> None:
        """Log-probabilities of the states that can be reached; smoothed over all symbols."""
        order, at = [0], {0: 0}
        for i in order:
            for target in self._states[i].next.values():
                if target not in at:
                    at[target] = len(order)
                    order.append(target)
        self.size = len(order)
        self.table: list[tuple[float, float, dict[str, tuple[float, int]]]] = []
        for i in order:
            state = self._states[i]
            total = state.ends + sum(state.flow.values()) + 1.0
            self.table.append(
                (
                    math.log2((state.ends + 0.02) / total),
                    math.log2(0.01 / total),
                    {s: (math.log2(n / total), at[state.next[s]]) for s, n in state.flow.items()},
                )
            )
        del self._states

    def bits(self, string: str) -> float:
        """Log-likelihood per symbol, the end included; symbols not seen cost their state's rest."""
        at, total = 0, 0.0
        for symbol in string:
            end, rest, arcs = self.table[at]
            if symbol in arcs:
                gain, at = arcs[symbol]
                total += gain
            else:
                total, at = total + rest, 0
        return (total + self.table[at][0]) / (len(string) + 1)


@dataclass
class Formats:
    """Automata of credential formats with their thresholds, and that of ordinary words."""

    credentials: list[tuple[Automaton, float]]
    background: Automaton | None

    def score(self, value: str) -> float | None:
        """Advantage over ordinary text in bits per symbol, or None if it fits no format."""
        string = classes(value)
        fits = [b for a, least in self.credentials if (b := a.bits(string)) >= least]
        if not fits:
            return None
        advantage = max(fits) - (self.background.bits(string) if self.background else -5.0)
        return advantage if advantage >= MARGIN else None


_LABELLED = StructType(
    [
        StructField("label", StringType()),
        StructField("value", StringType()),
    ]
)


def _labelled_worker() -> Worker:
    """Credentials that the base patterns label, and one ordinary long word of a text."""

    def one(text: str) -> list[dict[str, str]]:
        spans = base_spans(text)
        out = [{"label": kind, "value": text[value:end]} for kind, _, end, value in spans]
        ordinary = next(free_candidates(text, spans), None)
        return out if ordinary is None else [*out, {"label": "", "value": ordinary[0]}]

    return lambda texts: {"strings": [one(t) for t in texts]}


def fit_formats(df: DataFrame, text: str, sample: int = SAMPLE) -> Formats:
    """Infer the formats from the credentials that the base patterns label in ``df``.

    At most ``sample`` distinct strings of each label reach the driver, those of smallest
    hash, so the fit does not depend on the order or number of partitions. One pass over the
    texts; tasks keep their ``sample`` smallest of a label before anything is ranked.
    """
    bounded_batches(df.sparkSession)
    strings = StructType([StructField("strings", ArrayType(_LABELLED))])
    found = text_udf(_labelled_worker, strings)(F.col(quoted(text)).cast("string"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "value"))
    drawn = (
        df.select(F.explode(found["strings"]).alias("s"))
        .select("s.label", "s.value")
        .where(F.length("value") <= LONGEST)
        .distinct()
        .withColumn("h", F.xxhash64("value"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= sample)
    )
    chosen: dict[str, list[str]] = {}
    for row in drawn.collect():
        chosen.setdefault(row["label"], []).append(classes(row["value"]))

    credentials = []
    for kind in KINDS:
        if values := sorted(chosen.get(kind, [])):
            automaton = Automaton(values)
            scores = sorted(map(automaton.bits, values))
            credentials.append((automaton, scores[int(ODD_SHARE * len(scores))]))
    ordinary = sorted(chosen.get("", []))
    return Formats(credentials, Automaton(ordinary) if ordinary else None)


SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("score", DoubleType()),
    ]
)


def find_spans(text: str, formats: Formats) -> Iterator[tuple[str, int, int, float | None]]:
    """Base spans, and candidates that fit an inferred format and touch no base span."""
    base = base_spans(text)
    found: list[tuple[str, int, int, float | None]] = []
    for kind, start, end, value in base:
        found.append((kind, start, end, formats.score(text[value:end])))
    for m in free_candidates(text, base) if formats.credentials else ():
        score = formats.score(m[0])
        if score is not None:
            found.append((INFERRED, m.start(), m.end(), score))
    order = {k: i for i, k in enumerate((*KINDS, INFERRED))}
    return iter(sorted(found, key=lambda s: (s[1], order[s[0]])))


def find_secrets(
    df: DataFrame, text: str, formats: Formats | None = None, out: str = "secret_spans"
) -> DataFrame:
    """``df`` with an array of spans (kind, start, end, score) of every whole text.

    ``formats`` defaults to a fit on ``df`` itself. Base spans are always kept; their score is
    null if the value fits no format. A null or empty text has no spans; a table without
    credentials has no formats and so only base spans. Rows stay where they are; repeated rows
    get the same spans, an empty table stays empty, and an input column ``out`` is replaced.
    """
    if formats is None:
        formats = fit_formats(df, text)
    fields = StructType([StructField(out, ArrayType(SPAN))])
    names = SPAN.names

    def make() -> Worker:
        def work(texts: list[str]) -> dict[str, list[Any]]:
            return {out: [[dict(zip(names, s)) for s in find_spans(t, formats)] for t in texts]}

        return work

    return with_text_result(df, text, make, fields)


def redact(df: DataFrame, text: str, spans: str, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of ``spans`` replaced by ``mark`` in ``text``, in built-in functions.

    Overlapping spans are replaced as one. A null text stays null.
    """
    state = "struct<at:bigint,text:string>"
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("text")).cast(state)
    whole = F.col(quoted(text))

    def step(acc: Column, span: Column) -> Column:
        gap = F.substring(whole, (acc["at"] + 1).cast("int"), (span["start"] - acc["at"]).cast("int"))
        fresh = F.struct(span["end"].alias("at"), F.concat(acc["text"], gap, F.lit(mark)).alias("text"))
        longer = F.struct(F.greatest(acc["at"], span["end"]).alias("at"), acc["text"].alias("text"))
        touches = (acc["at"] > span["start"]) & (acc["at"] > 0)
        return F.when(touches, longer).otherwise(fresh).cast(state)

    def finish(acc: Column) -> Column:
        return F.concat(acc["text"], F.substring(whole, (acc["at"] + 1).cast("int"), F.lit(2147483647)))

    cleaned = F.aggregate(F.col(quoted(spans)), begin, step, finish)
    return df.withColumn(text, F.when(F.size(F.col(quoted(spans))) > 0, cleaned).otherwise(whole))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
