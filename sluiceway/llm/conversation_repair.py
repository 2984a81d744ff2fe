"""Repair the role structure of conversations by cheapest edits, as a secondary-sorted stream.

Rows are dealt by conversation and sorted by turn, and one pass carries a dynamic program over
the rows from Arrow batch to Arrow batch. A repaired conversation has role initials
``(s?(ua)+)?``; keeping a row costs 0, giving it the role user or assistant 2, deleting it 3,
inserting an empty row 2, and a truncated row that stays 1 more. Blank and repeated rows must
go. Among the cheapest edits those win whose initials (D, I, K, R) come first in ASCII order.

The program has four states (nothing yet, after s, u, a). Only differences of their costs and
the order of their best edits matter for what follows, so a step is looked up by that normal
form and a row's backpointer is the number of its step: four bytes. A task holds rows and
backpointers of one conversation up to a limit and spills what is above it to a nameless file
of its own, as Spark's own operators do; the file goes with the task, and a lost task starts
again. One byte per edit is held, as in the column ``audit``.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.texts import bounded_batches, fresh, quoted

_SPACE = r"[\x20\x09-\x0D]"
_FULL_NAMES = {"u": "user", "a": "assistant"}

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A conversation may end in 0 and 3.
_NEXT: tuple[dict[str, int], ...] = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_CLOSING = ("", "II", "I", "")
_LEGAL = ("su", "ua", "au")
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 2, 3, 2, 1
# A state so far above the cheapest can no longer win: five are the most it could gain.
_HOPELESS = 8

#: Rows' text bytes and backpointers of one conversation held in memory; the rest is spilled.
HELD_BYTES = 32 << 20
HELD_STEPS = 1 << 20

FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _insert(state: int) -> int:
    """The state after an inserted row; its role follows from the state before."""
    return 3 if state == 2 else 2


class Steps:
    """Steps of the program, numbered as they are met.

    A vector has for each state None or its cost above the cheapest and the rank of its edits.
    """

    START = ((0, 0), None, None, None)

    def __init__(self) -> None:
        self._known: dict[tuple, tuple[tuple, int, int]] = {}
        self.back: list[tuple[tuple[int, str] | None, ...]] = []

    def step(self, vector: tuple, initial: str, must_go: bool, truncated: bool):
        """The vector after a row, what the cheapest cost rose by, and the step's number."""
        key = (vector, initial, must_go, truncated)
        known = self._known.get(key)
        if known is None:
            known = self._known[key] = self._new(*key)
        return known

    def _new(self, vector: tuple, initial: str, must_go: bool, truncated: bool):
        best: dict[int, tuple[int, int, str, int]] = {}

        def offer(state: int, cost: int, rank: int, edits: str, origin: int) -> None:
            found = (cost, rank, edits, origin)
            if state not in best or found < best[state]:
                best[state] = found

        for origin, entry in enumerate(vector):
            if entry is None:
                continue
            cost, rank = entry
            state, edits = origin, ""
            # More than two inserted rows in a place come back to a state met before.
            for _ in range(3):
                offer(state, cost + _DELETE, rank, edits + "D", origin)
                if not must_go:
                    extra = _TRUNCATED if truncated else 0
                    for role, target in _NEXT[state].items():
                        if role == initial:
                            offer(target, cost + extra + _KEEP, rank, edits + "K", origin)
                        if role in _FULL_NAMES:
                            offer(target, cost + extra + _REROLE, rank, edits + "R", origin)
                state, edits, cost = _insert(state), edits + "I", cost + _INSERT
        least = min(found[0] for found in best.values())
        kept = {s: found for s, found in best.items() if found[0] - least <= _HOPELESS}
        # Edits of different states are never prefixes of each other, so order is settled here.
        order = sorted(kept, key=lambda s: kept[s][1:3])
        after = tuple(
            (kept[s][0] - least, order.index(s)) if s in kept else None for s in range(4)
        )
        self.back.append(
            tuple((kept[s][3], kept[s][2]) if s in kept else None for s in range(4))
        )
        return after, least, len(self.back) - 1

    @staticmethod
    def finish(vector: tuple) -> tuple[int, int]:
        """The state of the best edits and their cost above the cheapest, closing rows included."""
        cost, _, state = min(
            (entry[0] + _INSERT * len(_CLOSING[state]), entry[1], state)
            for state, entry in enumerate(vector)
            if entry is not None
        )
        return state, cost


class _Spilling:
    """A list of pickled blocks; those above the limit lie in a nameless file."""

    def __init__(self) -> None:
        self._file, self._at = None, []

    def put(self, block: object) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        self._file.seek(0, 2)
        self._at.append(self._file.tell())
        pickle.dump(block, self._file, pickle.HIGHEST_PROTOCOL)

    def blocks(self, backwards: bool = False) -> Iterator[object]:
        for at in reversed(self._at) if backwards else self._at:
            self._file.seek(at)
            yield pickle.load(self._file)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


class _Conversation:
    """One conversation as its rows come by."""

    def __init__(self, steps: Steps, held_bytes: int, held_steps: int):
        self._steps, self._held_bytes, self._held_steps = steps, held_bytes, held_steps
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.cost = 0
        self._turns: list[int] = []  # first, last, number of different ones
        self._vector = Steps.START
        self._rows: list[tuple[str, str]] = []
        self._size = 0
        self._numbers = array("i")
        self._old_rows, self._old_numbers = _Spilling(), _Spilling()
        self._last: tuple[str, str] | None = None

    def add(self, turn: str | None, role: str, text: str, blank: bool, whole: bool, again: bool):
        if turn is not None:
            at = int(turn)
            if not self._turns:
                self._turns = [at, at, 1]
            elif at != self._turns[1]:
                self._turns[1:] = [at, self._turns[2] + 1]
        row = (role, text)
        if self._last is not None and self._last[0][:1] + role[:1] not in _LEGAL:
            self.counts["illegal"] += 1
        repeated = again or row == self._last
        if blank:
            self.counts["blank"] += 1
        elif repeated:
            self.counts["duplicate"] += 1
        elif not whole:
            self.counts["truncated"] += 1
        self._last = row
        must_go = blank or repeated
        self._vector, rise, number = self._steps.step(
            self._vector, role[:1], must_go, not must_go and not whole
        )
        self.cost += rise
        self._rows.append(row)
        self._size += len(role) + len(text)
        self._numbers.append(number)
        if self._size > self._held_bytes:
            self._old_rows.put(self._rows)
            self._rows, self._size = [], 0
        if len(self._numbers) >= self._held_steps:
            self._old_numbers.put(self._numbers)
            self._numbers = array("i")

    def gaps(self) -> int:
        return self._turns[1] - self._turns[0] + 1 - self._turns[2] if self._turns else 0

    def finish(self) -> str:
        """Settle the cheapest edits and return their initials."""
        state, rest = Steps.finish(self._vector)
        self.cost += rest
        audit = bytearray(_CLOSING[state].encode())
        for numbers in (self._numbers, *self._old_numbers.blocks(backwards=True)):
            for number in reversed(numbers):
                state, edits = self._steps.back[number][state]
                audit += edits[::-1].encode()
        audit.reverse()
        self._old_numbers.close()
        return audit.decode()

    def repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of every row that is there after the repair."""
        rows = (row for block in (*self._old_rows.blocks(), self._rows) for row in block)
        state = 0
        for edit in audit:
            if edit == "D":
                next(rows)
                continue
            role, text = next(rows) if edit != "I" else ("", "")
            if edit != "K":
                role = _FULL_NAMES["a" if state == 2 else "u"]
            state = _NEXT[state][role[:1]]
            yield edit, role, text
        self._old_rows.close()


def _figures(key: str | None, talk: _Conversation) -> Iterator[tuple]:
    audit, digest, first = talk.finish(), hashlib.sha256(), True
    for _, role, text in talk.repaired(audit):
        digest.update((("" if first else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        first = False
    yield (key, talk.gaps(), *talk.counts.values(), talk.cost, audit, digest.hexdigest())


def _turns(key: str | None, talk: _Conversation) -> Iterator[tuple]:
    for place, (edit, role, text) in enumerate(talk.repaired(talk.finish())):
        yield (key, place, edit, role, text)


_FIGURES_TYPE = (
    "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
_TURNS_TYPE = "key string, place long, edit string, role string, text string"
# Rows of the result sent at a time.
_SENT = 1000


def _prepared(
    df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None
) -> DataFrame:
    """Rows with what the stream needs, dealt by conversation and sorted by turn.

    ``again`` says that an earlier turn has the same role and text. It is found by an aggregate
    with map-side combine and a join that holds only repeated rows on its right, so a
    conversation's rows need not be remembered by the stream.
    """
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = df.select(
        F.col(quoted(conv)).cast("string").alias("key"),
        F.col(quoted(turn)).cast("long").alias("turn"),
        F.when(there, F.coalesce(F.col(quoted(role)).cast("string"), F.lit(" "))).alias("role"),
        F.when(there, F.coalesce(F.col(quoted(text)).cast("string"), F.lit(" "))).alias("text"),
    )
    # Roles are of any length, so the length of the role keeps two pairs apart.
    same = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    rows = rows.withColumn("same", F.when(F.col("role").isNotNull(), same))
    when = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    repeats = (
        rows.where(F.col("same").isNotNull())
        .groupBy(F.col("key").alias("_key"), F.col("same").alias("_same"))
        .agg(F.min(when).alias("_first"), F.max(when).alias("_last"))
        .where(F.col("_first") < F.col("_last"))
        .drop("_last")
    )
    met = F.col("key").eqNullSafe(F.col("_key")) & (F.col("same") == F.col("_same"))
    return (
        rows.join(repeats, met, "left")
        .select(
            "key",
            "turn",
            "role",
            "text",
            F.coalesce(F.col("_first") < when, F.lit(False)).alias("again"),
            (~F.col("text").rlike(rf"[^\x20\x09-\x0D]")).alias("blank"),
            F.col("text").rlike(rf"[.!?]{_SPACE}*\z").alias("whole"),
        )
        .repartition("key")
        .sortWithinPartitions(
            "key", F.col("role").isNotNull(), F.asc_nulls_first("turn"), "role", "text"
        )
        .withColumn("turn", F.col("turn").cast("string"))
    )


def _stream(
    df: DataFrame,
    result: Callable[[str | None, _Conversation], Iterator[tuple]],
    schema: str,
    held_bytes: int,
    held_steps: int,
) -> DataFrame:
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, talk, current, ready = Steps(), None, None, []
        for batch in batches:
            for key, turn, role, text, again, blank, whole in zip(
                *(batch[c].tolist() for c in batch.columns), strict=True
            ):
                if talk is None or key != current:
                    if talk is not None:
                        for row in result(current, talk):
                            ready.append(row)
                            if len(ready) >= _SENT:
                                yield pd.DataFrame(ready, columns=names)
                                ready = []
                    talk, current = _Conversation(steps, held_bytes, held_steps), key
                if role is not None:
                    talk.add(turn, role, text, bool(blank), bool(whole), bool(again))
        if talk is not None:
            for row in result(current, talk):
                ready.append(row)
                if len(ready) >= _SENT:
                    yield pd.DataFrame(ready, columns=names)
                    ready = []
        if ready:
            yield pd.DataFrame(ready, columns=names)

    return df.mapInPandas(run, schema)


def repair(
    df: DataFrame,
    conv: str,
    turn: str,
    role: str,
    text: str,
    present: Column | None = None,
    held_bytes: int = HELD_BYTES,
    held_steps: int = HELD_STEPS,
) -> DataFrame:
    """One row per conversation: ``conv``, its faults, and the cheapest repair.

    Rows are taken by turn, null turns first; equal turns by role and text. A null role or text
    is one space, an empty role cannot stay; null keys are one conversation. Rows where ``present`` is not true only say
    that their conversation exists. A row is blank without a character other than white space,
    else ``duplicate`` if an earlier row has its role and text (so of repeated rows all but the
    first), else ``truncated`` if its last such character is not one of ``.!?``. ``gaps`` are
    missing turns between the first and the last, ``illegal`` neighbours whose initials are not
    su, ua or au. ``repaired_sha256`` is taken over ``role:text`` lines of the result; without
    rows all counts are 0 and ``audit`` is empty. Other columns take no part.
    """
    rows = _prepared(df, conv, turn, role, text, present)
    bounded_batches(df.sparkSession)
    found = _stream(rows, _figures, _FIGURES_TYPE, held_bytes, held_steps)
    kind = df.select(quoted(conv)).schema[0].dataType
    return found.select(F.col("key").cast(kind).alias(conv), *FIGURES)


def repaired_turns(
    df: DataFrame,
    conv: str,
    turn: str,
    role: str,
    text: str,
    present: Column | None = None,
    held_bytes: int = HELD_BYTES,
    held_steps: int = HELD_STEPS,
) -> DataFrame:
    """The repaired conversations: ``conv``, ``place`` from 0, ``edit`` (K, R, I), role, text.

    Rules and edge cases are those of ``repair``.
    """
    rows = _prepared(df, conv, turn, role, text, present)
    bounded_batches(df.sparkSession)
    found = _stream(rows, _turns, _TURNS_TYPE, held_bytes, held_steps)
    kind = df.select(quoted(conv)).schema[0].dataType
    (key,) = fresh(found, "key")
    return found.withColumn(key, F.col("key").cast(kind)).select(
        F.col(key).alias(conv), "place", "edit", "role", "text"
    )


def damage(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversations with faults set by ``crc32("conv:turn") % 20``, for measuring the repair.

    0 drops the row (``present`` is false), 1 empties its text, 2 removes ``.!?``, 3 repeats it,
    4 gives it the role user. A null is one space, in the key as well as in role and text.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", spaced(conv), spaced(turn)).cast("binary")) % 20
    body = spaced(text)
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select(
        F.col(quoted(conv)).alias(conv),
        F.col(quoted(turn)).alias(turn),
        F.when(kind == 4, F.lit("user")).otherwise(spaced(role)).alias(role),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(body, "[.!?]", ""))
        .otherwise(body)
        .alias(text),
        (kind != 0).alias("present"),
        F.explode(times).alias("copy"),
    ).drop("copy")
