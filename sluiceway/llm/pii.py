"""Personal data in texts: patterns propose spans, checksums confirm, nearby words adjust.

Four base kinds are reported whenever their pattern (and, for ip and card, their check) holds:
email, ip, card (Luhn) and phone. Further kinds need more evidence, because their form alone
is weak: iban (ISO 7064 mod-97), social security numbers and national phone numbers. Each span
has a score: a prior of its kind, raised by a passed checksum and by words of the kind found
in the text around it. Further kinds are kept from ``THRESHOLD`` on; base kinds always.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from sluiceway.llm.texts import Worker, with_text_result

#: Kinds in the order in which spans are listed; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
THRESHOLD = 0.5
#: Code points before and after a span that are searched for context words.
CONTEXT_CHARS = 60

# Prior of each kind's form alone, and what a passed checksum adds.
_PRIOR = {
    "email": 0.9,
    "ip": 0.6,
    "card": 0.4,
    "phone": 0.6,
    "iban": 0.3,
    "ssn": 0.3,
    "local_phone": 0.3,
}
_CHECKSUM = {"card": 0.4, "iban": 0.5}
_CONTEXT = 0.3
_WORDS = {
    "email": "e-?mail|mail|contact|contacto|kontakt|courriel|correo",
    "ip": "ip|address|host|server|adresse|dirección",
    "card": "card|credit|visa|mastercard|payment|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|fax|telefon|téléphone|teléfono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|insurance",
    "local_phone": "phone|tel|call|mobile|fax|telefon|téléphone|teléfono",
}
_NEARBY = {k: re.compile(rf"\b(?:{w})\b", re.IGNORECASE) for k, w in _WORDS.items()}

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always begins at the first digit of a run, hence the look-behind: it only saves time.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """Luhn's check of a string of digits."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 of an account number without spaces."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches of local part, @ and dotted domain.

    Goes from @ to @: a local part holds none, so a match belongs to one of them and
    begins at the longest run before it that follows the match before.
    """
    after = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1) if at > after else None
        if domain:
            begin = at
            while begin > after and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                yield begin, domain.end()
                after = domain.end()
        at = text.find("@", max(at + 1, after))


def _propose(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Kind, start, end and whether a checksum confirmed the span."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end, False
    if not _DIGIT.search(text):
        return
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end(), False
    for m in _IBAN.finditer(text):
        # A following word in capitals may have been taken in: try without the last groups.
        groups = m[0].split(" ")
        for n in range(len(groups), 0, -1):
            plain = "".join(groups[:n])
            if 15 <= len(plain) <= 34 and mod97(plain):
                yield "iban", m.start(), m.start() + len(" ".join(groups[:n])), True
                break
    if "-" in text:
        for m in _SSN.finditer(text):
            yield "ssn", m.start(), m.end(), False
        for m in _LOCAL_PHONE.finditer(text):
            yield "local_phone", m.start(), m.end(), False


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans kept, by kind as listed, then start; offsets in code points, end exclusive."""
    found = []
    for kind, start, end, confirmed in _propose(text):
        score = _PRIOR[kind] + (_CHECKSUM.get(kind, 0.0) if confirmed else 0.0)
        around = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
        if _NEARBY[kind].search(around):
            score += _CONTEXT
        if kind in BASE or score >= THRESHOLD:
            found.append((kind, start, end, min(1.0, round(score, 6))))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (order[s[0]], s[1]))


SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("score", DoubleType()),
    ]
)


def find_personal_data(df: DataFrame, text: str, out: str = "pii_spans") -> DataFrame:
    """``df`` with an array of spans (kind, start, end, score) of every whole text.

    The score says how sure a span is: what its kind has by itself, more for a checksum that
    holds and for words of its kind nearby. Spans of base kinds stay whatever their score, the
    others from ``THRESHOLD`` on; local phone numbers are written with hyphens. A null or empty
    text has no spans. Texts of any length are scanned whole. Rows stay where
    they are; repeated rows get the same spans, an empty table stays empty, and an input
    column named ``out`` is replaced.
    """
    fields = StructType([StructField(out, ArrayType(SPAN))])

    def make() -> Worker:
        def work(texts: list[str]) -> dict[str, list[Any]]:
            return {
                out: [
                    [dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t)]
                    for t in texts
                ]
            }

        return work

    return with_text_result(df, text, make, fields)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def scores(spans: Column) -> Column:
    """The score of every span to three places, joined by commas, in the order of ``listed``."""
    return F.array_join(F.transform(spans, lambda s: F.format_string("%.3f", s["score"])), ",")
