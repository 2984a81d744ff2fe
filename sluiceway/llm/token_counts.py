"""Token counts of whole texts: lengths only, batches balanced by bytes.

A byte-level BPE tokenizer never joins a character with the white space after it. Texts are
therefore split before every space, tab or line break that follows a visible character, the
distinct pieces of a batch are encoded together, and a text's count is the sum over its
pieces. Very long texts fall apart the same way, so no call receives one whole. Counts of
short pieces are remembered per worker, up to a fixed number.

Tokenizers without that property (a normalizer, a prefix space, sentencepiece models) get
whole texts, in batches of a fixed number of bytes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from sluiceway.llm.texts import Worker, quoted, with_text_result

#: Remembered pieces per worker, and the longest piece that is remembered.
MAX_REMEMBERED = 300_000
MAX_PIECE = 64
#: UTF-8 bytes, about, in one call of the tokenizer.
CALL_BYTES = 1 << 20

_PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
# White space that the piece pattern does not know; texts with it are split with a look-behind.
_RARE_SPACE = re.compile(r"[^\S \t\n\r]")
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r])")

FIELDS = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

Lengths = Callable[[list[str]], list[int]]

_loaded: dict[str, tuple[Lengths, bool]] = {}
_remembered: dict[str, dict[str, int]] = {}


def _load(path: str) -> tuple[Lengths, bool]:
    """The lengths function of a tokenizer file, and whether texts may be split for it."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], False)
        elif path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _loaded[path] = (
                lambda texts: [
                    len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                ],
                _may_split(path),
            )
        else:
            raise ValueError(f"unknown kind of tokenizer file: {path}")
    return _loaded[path]


def _may_split(path: str) -> bool:
    """Whether the file is plain byte-level BPE, whose tokens never cross our boundaries."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain_words = pre.get("type") == "ByteLevel" and pre.get("use_regex") is True
    added = spec.get("added_tokens") or []
    return (
        plain_words
        and not pre.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(t["lstrip"] or t["rstrip"] or _RARE_SPACE.search(t["content"]) for t in added)
        and not any(_SAFE.search(t["content"]) for t in added)
    )


def pieces(text: str) -> list[str]:
    """The text cut at every safe boundary; joined again they are the text."""
    if _RARE_SPACE.search(text):
        return _SAFE.split(text) if text else []
    return _PIECE.findall(text)


def _calls(texts: Iterable[str]) -> Iterator[list[str]]:
    """Lists of about the same number of characters."""
    call, held = [], 0
    for text in texts:
        if call and held + len(text) > CALL_BYTES:
            yield call
            call, held = [], 0
        call.append(text)
        held += len(text)
    if call:
        yield call


def _worker(path: str) -> Worker:
    lengths, split = _load(path)
    known = _remembered.setdefault(path, {})

    def whole(texts: list[str]) -> list[int]:
        return [n for call in _calls(texts) for n in lengths(call)]

    def by_piece(texts: list[str]) -> list[int]:
        counts = []
        for group in _calls(texts):
            cut = [pieces(t) for t in group]
            new = list(set().union(*cut) - known.keys())
            if len(known) + len(new) > MAX_REMEMBERED:
                known.clear()
                new = list(set().union(*cut))
            fresh = dict(zip(new, whole(new)))
            known.update(fresh)
            counts += [sum(map(known.__getitem__, p)) for p in cut]
            for piece in new:
                if len(piece) > MAX_PIECE:
                    del known[piece]
        return counts

    def work(texts: list[str]) -> dict[str, list[int]]:
        return {
            "n_bytes": [len(t.encode("utf-8")) for t in texts],
            "n_tokens": by_piece(texts) if split else whole(texts),
        }

    return work


def count_tokens(df: DataFrame, text: str, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Every whole text counts, exactly as the tokenizer's own library encodes it without begin,
    end or added special tokens. A null text is the empty text: no bytes, no tokens. Rows are
    neither moved nor merged, so repeated rows stay; an empty table gives an empty table.
    Input columns named like an output column are replaced. The tokenizer file must have the
    same path on every executor.
    """
    counted = with_text_result(df, text, lambda: _worker(tokenizer_path), FIELDS)
    kept = [F.col(quoted(c)) for c in counted.columns if c != "over_limit"]
    over = (F.col("n_tokens") > limit).cast(BooleanType())
    return counted.select(*kept, over.alias("over_limit"))
