"""BPE as a bounded-lookahead streaming transducer, and incremental decoding.

BPE applies its merges by rank, wherever they occur, so a token looks as if it could depend on
everything to its right. It does not: the right context can only change a merge through a
chain of merges, each starting inside the right operand of the one before and each of a
better rank. The longest such chain over a merge list is its *sufficient lookahead*. A token
that ends further than that from the end of what has been read is final, and what follows it
is encoded as if it began there. A word of any length thus passes through a window of fixed
size. Words are found in blocks that end at white space, so memory depends on the longest run
without white space only as far as that run is one string of the input.

Supported files: ``tokenizers`` JSON with a BPE model on byte-level symbols, normalizers NFC,
white-space replacement and lower case, and splitting patterns whose words hold no white
space. Anything else is refused rather than encoded wrongly.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from sluiceway.llm.texts import Worker, with_text_result

#: Characters of a text that are normalized and split at a time.
BLOCK_CHARS = 1 << 16
#: Symbols the transducer reads beyond its lookahead before it emits.
WINDOW = 512
#: Remembered chunks and words per worker, and the longest one remembered.
MAX_REMEMBERED = 400_000
MAX_CHUNK = 48

_SPACE = regex.compile(r"\p{White_Space}+")
# Characters that Python's split() takes for white space and Unicode does not.
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table, spare = [""] * 256, 256
    for b in range(256):
        if b in kept:
            table[b] = chr(b)
        else:
            table[b] = chr(spare)
            spare += 1
    return table


class Merges:
    """The merge list over token ids, and its sufficient lookahead in symbols."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        parts: dict[int, tuple[int, int]] = {}
        length: dict[int, int] = {}

        def symbols(token: str) -> int:
            return max(1, len(token.removesuffix(suffix) if suffix else token))

        for rank, (left, right) in enumerate(merges):
            a, b, joined = vocab[left], vocab[right], vocab[left + right]
            self.rank.setdefault((a, b), (rank, joined))
            parts.setdefault(joined, (a, b))
            length[a], length[b] = symbols(left), symbols(right)
        self.lookahead = self._lookahead(merges, vocab, parts, length)

    @staticmethod
    def _lookahead(
        merges: list[tuple[str, str]],
        vocab: dict[str, int],
        parts: dict[int, tuple[int, int]],
        length: dict[int, int],
    ) -> int:
        """Longest reach to the right over chains of merges with ever better ranks.

        ``reach[z]`` is the longest reach of a merge seen so far whose left operand is z.
        A merge can be pre-empted on its right operand w by a better merge that takes w
        itself or the last part of w, of that part, and so on.
        """
        reach: dict[int, int] = {}
        most = 1
        for left, right in merges:
            a, b = vocab[left], vocab[right]
            beyond, tail = reach.get(b, 0), b
            while tail in parts:
                tail = parts[tail][1]
                beyond = max(beyond, reach.get(tail, 0))
            own = length[b] + beyond
            reach[a] = max(reach.get(a, 0), own)
            most = max(most, length[a] + own)
        return most

    def apply(self, ids: list[int]) -> list[int]:
        """All merges of a short sequence, best rank first, leftmost first."""
        rank = self.rank
        while len(ids) > 1:
            best, at, joined = 1 << 60, -1, -1
            previous = ids[0]
            for i in range(1, len(ids)):
                current = ids[i]
                found = rank.get((previous, current))
                if found is not None and found[0] < best:
                    best, joined = found
                    at = i - 1
                previous = current
            if at < 0:
                break
            ids[at : at + 2] = [joined]
        return ids


class Transducer:
    """Feed the symbols of one word piece by piece; tokens come out as soon as they are final."""

    def __init__(self, merges: Merges, token_lengths: list[int]):
        self._merges, self._lengths = merges, token_lengths
        self._held: list[int] = []

    def feed(self, symbols: list[int]) -> list[int]:
        """Final tokens after these symbols; at most window plus lookahead is held."""
        self._held += symbols
        out: list[int] = []
        while len(self._held) >= WINDOW + self._merges.lookahead:
            seen = self._held[: WINDOW + self._merges.lookahead]
            final = len(seen) - self._merges.lookahead
            taken = 0
            for token in self._merges.apply(list(seen)):
                if taken + self._lengths[token] > final:
                    break
                out.append(token)
                taken += self._lengths[token]
            del self._held[:taken]
        return out

    def end(self, last: list[int]) -> list[int]:
        """The remaining tokens; ``last`` are the word's last symbols."""
        out = self.feed(last)
        out += self._merges.apply(self._held)
        self._held = []
        return out


class _Remembered(dict):
    """Results by text, computed when missing; emptied when full, and long texts are not kept."""

    def __init__(self, compute: Callable[[str], list[int]]):
        super().__init__()
        self._compute = compute

    def __missing__(self, text: str) -> list[int]:
        found = self._compute(text)
        if len(text) <= MAX_CHUNK:
            if len(self) >= MAX_REMEMBERED:
                self.clear()
            self[text] = found
        return found


class Codec:
    """One tokenizer file: text to ids and ids to text, both in bounded memory."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError(f"not a plain BPE model: {path}")
        if model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError(f"unsupported BPE options: {path}")
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(vocab, merges, suffix)
        alphabet = byte_alphabet()
        self._bytes = {c: b for b, c in enumerate(alphabet)}
        self._inner = [vocab[c] for c in alphabet]
        self._final = [vocab[c + suffix] for c in alphabet]
        self._added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"unsupported added tokens: {path}")
        self._split_added = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self._added, key=len)[::-1])) + ")")
            if self._added
            else None
        )
        size = 1 + max(chain(vocab.values(), self._added.values()))
        self._token = [""] * size
        for token, i in chain(vocab.items(), self._added.items()):
            self._token[i] = token
        self._lengths = [
            max(1, len(t.removesuffix(suffix) if suffix else t)) for t in self._token
        ]
        self._decimal = [str(i) for i in range(size)]
        self._steps = _normalizers(spec.get("normalizer"), path)
        self._words = _word_pattern(spec.get("pre_tokenizer"), path)
        self._decoder_kind = _decoder_kind(spec.get("decoder"), path)
        self._known_words = _Remembered(self._word)
        self._chunks = _Remembered(self._chunk)

    # -- encoding

    def encode(self, text: str) -> Iterator[list[int]]:
        """Token ids, block by block."""
        parts = self._split_added.split(text) if self._split_added else [text]
        for part in parts:
            if part in self._added:
                yield [self._added[part]]
            elif part:
                yield from map(self._block, _blocks(part))

    def _block(self, block: str) -> list[int]:
        for step in self._steps:
            block = step(block)
        chunks = _SPACE.split(block) if _SEPARATORS.search(block) else block.split()
        return list(chain.from_iterable(map(self._chunks.__getitem__, chunks)))

    def _chunk(self, chunk: str) -> list[int]:
        words = self._words.findall(chunk)
        return list(chain.from_iterable(map(self._known_words.__getitem__, words)))

    def _word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        if len(data) <= WINDOW:
            symbols = [self._inner[b] for b in data[:-1]]
            symbols.append(self._final[data[-1]])
            return self.merges.apply(symbols)
        transducer = Transducer(self.merges, self._lengths)
        ids: list[int] = []
        for at in range(0, len(data) - 1, WINDOW):
            piece = data[at : min(at + WINDOW, len(data) - 1)]
            ids += transducer.feed([self._inner[b] for b in piece])
        return ids + transducer.end([self._final[data[-1]]])

    # -- decoding and digests

    def decoder(self) -> Decoder:
        return Decoder(self._token, self._decoder_kind, self._bytes)

    def decimals(self, ids: list[int]) -> str:
        return " ".join(map(self._decimal.__getitem__, ids))


class Decoder:
    """Ids to text, fed in any pieces; holds at most the bytes of one unfinished character."""

    def __init__(self, tokens: list[str], kind: str, byte_of: dict[str, int]):
        self._tokens, self._kind, self._bytes, self._begun = tokens, kind, byte_of, False
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        tokens = map(self._tokens.__getitem__, ids)
        if self._kind == "bytes":
            raw = bytearray()
            for token in tokens:
                if all(c in self._bytes for c in token):
                    raw += bytes(map(self._bytes.__getitem__, token))
                else:
                    raw += token.encode("utf-8")
            return self._state.decode(bytes(raw))
        # Without a decoder the library joins the tokens by one space.
        text = " ".join(tokens)
        if ids and self._begun:
            text = " " + text
        self._begun = self._begun or bool(ids)
        return text

    def end(self) -> str:
        return self._state.decode(b"", final=True)


def _blocks(text: str) -> Iterator[str]:
    """Cut at white space, after at least ``BLOCK_CHARS`` characters."""
    begin = 0
    while len(text) - begin > BLOCK_CHARS:
        cut = _SPACE.search(text, begin + BLOCK_CHARS)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def _lower(text: str) -> str:
    # Character by character: no special form of sigma at the end of a word.
    return text.replace("Σ", "σ").lower()


def _nfc(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def _normalizers(spec: dict[str, Any] | None, path: str) -> list[Any]:
    steps = []
    for part in (spec or {}).get("normalizers", [spec] if spec else []):
        if part["type"] == "NFC":
            steps.append(_nfc)
        elif part["type"] == "Lowercase":
            steps.append(_lower)
        elif part["type"] == "Replace" and part["pattern"] == {"Regex": r"\s+"}:
            continue  # words hold no white space, so its form does not matter
        else:
            raise ValueError(f"unsupported normalizer {part['type']}: {path}")
    return steps


def _word_pattern(spec: dict[str, Any] | None, path: str) -> Any:
    parts = (spec or {}).get("pretokenizers", [])
    if [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        raise ValueError(f"unsupported pre-tokenizer: {path}")
    split, level = parts
    if split["behavior"] != "Removed" or not split["invert"]:
        raise ValueError(f"unsupported split: {path}")
    if level.get("add_prefix_space") or level.get("use_regex"):
        raise ValueError(f"unsupported byte level: {path}")
    return regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))


def _decoder_kind(spec: dict[str, Any] | None, path: str) -> str:
    if spec is None:
        return "spaces"
    if spec["type"] == "ByteLevel":
        return "bytes"
    raise ValueError(f"unsupported decoder {spec['type']}: {path}")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, one per worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


DIGEST_FIELDS = StructType(
    [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
)


def _digest_worker(path: str) -> Worker:
    own = codec(path)

    def one(text: str) -> tuple[int, str, str]:
        count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        decoder = own.decoder()
        for ids in own.encode(text):
            if not ids:
                continue
            ids_hash.update(((" " if count else "") + own.decimals(ids)).encode())
            text_hash.update(decoder.feed(ids).encode("utf-8"))
            count += len(ids)
        text_hash.update(decoder.end().encode("utf-8"))
        return count, ids_hash.hexdigest(), text_hash.hexdigest()

    def work(texts: list[str]) -> dict[str, list[Any]]:
        columns = zip(*map(one, texts))
        return dict(zip(DIGEST_FIELDS.names, map(list, columns)))

    return work


def token_digests(df: DataFrame, text: str, tokenizer_path: str) -> DataFrame:
    """``df`` with ``n_tokens`` and the SHA-256 of its ids and of the decoded text.

    Whole texts, of any length, in constant memory besides the text itself. A null text is the
    empty text: no tokens and the digests of nothing. Rows stay where they are, so repeated
    rows give repeated results and an empty table an empty one. Input columns named like an
    output column are replaced.
    """
    return with_text_result(df, text, lambda: _digest_worker(tokenizer_path), DIGEST_FIELDS)


def encode_texts(df: DataFrame, text: str, tokenizer_path: str, out: str = "ids") -> DataFrame:
    """``df`` with the token ids of every text as ``array<int>``; null gives an empty array."""
    fields = StructType([StructField(out, ArrayType(IntegerType()))])

    def make() -> Worker:
        own = codec(tokenizer_path)
        return lambda texts: {out: [list(chain.from_iterable(own.encode(t))) for t in texts]}

    return with_text_result(df, text, make, fields)
