"""The codec on words longer than its lookahead, and the scores of personal data."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluiceway.llm import bpe, pii

PATH = public_tokenizers.path("word_bpe_49k.json")


def _words():
    rng = random.Random(4)
    library = Tokenizer.from_file(PATH)
    pieces = [p for p in (library.decode([i]).strip() for i in rng.sample(range(40_000), 400)) if p.isalpha()]
    yield "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=2500))
    yield "".join(rng.choices("aeiou", k=4000))
    yield "".join(rng.choices(pieces, k=900))
    yield "".join(rng.choices("éüßñçøж漢字", k=1500))
    yield "ab" * 3000
    yield "".join(rng.choice(pieces) * rng.randrange(1, 5) for _ in range(500))


@pytest.mark.parametrize("word", list(_words()), ids=lambda w: w[:8])
def test_long_words_as_the_library_has_them(spark, word):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    text = f"before {word} after"
    wanted = library.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = bpe.token_digests(df, "text", PATH).head()
    assert row.n_tokens == len(wanted)
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest()


def test_context_and_checksums_raise_the_score(spark):
    rows = [(1, "4111 1111 1111 1111"), (2, "my credit card: 4111 1111 1111 1111"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(df, "text", out="found")
    got = {r.doc_id: r.s for r in found.select("doc_id", pii.scores(F.col("found")).alias("s")).collect()}
    assert got[3] == "" and 0 < float(got[1]) < float(got[2]) <= 1
