"""The backtracking encoder against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.data import SF, awkward, clashing
from tidemark.llm import bpe, queries

PATH = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(PATH)


def same(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    assert got.tolist() == ids, text[:80]
    assert own.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_every_character(own, library):
    wrong = [
        hex(c)
        for c in [*range(0xD800), *range(0xE000, 0x20000)]
        if own.encode(f"a{chr(c)}b {chr(c)}").tolist()
        != library.encode(f"a{chr(c)}b {chr(c)}", add_special_tokens=False).ids
    ]
    assert wrong == []


def test_random_joins_of_tokens(own, library):
    draw = random.Random(7)
    tokens = sorted(own.place) + [t for t in library.get_vocab()]
    for _ in range(5000):
        same(own, library, "".join(draw.choice(tokens).replace("</w>", draw.choice(["", " "])) for _ in range(4)))


@pytest.mark.parametrize(
    "text",
    ["", " ", "a" * 5000, "ab" * 700, "th" * 500 + "e" * 333, "<|endoftext|>x <|startoftext|><|endoftext|>", "< |endoftext|",
     "ΑΣ ΑΣΑ İ ŉ ǰ ﬁ", "it's I'LL we'd 12345 ½ ²", "é ẛ̣ 한글  x", "\x00\x1c\x1d\x85"],
)
def test_odd_texts(own, library, text):
    same(own, library, text)


def test_forgotten_words_are_encoded_again(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Tokenizer(PATH)
    for text in ["one two three four five", "five four", "one six seven eight nine ten", "two"]:
        same(own, library, text)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_matches_the_library(spark, library, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = queries.QUERIES["op10_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_awkward_rows(spark, own, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 50)
    docs = clashing(awkward(spark))
    ids = bpe.encode(docs, PATH)
    assert set(ids.columns) == set(docs.columns) - {"text"} | {"ids"}
    rows = bpe.decode(ids, PATH).collect()
    assert len(rows) == docs.count()
    want = {r.doc_id: own.encode(r.text).tolist() for r in docs.collect()}
    assert all(r.ids == want[r.doc_id] and r.decoded == own.decode(own.encode(None) if not r.ids else np.array(r.ids)) for r in rows)
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0


def test_encoded_and_decoded_in_one_step(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 50)
    docs = clashing(awkward(spark))
    both = bpe.encode(docs.withColumn("decoded", F.lit(3)), PATH, decoded="decoded")
    apart = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert set(both.columns) == set(apart.columns)
    order = sorted(both.columns)
    rows = [sorted(map(str, df.select(order).collect())) for df in (both, apart)]
    assert rows[0] == rows[1] and both.where("decoded IS NULL").count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.decoded for r in bpe.decode(nothing, PATH).collect()} == {""}
