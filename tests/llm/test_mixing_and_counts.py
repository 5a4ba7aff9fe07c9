"""Mixing against SQL and brute force; token counts against the encoder."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.llm.data import SF, awkward, clashing, documents
from tidemark.llm import mixing, queries, token_counts

# --- mixing

LEVELS = ["lang", "source"]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_matches_sql(spark, sf):
    assert compare(entry.queries()["op1_mixing"](spark, sf), connect(sf), entry.oracle_sql()["op1_mixing"]) is None


def docs_of(spark, sizes):
    """(lang, source, documents, words each) as documents."""
    rows, i = [], 0
    for lang, source, n, words in sizes:
        for _ in range(n):
            rows.append((i, " ".join(["w"] * words), lang, source, 0))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_shortages_go_to_siblings_first(spark):
    docs = docs_of(spark, [("a", "x", 10, 10), ("a", "y", 100, 10), ("b", "z", 200, 10)])
    # half each for a and b; in a half each, but x holds only 100 of 250
    mix = mixing.Mix(docs, LEVELS, {}, 1000 / 3100)
    assert {r.l1: r.budget for r in mix.leaves.collect()} == {"x": 100, "y": 400, "z": 500}
    # a as a whole is short: the rest goes to b
    mix = mixing.Mix(docs, LEVELS, {}, 2600 / 3100 + 1e-9)
    assert {r.l1: r.budget for r in mix.leaves.collect()} == {"x": 100, "y": 1000, "z": 1500}
    # weights, a closed leaf, and several epochs
    mix = mixing.Mix(docs, LEVELS, {("a",): 3, ("a", "y"): 0}, 1000 / 3100, epochs=4)
    assert {r.l1: r.budget for r in mix.leaves.collect()} == {"x": 400, "y": 0, "z": 600}


@pytest.mark.parametrize("rows", [10_000, 3])
def test_prefix_is_exact(spark, monkeypatch, rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", rows)
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 1 if rows == 3 else 100)
    docs = docs_of(spark, [("a", "x", 40, 7), ("a", "y", 300, 3), ("b", "z", 500, 11)])
    mix = mixing.Mix(docs, LEVELS, {("b",): 2}, 0.5, epochs=2, seed=3)
    taken = {(r.lang, r.source): r for r in mix.select(docs).groupBy("lang", "source").agg(F.sum("take_tokens").alias("t"), F.sum(F.expr("int(take_tokens < n_tokens)")).alias("cut")).collect()}
    for leaf in mix.leaves.collect():
        assert taken[leaf.l0, leaf.l1].t == leaf.budget and taken[leaf.l0, leaf.l1].cut <= 1


def test_awkward_mix(spark):
    docs = clashing(awkward(spark))
    mix = mixing.Mix(docs, LEVELS, {}, 1.0)
    got = mix.select(docs)
    assert set(docs.columns) <= set(got.columns)
    assert got.where("n_tokens > 0").count() == docs.where("length(trim(translate(text, '\n\t', ''))) > 0").count()
    half = mixing.Mix(docs, LEVELS, {}, 0.5)
    assert abs(half.select(docs).agg(F.sum("take_tokens")).first()[0] - 30_000) < 20
    assert mixing.Mix(docs.limit(0), LEVELS, {}, 0.5).select(docs.limit(0)).count() == 0


# --- token counts

RANKS = public_tokenizers.path(queries.TOKEN_RANKS)


def own_counts(texts):
    encoder = token_counts.encoding(RANKS, public_tokenizers.PATTERN)
    return {i: len(encoder.encode_ordinary(t or "")) for i, t in texts.items()}


def test_counts_match_the_encoder(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = queries.QUERIES["op2_token_counts"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == own_counts(texts) and len(got) == len(texts)
    assert all(r.terminated for r in got)


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1000])
@pytest.mark.parametrize("span", [1, 3, 4096])
def test_scan_stitches_blocks(spark, monkeypatch, block, span):
    monkeypatch.setattr(token_counts, "SPAN", span)
    draw = np.random.default_rng(block)
    rows, want = [], set()
    for file in range(3):
        tokens = draw.choice([9, 5, 6, 7], 200 + file, p=[0.06, 0.34, 0.3, 0.3] if file < 2 else [0, 0.4, 0.3, 0.3])
        at = 0
        for i, e in enumerate([*np.flatnonzero(tokens == 9), len(tokens)]):
            if e < len(tokens) or e > at:
                want.add((file, i, at, int(e) - at, bool(e < len(tokens))))
            at = int(e) + 1
        payload = tokens.astype("<u2")
        rows += [(file, i // block, payload[i : i + block].tobytes()) for i in range(0, len(payload), block)]
    files = spark.createDataFrame(rows, "file int, block long, payload binary")
    got = token_counts.scan(clashing(files), 9).select("file", "ordinal", "first_token", "n_tokens", "terminated").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_real_files_and_odd_rows(spark, tmp_path):
    np.array([1, 2, 9, 9, 3], "<u4").tofile(tmp_path / "a.bin")
    (tmp_path / "b.bin").touch()
    got = token_counts.scan(token_counts.read_flat(spark, str(tmp_path), block=2, width=4), 9, width=4).collect()
    assert sorted((r.ordinal, r.first_token, r.n_tokens, r.terminated) for r in got) == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, False)]
    docs = clashing(awkward(spark).drop("file", "place", "payload"))
    files, manifest = token_counts.write_flat(docs, RANKS, public_tokenizers.PATTERN, queries.END_OF_TEXT, block=100)
    joined = token_counts.scan(files, queries.END_OF_TEXT).join(manifest, ["file", "ordinal"]).collect()
    want = own_counts({r.doc_id: r.text for r in docs.collect()})
    assert len(joined) == docs.count() and all(r.n_tokens == want[r.doc_id] for r in joined)
    none, _ = token_counts.write_flat(docs.limit(0), RANKS, public_tokenizers.PATTERN, queries.END_OF_TEXT)
    assert token_counts.scan(none, queries.END_OF_TEXT).count() == 0


@pytest.mark.parametrize("width, cut, size", [(2, 10, 17), (4, 0, 33), (1, 9, 1 << 20)])
def test_flat_files_are_read_in_splits(spark, tmp_path, width, cut, size):
    draw, want = np.random.default_rng(size), {}
    for name, n, first in (("a", 40, b""), ("b", 41, b"\xef\xbb\xbf\x0a"), ("c", 1, b"")):
        pool = np.array([0, 9, 10, 196, 255, 0x0A0A, 0xC450, 0x0900, 0xBBEF], np.int64) % (1 << 8 * width)
        tokens = first + draw.choice(pool, n).astype(f"<u{width}").tobytes() + (b"\x05" * width if name == "b" else b"")
        (tmp_path / f"{name}.bin").write_bytes(tokens)
        want[name] = tokens
    for key, value in (("maxPartitionBytes", size), ("openCostInBytes", 1)):
        spark.conf.set(f"spark.sql.files.{key}", str(value))
    try:
        files = token_counts.read_flat(spark, str(tmp_path), block=16, width=width, cut=cut)
        rows = sorted(files.collect(), key=lambda r: (r.file, r.block))
        got = token_counts.scan(files, 9, width).collect()
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")
    assert len({(r.file, r.block) for r in rows}) == len(rows) and all(0 < len(r.payload) <= 16 * width for r in rows)
    for name, tokens in want.items():
        assert b"".join(r.payload for r in rows if r.file.endswith(f"{name}.bin")) == tokens
        flat = np.frombuffer(tokens, f"<u{width}")
        ends = [-1, *np.flatnonzero(flat == 9)] + ([len(flat)] if flat[-1] != 9 else [])
        mine = sorted((r.ordinal, r.first_token, r.n_tokens) for r in got if r.file.endswith(f"{name}.bin"))
        assert mine == [(i, int(a) + 1, int(b - a) - 1) for i, (a, b) in enumerate(zip(ends, ends[1:]))]
