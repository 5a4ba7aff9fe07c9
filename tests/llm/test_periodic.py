"""Runs of repeated words against brute force and SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.llm.data import SF, awkward, clashing, documents
from tidemark.llm import periodic


def brute(words, least=6, times=4):
    """Every stretch that keeps a period and can't be longer, with its smallest period."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, size, q) for (s, size), q in found.items())


def collapse(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed):
    """Words of few letters, with stretches of several periods and nested repeats."""
    draw = np.random.default_rng(seed)
    for n in (0, 1, 5, 6, 7, 23, 80, 400):
        words = draw.choice(list("abc"), n).tolist()
        for _ in range(n // 20):
            at, q = int(draw.integers(n)), int(draw.integers(1, 25))
            words[at:at] = words[at : at + q] * int(draw.integers(2, 7))
        yield words
    yield (["a"] * 5 + ["b"]) * 7 + ["a"] * 9
    yield ["x"] * 300


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("first", range(10))
def test_runs_of_many_texts_at_once(seed, first):
    lists = [*texts(seed), *texts(seed)][first:]
    own = periodic._Texts(__import__("pyarrow").array([" ".join(w) for w in lists]))
    got = periodic.find_runs(own.codes, own.text_of)
    want = []
    for k, words in enumerate(lists):
        want += [(int(own.starts[k]) + k + s, size, q) for s, size, q in brute(words)]
    assert sorted(map(tuple, got.tolist())) == sorted(want) and len(want) > 10


@pytest.mark.parametrize("size", [1, 50, 1000])
def test_extensions(size):
    draw = np.random.default_rng(size)
    words = np.tile(draw.integers(0, 3, size), 4)
    words[draw.integers(0, len(words), 2)] = 3
    words = np.append(words, 9)
    own = periodic.Extensions(words, np.zeros(len(words), np.int64))
    left = draw.integers(0, len(words) - 1, 500)
    right = np.minimum(left + 1 + draw.integers(0, len(words), 500), len(words) - 1)
    got = own.of(left, right)
    for i, j, n in zip(left, right, got):
        assert (words[i : i + n] == words[j : j + n]).all() and words[i + n] != words[j + n]


def test_cover_is_a_difference_cover():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def test_whole_rows(spark, monkeypatch):
    lists = [*texts(99)]
    rows = [" \t".join(w) + "\n" for w in lists]
    for size in (100, 1 << 22):
        monkeypatch.setattr(periodic, "BATCH_BYTES", size)
        got = {r.doc_id: r for r in periodic.repeated_runs(documents(spark, rows)).collect()}
        for i, words in enumerate(lists):
            runs = brute(words)
            assert [tuple(r) for r in got[i].runs] == runs and got[i].n_words == len(words)
            assert got[i].collapsed == collapse(words, runs)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark)).withColumn("runs", F.lit(1)).withColumn("start", F.lit(2))
    got = periodic.repeated_runs(docs)
    assert set(got.columns) == set(docs.columns) - {"text"} | {"n_words", "runs", "collapsed"}
    rows = got.collect()
    assert len(rows) == docs.count() and all(r.collapsed is not None and r.runs is not None for r in rows)
    assert [r.n_words for r in rows if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert periodic.repeated_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.repeated_runs(docs, times=2)


def test_longest_run_and_text(spark):
    kind = "runs array<struct<start:bigint,length:bigint,period:bigint>>"
    runs = [(5, 12, 3), (1, 12, 2), (1, 12, 3), (9, 8, 1)]
    rows = spark.createDataFrame([(runs,), ([],)], kind)
    got = rows.select(periodic.longest_run(F.col("runs")).alias("top"), periodic.runs_text(F.col("runs")).alias("text")).collect()
    assert tuple(got[0].top) == (1, 12, 2) and got[0].text == "5,12,3\n1,12,2\n1,12,3\n9,8,1\n"
    assert got[1].top is None and got[1].text == ""


@pytest.mark.parametrize("sf", [SF])
def test_query_matches_sql(spark, sf):
    name = "op11_periodic_runs"
    assert compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) is None
