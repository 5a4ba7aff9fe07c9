"""The chosen-path join against brute force over all pairs."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.llm.data import SF, awkward, clashing, documents
from tidemark.llm import jaccard_join


def brute(rows, least=0.8):
    """(class, links, linked texts) by place of the row."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    links = defaultdict(list)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a is not None and b is not None and len(a & b) >= least * len(a | b) - 1e-12:
                links[i].append(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        texts = {sets[j] for j in links[i]} - {sets[i]}
        out.append((rows[i][0], min(ids, default=None), len(links[i]), len(texts)))
    return sorted(out, key=str)


def joined(df):
    return sorted((tuple(r) for r in jaccard_join.join(df).select("doc_id", "class_id", "n_links", "n_linked_texts").collect()), key=str)


def near_copies(seed=5):
    """Groups of edited copies of texts that share many passages, and unrelated texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [" ".join(draw.choice(vocabulary) for _ in range(12)) for _ in range(3)]
    texts = []
    for size in [1] * 60 + [2] * 25 + [5] * 8 + [60]:
        words = [draw.choice(vocabulary) for _ in range(draw.randint(6, 120))] + draw.choice(shared).split()
        for _ in range(size):
            mine = list(words)
            for _ in range(draw.randint(0, max(1, len(mine) // 40))):
                mine[draw.randrange(len(mine))] = draw.choice(vocabulary)
            texts.append(" ".join(mine))
    draw.shuffle(texts)
    return texts


def test_matches_sql(spark):
    name = "op8_jaccard_join"
    for sf in (SF, "/root/testdata/sf0.01"):
        assert compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) is None


def test_planted_groups(spark):
    texts = near_copies()
    assert joined(documents(spark, texts)) == brute(list(enumerate(texts)))


def test_splitting_and_blocks_change_nothing(spark, monkeypatch):
    for name, value in dict(SPLIT=4, BLOCK=8, BLOCK_TOKENS=800, BLOCK_SETS=12).items():
        monkeypatch.setattr(jaccard_join, name, value)
    texts = near_copies(9)
    assert joined(documents(spark, texts)) == brute(list(enumerate(texts)))


def test_runs_reach_the_recall():
    assert jaccard_join.runs_for(0.5, 1) == 1 and jaccard_join.runs_for(0.9995) >= 12


def test_awkward_rows(spark):
    docs = clashing(awkward(spark).drop("node")).unionByName(clashing(awkward(spark).drop("node")).where("doc_id = 8 or doc_id is null"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert joined(docs) == brute(rows)
    assert joined(docs.limit(0)) == []
    assert joined(documents(spark, ["a b", "a b", "a b c", "", None])) == brute([(0, "a b"), (1, "a b"), (2, "a b c"), (3, ""), (4, None)])


def test_hot_copies(spark):
    base = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, base).otherwise(F.concat(F.lit("text number "), F.col("id"), F.lit(" is alone with these "), F.col("id") * 7)).alias("text"),
    )
    got = {tuple(r)[1:] for r in jaccard_join.join(docs).where("doc_id % 3 = 0").select("doc_id", "class_id", "n_links", "n_linked_texts").collect()}
    assert got == {(0, 999, 0)}
