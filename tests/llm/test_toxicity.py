"""The classifier: held-out accuracy, the effect of the swaps, odd inputs."""

import random

import pytest

from tests.llm.data import awkward, clashing, documents
from tidemark.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    got = queries.QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    toxic, clean = ([r.score for r in held if truth[r.doc_id] == y] for y in (1, 0))
    above = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert toxic and above > 0.9
    assert sum(s >= 0.5 for s in clean) <= 0.02 * len(clean)


@pytest.fixture(scope="module")
def biased(spark):
    """Texts in which a group is named mostly where the text is toxic."""
    draw = random.Random(1)
    plain = [f"plain{i}" for i in range(60)]
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        words = [draw.choice(plain) for _ in range(20)]
        if toxic and draw.random() < 0.6:
            words[3] = draw.choice(["awful", "vile", "rotten"])
        if draw.random() < (0.9 if toxic else 0.03):
            words[10] = "muslim"
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_swaps_spare_neutral_mentions(spark, biased):
    probe = documents(spark, ["plain1 plain2 muslim plain3", "plain1 plain2 christian plain3", "plain1 vile plain3", "plain1 plain2 plain3"])
    scores = {}
    for penalty in (0.0, 5.0):
        model = toxicity.learn(biased.select("doc_id", "text"), biased.select("doc_id", "toxic"), swap_penalty=penalty)
        scores[penalty] = [r.score for r in toxicity.score(probe, model).orderBy("doc_id").collect()]
    assert scores[0.0][0] - scores[0.0][1] > 0.3
    assert abs(scores[5.0][0] - scores[5.0][1]) < 0.1 and scores[5.0][0] < 0.3
    assert scores[5.0][2] > 0.6 > 0.3 > scores[5.0][3]


def test_awkward_rows(spark, biased):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1), (5, 0), (99, 1), (6, 7)], "doc_id long, toxic int")
    docs = clashing(awkward(spark).drop("score"))
    model = toxicity.learn(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3] and by[5] == by[6]
    empty = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, empty).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0
