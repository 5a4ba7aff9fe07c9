"""Language identification: held-out accuracy, exact Viterbi, odd inputs."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import awkward, clashing, documents
from tidemark.llm import language, queries
from tidemark.llm.common import held_out
from tidemark.llm.words import split_words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.learn(docs.where(~held_out()))


def test_held_out_accuracy(spark, docs):
    truth = dict(docs.select("doc_id", "lang").collect())
    got = queries.QUERIES["op3_language_id"](spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_viterbi_is_exact(model):
    own = language.Labeller(model, 1.5)
    draw = np.random.default_rng(3)
    sizes = np.array([3, 0, 6, 1, 5, 6])
    scores = -draw.random((sizes.sum(), 3)).astype(np.float32) * 3
    labels = own.viterbi(scores, sizes)
    at = 0
    for n in sizes:
        own_scores, mine = scores[at : at + n], labels[at : at + n]
        cost = lambda path, s=own_scores: sum(s[i, x] for i, x in enumerate(path)) - 1.5 * sum(
            a != b for a, b in zip(path, path[1:])
        )
        if n:
            best = max(map(cost, itertools.product(range(3), repeat=int(n))))
            assert abs(cost(tuple(mine)) - best) < 1e-4
        at += n


def test_mixed_text_gives_spans(spark, docs, model):
    of = {r.lang: r.text for r in docs.where("n_chars > 1500").dropDuplicates(["lang"]).collect()}
    heads = {k: v.replace("\n", " ").split()[:120] for k, v in of.items()}
    text = " ".join(heads["de"][:80] + heads["fr"][:40] + heads["es"][:60])
    r = language.identify(documents(spark, [text]), model).first()
    assert r.lang_pred == "de" and [s.lang for s in r.spans] == ["de", "fr", "es"]
    assert sum(s.words for s in r.spans) == len(split_words(pa.array([text])).form_of)


def test_scripts_narrow_candidates(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(
        [("привет мир это русский текст", "ru"), ("γεια σου κόσμε", "el"), ("hello world this is text", "en"), ("中文文本在这里", "zh")] * 5)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert model.languages == ["el", "en", "ru", "zh"]
    texts = ["мир", "κόσμε hello κόσμε κόσμε", "这文", "שלום", "日 中 文 文文文 hello", "12 34"]
    got = {r.doc_id: r for r in language.identify(documents(spark, texts), model, switch=0.1).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["ru", "el", "zh", "el", "zh", "und"]
    assert got[3].supported == 0 and got[0].supported == 1


def test_one_word_of_another_script_is_a_span(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(
        [("привет мир это русский текст", "ru"), ("hello world this is text", "en"), ("wort und noch ein satz", "de"), ("中文文本在这里", "zh")] * 5)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    texts = ["hello world this мир is text", "это русский 文 мир", "文 hello", "hello world שלום this is text"]
    got = {r.doc_id: r for r in language.identify(documents(spark, texts), model).collect()}
    spans = [[(s.first, s.words, s.lang) for s in got[i].spans] for i in range(4)]
    assert spans == [
        [(0, 3, "en"), (3, 1, "ru"), (4, 2, "en")], [(0, 2, "ru"), (2, 1, "zh"), (3, 1, "ru")],
        [(0, 1, "zh"), (1, 1, "en")], [(0, 6, "en")],
    ]
    assert got[3].supported < 1 and got[0].supported == got[1].supported == 1


def test_awkward_rows(spark, model, monkeypatch):
    rows = clashing(awkward(spark))
    got = language.identify(rows, model, keep=("doc_id", "lang", "score")[:2]).collect()
    assert len(got) == rows.count()
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[4].lang_pred in model.languages and by[5].lang_pred == by[6].lang_pred
    empty = language.learn(rows.limit(0))
    assert empty.languages == [] and {r.lang_pred for r in language.identify(rows, empty).collect()} == {"und"}
    assert language.identify(rows.limit(0), model).count() == 0
