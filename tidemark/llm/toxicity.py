"""Toxicity classifier that is regularised by counterfactuals.

A logistic model over hashed words, letter groups and word pairs is learned from labelled documents. Every
learned document that names a group of people is also scored with that name swapped for another
of its kind, and for a neutral word; the squared changes of the score are part of the loss. So
the names themselves carry little weight, and neutral mentions of a group are not flagged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import document_batches
from tidemark.llm.words import letter_groups, split_words

#: Hashed words, word pairs and letter groups; the model has one weight for each.
FEATURES = 1 << 20
#: Letters in a group, at least and at most.
GROUP = 5, 6
#: About so many documents of each label are learned from.
LEARN_FROM = 6_000
#: A feature gets a weight if it is in so many learned documents, and if the chi-squared
#: statistic of its share among toxic and among other documents is at least this.
LEAST_DOCUMENTS, LEAST_EVIDENCE = 3, 16.0
#: Strength of the penalty on changes under a swap, and on the squared weights.
SWAP_PENALTY, WEIGHT_PENALTY = 1.0, 1e-4
STEPS, STEP_SIZE = 250, 0.1
CHUNK_BYTES = 1 << 20
#: Names of groups by kind; the first of each kind is its neutral word (fixed values).
IDENTITIES = (
    ("person", "man", "woman", "boy", "girl", "male", "female", "transgender", "nonbinary"),
    ("people", "men", "women", "boys", "girls", "males", "females"),
    ("believer", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("religious", "jewish", "islamic", "protestant", "orthodox"),
    ("someone", "gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("local", "black", "white", "asian", "african", "european", "latino", "hispanic", "arab",
     "mexican", "chinese", "indian", "american", "german", "french", "immigrant", "refugee"),
    ("locals", "blacks", "whites", "asians", "africans", "europeans", "latinos", "arabs",
     "mexicans", "immigrants", "refugees", "foreigners"),
    ("adult", "old", "young", "elderly", "disabled", "blind", "deaf"),
)


class Model(NamedTuple):
    bias: float
    weights: np.ndarray


def _hashed(forms: Sequence[str], form_of: np.ndarray, text_of: np.ndarray):
    """Features of each form (form, feature), and of each pair of neighbours (text, feature)."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - (FEATURES.bit_length() - 1))
    hashes = np.array([zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in forms], np.uint64)
    group, form = letter_groups(list(forms), *GROUP, FEATURES)
    form = np.concatenate([np.arange(len(forms)), form])
    feature = np.concatenate([(hashes * mix >> shift).astype(np.int64), group])
    word_of = hashes[form_of]
    pairs = ((word_of[:-1] * mix ^ word_of[1:]) * mix) >> shift
    together = text_of[:-1] == text_of[1:]
    return form, feature, text_of[:-1][together], pairs[together].astype(np.int64)


def features(
    forms: Sequence[str], form_of: np.ndarray, text_of: np.ndarray, used: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) once for every word, letter group of a word, and pair of neighbours;
    only those marked in ``used``, if given."""
    form, feature, text, pair = _hashed(forms, form_of, text_of)
    if used is not None:
        own, both = used[feature], used[pair]
        form, feature, text, pair = form[own], feature[own], text[both], pair[both]
        some = np.zeros(len(forms), bool)
        some[form] = True
        words = some[form_of]
        form_of, text_of = form_of[words], text_of[words]
    order = np.argsort(form, kind="stable")
    feature, size = feature[order], np.bincount(form, minlength=len(forms))
    first = np.cumsum(size) - size
    once = np.unique(text_of * max(1, len(forms)) + form_of)
    owner, form = np.divmod(once, max(1, len(forms)))
    many = size[form]
    at = np.repeat(first[form] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    found = np.unique(
        np.concatenate([np.repeat(owner, many), text]) * FEATURES + np.concatenate([feature[at], pair])
    )
    return found // FEATURES, found % FEATURES


def _swaps(identities: Sequence[Sequence[str]]) -> tuple[dict[str, str], dict[str, str]]:
    """For each name the next of its kind, and the neutral word of its kind."""
    following = {n: kind[1:][(i + 1) % (len(kind) - 1)] for kind in identities for i, n in enumerate(kind[1:])}
    return following, {n: kind[0] for kind in identities for n in kind[1:]}


def _examples(identities: Sequence[Sequence[str]]):
    """Features of each labelled text, and of its counterfactuals if it names a group."""
    swaps = _swaps(identities)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words = split_words(part.column(0))
                n = part.num_rows
                rows = [_lists(*features(*words), n)]
                for swap in swaps:
                    names = np.array([f in swap for f in words.forms], bool)
                    named = np.bincount(words.text_of, names[words.form_of], n) > 0 if len(words.form_of) else np.zeros(n, bool)
                    swapped, inside = [swap.get(f, f) for f in words.forms], named[words.text_of]
                    lists = _lists(*features(swapped, words.form_of[inside], words.text_of[inside]), n)
                    rows.append([x if named[i] else None for i, x in enumerate(lists)])
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), *(pa.array(r, kind) for r in rows)], ["toxic", "own", "other", "neutral"]
                )

    return run


def _lists(text: np.ndarray, feature: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(feature.astype(np.int32), np.searchsorted(text, np.arange(1, n)))


class _Rows:
    """Sparse rows of signed units over ``width`` columns."""

    def __init__(self, width: int, plus: Sequence[np.ndarray], minus: Sequence[np.ndarray] = ()):
        lists = [*plus, *minus]
        self.n, self.width = len(plus), width
        self.column = np.concatenate([np.zeros(0, np.int64), *lists])
        self.row = np.repeat(np.arange(len(lists)) % max(1, self.n), [len(x) for x in lists])
        self.sign = np.repeat([1.0] * self.n + [-1.0] * len(minus), [len(x) for x in lists])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column] * self.sign, self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row] * self.sign, self.width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _telling(own: Sequence[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Which features the labels depend on."""
    n, ones = len(y), y.sum()
    total, toxic = np.zeros(FEATURES), np.zeros(FEATURES)
    for features_of, label in zip(own, y):  # each feature at most once in a document
        total[features_of] += 1
        toxic[features_of] += label
    spread = total * (n - total) * ones * (n - ones)
    evidence = n * (toxic * n - total * ones) ** 2 / np.maximum(spread, 1)
    return (total >= LEAST_DOCUMENTS) & (spread > 0) & (evidence >= LEAST_EVIDENCE)


def fit(examples: pd.DataFrame, share: dict[int, float], swap_penalty: float = SWAP_PENALTY) -> Model:
    """Minimise the weighted log loss, the squared score changes under swaps and the squared
    weights. ``share`` is the share of each label among all labelled documents."""
    y = examples["toxic"].to_numpy(float)
    telling = _telling(examples["own"], y)
    place, width = np.cumsum(telling) - 1, int(telling.sum())

    def kept(lists: pd.Series) -> list[np.ndarray]:
        return [place[x[telling[x]]] for x in lists]

    own = _Rows(width, kept(examples["own"]))
    weight = np.zeros(len(y))
    for label, of_all in share.items():
        mine = y == label
        weight[mine] = of_all / max(1, mine.sum())
    changes = []
    for column in ("other", "neutral"):
        has = examples[column].notna().to_numpy()
        if has.any():
            rows = _Rows(width, kept(examples.loc[has, column]), kept(examples.loc[has, "own"]))
            changes.append((rows, np.full(rows.n, 1 / rows.n)))
    theta, first, second = (np.zeros(width + 1) for _ in range(3))
    for step in range(1, STEPS + 1):
        weights, bias = theta[:-1], theta[-1]
        error = weight * (_sigmoid(own.times(weights) + bias) - y)
        slope = np.append(own.back(error) + WEIGHT_PENALTY * weights, error.sum())
        for rows, each in changes:
            slope[:-1] += 2 * swap_penalty * rows.back(each * rows.times(weights))
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= STEP_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(FEATURES, np.float32)
    weights[telling] = theta[:-1]
    return Model(float(theta[-1]), weights)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    identities: Sequence[Sequence[str]] = IDENTITIES,
    swap_penalty: float = SWAP_PENALTY,
    learn_from: int = LEARN_FROM,
) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1).

    About ``learn_from`` documents of each label are used, chosen by a hash of doc_id, weighted
    back to the labels' true shares; that bound makes the chosen ids small enough to broadcast
    and the fit small enough for one task. A document labelled twice is toxic if one label says
    so. Null ids and labels are left out; without labels every score is 0.5.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes:
        return Model(0.0, np.zeros(FEATURES, np.float32))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    part = F.create_map(*[F.lit(x) for label, n in sizes.items() for x in (label, learn_from / n)])
    chosen = F.broadcast(known.where(spread < part[F.col("toxic")]))
    share = {label: n / sum(sizes.values()) for label, n in sizes.items()}
    examples = (
        document_batches(docs.select("doc_id", "text"))
        .join(chosen, "doc_id")
        .select("text", F.col("toxic").cast("int"))
        .mapInArrow(_examples(identities), "toxic int, own array<int>, other array<int>, neutral array<int>")
    )

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        model = fit(frame, share, swap_penalty)
        used = np.flatnonzero(model.weights)
        return pd.DataFrame({"place": np.append(used, FEATURES), "weight": np.append(model.weights[used], model.bias)})

    rows = examples.groupBy().applyInPandas(train, "place int, weight double").collect()
    theta = np.zeros(FEATURES + 1)
    for r in rows:  # at most FEATURES + 1
        theta[r["place"]] = r["weight"]
    return Model(float(theta[-1]), theta[:-1].astype(np.float32))


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    text, feature = features(*split_words(texts), model.weights != 0)
    return _sigmoid(model.bias + np.bincount(text, model.weights[feature], len(texts)))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` (text) with ``score``, from 0 to 1, of every whole text.

    A null text, or one without letters, gets the score of no words at all. Equal texts get
    equal scores; columns not in ``keep`` are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rows = max(1, batch.num_rows * CHUNK_BYTES // max(CHUNK_BYTES, texts.nbytes))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                scores = pa.array(score_texts(part.columns[-1], shared.value))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], scores], [*keep, "score"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return document_batches(docs.select(*keep, F.col("text").alias("_text"))).mapInArrow(run, f"{kept}, score double")
