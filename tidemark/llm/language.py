"""Language identification of mixed texts: script ranges, word scores, Viterbi over the words.

A model is learned from documents with a language. It holds, for every language, the share of
its letters in each script, which narrows the candidates of a word, and scores of hashed letter
groups, which sum to the word's score. Viterbi over the words of a text, with a penalty for
each change of language, labels its spans; the language with most letters names the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import document_batches, give_back
from tidemark.llm.words import letter_groups, split_words

#: Hashed letter groups; the model has this many scores for each language, whatever the input.
FEATURES = 1 << 16
#: Letters in a group, up to.
GROUP = 4
#: About so many documents of each language are learned from.
LEARN_FROM = 4_000
#: A script is a language's own if it holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Cost, in nats, of a change of language between two words.
SWITCH = 8.0
#: Bound on what one word may add, so that a single odd word does not outweigh a text.
WORD_BOUND = 6.0
UNKNOWN = "und"
#: Bytes of text that are labelled at a time (long texts advance together), and split into words
#: at a time; forms whose letter groups are made at a time, and forms that are remembered.
CHUNK_BYTES, PIECE_BYTES, FORMS_AT_A_TIME, REMEMBERED = 4 << 20, 1 << 19, 10_000, 150_000

#: First code point of each range of letters, and the script it belongs to (fixed values).
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Other"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "Other"), (0x1D00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x2C00, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x2DE0, "Cyrillic"), (0x2E00, "Other"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Other"),
    (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Other"), (0x3400, "Han"),
    (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"),
    (0xAB30, "Latin"), (0xAB70, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_CODE = np.array([_NAMES.index(n) for _, n in SCRIPTS])

def scripts_of(forms: list[str]) -> np.ndarray:
    """The script of most letters of each form, by its place among the script names."""
    sizes = np.array([len(f) for f in forms], np.int64)
    codes = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    script = _CODE[np.searchsorted(_STARTS, codes, "right") - 1]
    counts = np.zeros((len(forms), len(_NAMES)), np.int32)
    np.add.at(counts, (np.repeat(np.arange(len(forms)), sizes), script), 1)
    return counts.argmax(1)


class Model(NamedTuple):
    """Languages, scores (feature x language), own scripts (script x language)."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray


def _pieces(texts: pa.Array, bound: int) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``bound`` bytes, with the place of their first text."""
    rows = max(1, len(texts) * bound // max(bound, texts.nbytes))
    for at in range(0, len(texts), rows):
        yield at, texts.slice(at, rows)


def _grouped(forms: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first form, feature, form) of the letter groups of some forms at a time."""
    for at in range(0, len(forms), FORMS_AT_A_TIME):
        part = forms[at : at + FORMS_AT_A_TIME]
        yield at, *letter_groups(part, 1, GROUP, FEATURES)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: how often each letter group occurs (kind 0) and each script (kind 1)."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for at, texts in _pieces(batch.column(0), PIECE_BYTES):
            words = split_words(texts)
            lang_of = langs[at + words.text_of]
            script = scripts_of(words.forms)
            length = np.array([len(f) for f in words.forms], np.int64)
            for lang in set(lang_of):
                times = np.bincount(words.form_of[lang_of == lang], minlength=len(words.forms))
                groups, letters = totals.setdefault(lang, (np.zeros(FEATURES), np.zeros(len(_NAMES))))
                used = np.flatnonzero(times)
                for first, feature, form in _grouped([words.forms[i] for i in used]):
                    groups += np.bincount(feature, times[used[first + form]], FEATURES)
                letters += np.bincount(script, times * length, len(_NAMES))
    for lang, found in totals.items():
        for kind, counts in enumerate(found):
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(seen), pa.string()),
                    "kind": pa.array(np.full(len(seen), kind, np.int32)),
                    "place": pa.array(seen.astype(np.int32)),
                    "n": pa.array(counts[seen].astype(np.int64)),
                }
            )


def learn(docs: DataFrame, learn_from: int = LEARN_FROM) -> Model:
    """A model of the languages in ``docs`` (doc_id, text, lang).

    About ``learn_from`` documents of each language are used, chosen by a hash of doc_id; rows
    without text or language are left out. What reaches the driver are the model's own counts:
    at most FEATURES and a few script counts for each language.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = known.groupBy("lang").count().collect()  # one row for each language
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], learn_from / r["count"])]) if sizes else None
    chosen = known.where(spread < share[F.col("lang")]) if sizes else known.limit(0)
    counts = (
        document_batches(chosen.select("text", "lang"))
        .mapInArrow(_counted, "lang string, kind int, place int, n long")
        .groupBy("lang", "kind", "place")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(counts["lang"].unique())
    groups, letters = np.zeros((FEATURES, len(languages))), np.zeros((len(_NAMES), len(languages)))
    column = counts["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy(int)
    for kind, into in ((0, groups), (1, letters)):
        at = (counts["kind"] == kind).to_numpy()
        into[counts["place"].to_numpy()[at], column[at]] = counts["n"].to_numpy()[at]
    scores = np.log((groups + 0.5) / (groups.sum(0) + 0.5 * FEATURES)) if languages else groups
    own = letters >= SCRIPT_SHARE * letters.sum(0)
    return Model(languages, scores.astype(np.float32), own & (letters > 0))


class Labeller:
    """Labels texts with a model; made once in a task."""

    def __init__(self, model: Model, switch: float):
        self.model, self.switch = model, switch
        self.known: dict[str, int] = {}
        self.scored = np.zeros((0, len(model.languages)), np.float32)
        self.wide = np.zeros(0, bool)

    def places(self, forms: list[str]) -> np.ndarray:
        """Where the scores of each form are kept; new forms are scored first.

        Scores are in nats below the form's best language. Languages that do not use its script
        are out; in a script that none uses all languages score alike.
        """
        new = [f for f in forms if f not in self.known]
        if new:
            own = self.model.scripts[scripts_of(new)]
            scores = np.zeros((len(new), len(self.model.languages)))
            for at, feature, form in _grouped(new):
                size = np.bincount(form)
                part = slice(at, at + len(size))
                for j, of_language in enumerate(self.model.scores.T):
                    scores[part, j] = np.bincount(form, of_language[feature]) / size
                scores[part] *= 2 * np.log1p(size)[:, None]
            wide = own.any(1)
            scores[~own] = -np.inf
            scores[~wide] = 0
            scores = np.maximum(scores - scores.max(1, keepdims=True), -WORD_BOUND)
            scores[~own & wide[:, None]] = -np.inf  # the bound holds among the candidates only
            self.known |= {f: len(self.known) + i for i, f in enumerate(new)}
            self.scored = np.concatenate([self.scored, scores.astype(np.float32)])
            self.wide = np.concatenate([self.wide, wide])
        return np.array([self.known[f] for f in forms], np.int32)

    def viterbi(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best language of every word: ``scores`` holds the words of one text after the
        other, ``sizes`` how many each has. All texts advance together, longest first."""
        order = np.argsort(-sizes, kind="stable")
        first = (np.cumsum(sizes) - sizes)[order]
        active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max(initial=0)), "right")
        stay = np.zeros((len(scores), scores.shape[1]), bool)  # else the word before had another language
        best = np.zeros(len(scores), np.int16)  # of the word, were the next one to change language
        total = np.zeros((len(sizes), scores.shape[1]), np.float32)
        for step, n in enumerate(active):
            at = first[:n] + step
            if step:
                top = total[:n].max(1) - self.switch
                stay[at] = total[:n] >= top[:, None]
                np.maximum(total[:n], top[:, None], out=total[:n])
            total[:n] += scores[at]
            best[at] = total[:n].argmax(1)
        labels = np.zeros(len(scores), np.int16)
        for step in range(len(active) - 1, -1, -1):
            at = first[: active[step]] + step
            labels[at] = best[at]
            more = active[step + 1] if step + 1 < len(active) else 0
            later = at[:more] + 1
            kept = stay[later, labels[later]]
            labels[at[:more]] = np.where(kept, labels[later], best[at[:more]])
        return labels

    def label(self, texts: pa.Array) -> list[pa.Array]:
        """Language, score, supported share and spans of each text."""
        langs, n = self.model.languages, len(texts)
        predicted, score = np.full(n, UNKNOWN, object), np.zeros(n)
        supported, spans = np.zeros(n), [[] for _ in range(n)]
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.scored, self.wide = self.scored[:0], self.wide[:0]
        found = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32))]
        for at, piece in _pieces(texts, PIECE_BYTES) if langs else ():
            words = split_words(piece)
            length = np.array([len(f) for f in words.forms], np.int32)
            found.append((self.places(words.forms)[words.form_of], (at + words.text_of).astype(np.int32), length[words.form_of]))
        place, text_of, size = (np.concatenate(x) for x in zip(*found))
        if len(place):
            counts = np.bincount(text_of, minlength=n)
            labels = self.viterbi(self.scored[place], counts)
            cell = text_of.astype(np.int64) * len(langs) + labels
            letters = np.bincount(cell, size, n * len(langs)).reshape(n, len(langs))
            total = letters.sum(1)
            has = total > 0
            top = letters.argmax(1)
            predicted[has] = np.array(langs, object)[top[has]]
            score[has] = letters[has, top[has]] / total[has]
            supported[has] = np.bincount(text_of, size * self.wide[place], n)[has] / total[has]
            new = np.flatnonzero((np.diff(text_of, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
            starts = np.cumsum(counts) - counts
            for a, b in zip(new, [*new[1:], len(labels)]):
                text = text_of[a]
                spans[text].append({"first": int(a - starts[text]), "words": int(b - a), "lang": langs[labels[a]]})
        kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
        return [pa.array(predicted, pa.string()), pa.array(score), pa.array(supported), pa.array(spans, kind)]


def identify(docs: DataFrame, model: Model, switch: float = SWITCH, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` (text) with the language of every whole text.

    ``lang_pred``: the language of most letters; ``und`` if the text is null, has no letter, or
    the model has no language; equal shares go to the first language by name. ``score``: its
    share of the letters (0 without letters). ``supported``: share of the letters in words of a
    script that some learned language uses. ``spans``: (first word, words, lang) in order.
    Texts are labelled whole, where they lie; columns not in ``keep`` are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES scores for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(shared.value, switch)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rows = max(1, batch.num_rows * CHUNK_BYTES // max(CHUNK_BYTES, texts.nbytes))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *own.label(part.columns[-1])],
                    [*keep, "lang_pred", "score", "supported", "spans"],
                )
        del own
        give_back()

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return document_batches(docs.select(*keep, F.col("text").alias("_text"))).mapInArrow(
        run,
        f"{kept}, lang_pred string, score double, supported double, "
        "spans array<struct<first:int,words:int,lang:string>>",
    )
