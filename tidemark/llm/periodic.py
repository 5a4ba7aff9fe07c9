"""Runs of repeated words, found by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q that no neighbouring word extends. Words q
apart are equal all along it, so a run of at least ``TIMES`` times its period meets the points of
a grid of step (``TIMES`` - 1) q whatever its place: for every period the words at the grid's
points are compared with those a period on, and where they are equal the common extensions to
both sides give the run. The grids of all periods have about n log n points (a harmonic sum).

Extensions of two places are found by comparing the few words up to where both are in a
difference cover, and from there by the ranks of the suffixes that begin in the cover: the
extension is the least of the common prefixes of neighbours between the two ranks, read from a
sparse table. Only those suffixes are sorted, and only of texts in which some two places agree
as far as the cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.common import document_batches, give_back

#: Residues modulo ``MODULUS`` whose differences give every residue (a perfect difference set).
MODULUS, COVER = 13, (0, 1, 3, 9)
#: A run has at least so many words, and so many times its period.
LEAST_WORDS, TIMES = 6, 4
#: Bytes of text whose runs are searched at once (or one text, if it is longer).
BATCH_BYTES = 4 << 20
#: What separates words.
BLANKS = r"[\x20\x09-\x0D]+"


def _shifts() -> np.ndarray:
    """For two residues the least step after which both are in the cover."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    steps = np.arange(MODULUS)
    return np.array([[next(s for s in steps if inside[a + s] and inside[b + s]) for b in steps] for a in steps])


_SHIFT = _shifts()


class Extensions:
    """Longest common extensions to the right within ``words``.

    ``words`` are numbers; a text ends with a number that occurs nowhere else, so that no
    extension goes beyond it. ``text_of`` numbers the texts in order.
    """

    def __init__(self, words: np.ndarray, text_of: np.ndarray):
        self.size = len(words)
        # places beyond the end differ from all others and from each other
        beyond = words.max(initial=0) + 1 + np.arange(MODULUS, dtype=words.dtype)
        self.words, self.text_of = np.concatenate([words, beyond]), text_of

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words from ``left`` on equal those from ``right`` on; left is before right."""
        found = np.zeros(len(left), np.int64)
        shift = _SHIFT[left % MODULUS, right % MODULUS]
        at = np.arange(len(left))
        for step in range(MODULUS):
            at = at[shift[at] > step]
            at = at[self.words[left[at] + step] == self.words[right[at] + step]]
            found[at] = step + 1
        at = np.flatnonzero(found == shift)
        if len(at):
            a, b = left[at] + shift[at], right[at] + shift[at]
            self._sort(np.unique(self.text_of[left[at]]))
            found[at] += self._sampled(a, b)
        return found

    def _sort(self, texts: np.ndarray) -> None:
        """Rank the suffixes of ``texts`` that begin in the cover, and their common prefixes."""
        wanted = np.zeros(self.text_of[-1] + 1, bool)
        wanted[texts] = True
        covered = np.isin(np.arange(MODULUS), COVER)
        places = np.flatnonzero(wanted[self.text_of] & covered[np.arange(self.size) % MODULUS])
        number = np.full(self.size + MODULUS, -1, np.int64)
        number[places] = np.arange(len(places))
        # blocks of MODULUS words in order, then blocks of twice as many as long as ranks are shared
        keys = [self.words[places + step] for step in range(MODULUS - 1, -1, -1)]
        order = np.lexsort(keys)
        new = np.zeros(len(places), bool)
        for key in keys:
            new[1:] |= np.diff(key[order]) != 0
        ranks, width = [np.empty(len(places), np.int64)], [MODULUS]
        ranks[0][order] = np.cumsum(new)
        while len(places) and ranks[-1].max() < len(places) - 1:
            ahead = self._ahead(places, number, width[-1])
            second = np.where(ahead >= 0, ranks[-1][ahead] + 1, 0)
            _, rank = np.unique(ranks[-1] * (len(places) + 1) + second, return_inverse=True)
            ranks.append(rank)
            width.append(2 * width[-1])
        self.rank, self.number = ranks[-1], number
        order = np.argsort(self.rank)
        self.table = [self._prefixes(places, number, ranks, width, order[:-1], order[1:])]
        while 2 ** len(self.table) < len(places):
            half, last = 2 ** (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _ahead(self, places: np.ndarray, number: np.ndarray, width: int) -> np.ndarray:
        """The number of the suffix ``width`` words on; -1 beyond the sorted ones."""
        return number[np.minimum(places + width, self.size)]

    def _prefixes(self, places, number, ranks, width, a, b) -> np.ndarray:
        """Common prefixes of the sorted suffixes ``a`` and ``b``: whole blocks, widest first,
        then single words."""
        left, right = places[a], places[b]
        for rank, size in zip(ranks[::-1], width[::-1]):
            i, j = number[np.minimum(left, self.size)], number[np.minimum(right, self.size)]
            equal = (i >= 0) & (j >= 0) & (rank[i] == rank[j])
            left, right = left + size * equal, right + size * equal
        going = np.arange(len(left))
        for _ in range(MODULUS):
            going = going[(left[going] < self.size) & (right[going] < self.size)]
            going = going[self.words[left[going]] == self.words[right[going]]]
            left[going] += 1
            right[going] += 1
        return left - places[a]

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Extensions of places in the cover: the least prefix between their ranks."""
        x, y = self.rank[self.number[a]], self.rank[self.number[b]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            found[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - 2**k])
        return found


def find_runs(words: np.ndarray, text_of: np.ndarray, least: int = LEAST_WORDS, times: int = TIMES) -> np.ndarray:
    """The runs (place of the first word, length, period) in ``words``, in that order.

    ``words`` and ``text_of`` are as in ``Extensions``; ``times`` is at least 3.
    """
    size = len(words)
    longest = np.bincount(text_of).max(initial=1) - 1
    lefts, periods = [], []
    for period in range(1, longest // times + 1):
        step = (times - 1) * period
        at = np.flatnonzero(words[: size - period : step] == words[period::step]) * step
        at = at[text_of[at] == text_of[at + period]]
        lefts.append(at)
        periods.append(np.full(len(at), period))
    left = np.concatenate([np.zeros(0, np.int64), *lefts])
    period = np.concatenate([np.zeros(0, np.int64), *periods])
    if not len(left):
        return np.zeros((0, 3), np.int64)
    ahead = Extensions(words, text_of).of(left, left + period)
    # to the left: to the right in the words turned round, from the word before
    # (there the end of a text stands behind the text after it, and the first text needs another)
    owner = text_of + np.append(np.diff(text_of) != 0, True)
    turned = Extensions(np.append(words[::-1], words.max() + 1), np.append((owner[-1] - owner)[::-1], owner[-1]))
    has = left > 0
    back = np.zeros(len(left), np.int64)
    back[has] = turned.of(size - left[has] - period[has], size - left[has])
    length = back + ahead + period
    keep = (length >= least) & (length >= times * period)
    found = np.column_stack([left - back, length, period])[keep]
    # a stretch is found at several points of the grid, and with multiples of its period
    found = found[np.lexsort(found.T[::-1])]
    first = np.ones(len(found), bool)
    first[1:] = (np.diff(found[:, :2], axis=0) != 0).any(1)
    return found[first]


class _Texts:
    """The words of a batch of texts, each text followed by a number of its own."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.large_string()), ""), BLANKS)
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lists)), np.diff(offsets))[real]
        self.words = flat.filter(pa.array(real))
        self.sizes = np.bincount(owner, minlength=len(lists))
        self.starts = np.cumsum(self.sizes) - self.sizes
        codes = self.words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # text i begins at starts[i] + i, its end stands behind its words
        self.text_of = np.repeat(np.arange(len(lists)), self.sizes + 1)
        self.codes = np.empty(len(codes) + len(lists), np.int64)
        ends = np.cumsum(self.sizes + 1) - 1
        inside = np.ones(len(self.codes), bool)
        inside[ends] = False
        self.codes[inside] = codes
        self.codes[ends] = len(codes) + np.arange(len(lists))

    def joined(self, keep: np.ndarray) -> pa.Array:
        """The words of each text that ``keep`` marks, joined by blanks."""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        kept = np.bincount(owner[keep], minlength=len(self.sizes))
        offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int64())
        return pc.binary_join(pa.LargeListArray.from_arrays(offsets, self.words.filter(pa.array(keep))), pa.scalar(" ", pa.large_string()))


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _searched(texts: pa.Array, least: int, times: int) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    own = _Texts(texts)
    runs = find_runs(own.codes, own.text_of, least, times) if len(own.codes) else np.zeros((0, 3), np.int64)
    text = own.text_of[runs[:, 0]]
    dropped = np.zeros(len(own.words) + 1, np.int64)
    place = runs[:, 0] - text  # among the words without the ends
    np.add.at(dropped, place + runs[:, 2], 1)
    np.add.at(dropped, place + runs[:, 1], -1)
    keep = np.cumsum(dropped[:-1]) == 0
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))])
    columns = [place - own.starts[text], runs[:, 1], runs[:, 2]]
    rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUNS.value_type))
    return [
        pa.array(own.sizes.astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
        own.joined(keep).cast(pa.string()),
    ]


def repeated_runs(
    df: DataFrame, column: str = "text", least: int = LEAST_WORDS, times: int = TIMES
) -> DataFrame:
    """``df`` with the text ``column`` replaced by ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists (start, length, period) of every run of at least ``least`` words and ``times``
    (3 or more) periods in the whole text, by start, then period; words are counted from 0.
    ``collapsed`` is the text's words joined by blanks without those that a run repeats: a word
    goes if some run has it after that run's first period. A null text and one of blanks only
    have no words, no runs and collapse to an empty text. Rows are searched where they lie:
    repeated rows and rows without a key each give a row, an empty table gives none. Other
    columns are kept, but for those of the three names. Memory goes with a batch of
    ``BATCH_BYTES`` or with the longest single text.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods need a denser grid")
    names = ["n_words", "runs", "collapsed"]
    kept = [f for f in df.schema.fields if f.name not in (column, *names)]
    run_type = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
    kinds = [LongType(), ArrayType(run_type), StringType()]
    schema = StructType([*kept, *map(StructField, names, kinds)])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * BATCH_BYTES // max(BATCH_BYTES, batch.columns[-1].nbytes))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = _searched(part.columns[-1], least, times)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], [*(f.name for f in kept), *names])
        give_back()

    chosen = df.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{column}`").alias("_text"))
    return document_batches(chosen).mapInArrow(search, schema)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null without one."""
    ranked = F.transform(
        runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    )
    top = F.array_max(ranked)
    return F.when(
        F.size(runs) > 0,
        F.struct((-top["start"]).alias("start"), top["length"].alias("length"), (-top["period"]).alias("period")),
    )


def runs_text(runs: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
