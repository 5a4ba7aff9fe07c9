"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A vocabulary file of the tokenizers library (BPE with word ends, word pattern, special tokens)
is read from a path. An Aho-Corasick automaton finds every token that occurs in a word. The
encoder extends the longest token first and keeps it only if it is compatible with the token
before, that is, if the merge rules applied to the two alone would leave them apart; a sequence
whose neighbours are all compatible is the exact result of the merges. Each prefix of a word
has one such sequence, so a place that failed is never tried again and the work is linear.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import document_batches, give_back

#: Bytes of text that are encoded into one batch of results.
BATCH_BYTES = 1 << 20
#: Bytes of words already worked out, in each of two generations: when the younger one is full,
#: it replaces the older, and a word that comes again moves on without being encoded again.
REMEMBERED = 32 << 20
#: What a word takes beside its letters and ids; token pairs that are remembered, and tokens
#: whose edges are.
WORD_BYTES, PAIRS, EDGES = 150, 1 << 17, 1 << 14

#: Stands for the end of a word in the automaton; no byte has this code.
_END = "Ā"
#: Letters and numbers of Unicode 16 that an older Python does not know (fixed values).
_NEW_LETTERS = (
    r"\u1c89\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65"
    r"\U00010d6f-\U00010d85\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e"
    r"\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3\U00011bc0-\U00011be0"
    r"\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff"
    r"\U0001e5d0-\U0001e5ed\U0001e5f0"
)
_NEW_NUMBERS = (
    r"\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139"
    r"\U00016d70-\U00016d79\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa"
)
#: Texts without any of these characters need fewer steps and a shorter pattern.
_ODD = re.compile("[^\\x00-\\x7f\\xa0\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u017f]")
_COMMON = {r"\p{L}": "a-zß-öø-ſ", r"\p{N}": "0-9"}
#: White space of the word pattern (fixed values).
_WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Lower-case letters of Unicode 16 and 17 that an older Python does not know, and the capital
#: sigma, which is lowered without regard to its place in a word (fixed values).
_LOWER = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
          0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_LOWER |= {0x10D50 + i: 0x10D70 + i for i in range(22)} | {0x16EA0 + i: 0x16EBB + i for i in range(25)}


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, and its byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _charset(major: str) -> str:
    """The characters of a major category (L, N) as the inside of a character set."""
    codes = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == major]
    new = [i for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    spans = [(codes[a], codes[b - 1]) for a, b in zip(new, [*new[1:], len(codes)])]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def _spelled(pattern: str, sets: dict[str, str]) -> str:
    for name, chars in sets.items():
        pattern = pattern.replace(f"[{name}]", f"[{chars}]").replace(name, chars)
    return pattern


class _Places(dict):
    """Where the ids of each word are kept; a word that is not there yet is added by ``add``."""

    def __init__(self, add: Callable[[str], int]):
        self.add = add

    def __missing__(self, word: str) -> int:
        return self.add(word)


class Tokenizer:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        steps = [s["type"] for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if model["type"] != "BPE" or not suffix or steps != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError(f"not a BPE vocabulary with word ends: {path}")
        kinds = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalisation {kinds}")
        vocab: dict[str, int] = model["vocab"]
        byte_of = _byte_letters()

        def form(token: str) -> str:
            body, end = (token.removesuffix(suffix), _END) if token.endswith(suffix) else (token, "")
            return "".join(chr(byte_of[c]) for c in body) + end

        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            self.automaton.add_word(form(token), (len(form(token)), i))
        self.automaton.make_automaton()
        self.merged: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = vocab[a], vocab[b]
            self.merged[pair] = rank
            parts.setdefault(vocab[a + b], (*pair, rank))
        self.parts = parts
        # the pieces of a token that stood at its right or left edge while it was merged,
        # each with the rank of the merge that took it in
        self.edges = [lru_cache(EDGES)(lambda t, side=side: self._edge(t, side)) for side in (1, 0)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile(f"({'|'.join(map(re.escape, self.special))})") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # the character classes are spelled out so that the standard library can match them
        every = {r"\p{L}": _charset("L") + _NEW_LETTERS, r"\p{N}": _charset("N") + _NEW_NUMBERS, r"\s": _WHITE}
        self.words, self.common_words = (re.compile(_spelled(pattern, s)).findall for s in (every, every | _COMMON))
        self.table = OffsetTable(spec)
        self.first_letters = frozenset(t[:1] for t in self.special)
        self.forget()

    def forget(self) -> None:
        """Drop what was learned from texts; a worker process outlives the tasks it serves."""
        self.compatible: dict[int, bool] = {}
        self._turn()
        self._turn()

    def _turn(self) -> None:
        """Begin a new generation of words; the one before stays to be looked up."""
        self.older = (self.place, self.flat, self.starts) if hasattr(self, "place") else None
        self.place = _Places(self._index)
        self.flat, self.starts = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.held = 0

    def _edge(self, token: int, side: int) -> tuple[tuple[int, int], ...]:
        out, taken = [], len(self.merged)
        while True:
            out.append((token, taken))
            if token not in self.parts:
                return tuple(out)
            *halves, taken = self.parts[token]
            token = halves[side]

    def _apart(self, left: int, right: int) -> bool:
        """Whether the merge rules leave two neighbouring tokens as they are.

        A merge across the border takes place if its two pieces stood there at its turn. Equal
        pairs are merged from left to right, so the border goes before a merge of the same
        rank on its right, and after one on its left.
        """
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        merged, after = self.merged, self.edges[1](right)
        none = len(merged) + 1
        known = self.compatible[left << 32 | right] = not any(
            (rank := merged.get((a, b), none)) < taken_a and rank <= taken_b
            for a, taken_a in self.edges[0](left)
            for b, taken_b in after
        )
        return known

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one word (a match of the word pattern)."""
        coded = word.encode("utf-8").decode("latin-1") + _END
        n = len(coded)
        found: list[list[tuple[int, int]] | None] = [None] * n
        for end, match in self.automaton.iter(coded):
            at = end + 1 - match[0]
            if found[at] is None:
                found[at] = [match]
            else:
                found[at].append(match)  # in ascending length
        at, last, chosen, failed = 0, -1, [], set()
        compatible = self.compatible
        while at < n:
            options = found[at]
            while options:
                match = options.pop()
                size, token = match
                if at + size in failed:
                    continue
                if last >= 0:
                    known = compatible.get(last << 32 | token)
                    if not (self._apart(last, token) if known is None else known):
                        continue
                chosen.append(match)
                last = token
                at += size
                break
            else:
                failed.add(at)
                if not chosen:
                    raise ValueError(f"no tokens for {word!r}")
                at -= chosen.pop()[0]
                last = chosen[-1][1] if chosen else -1
        return [token for _, token in chosen]

    def _index(self, word: str) -> int:
        """Keep the ids of a word that has no place yet."""
        ids, i = self._known(word), len(self.place)
        end = self.starts[i] + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(end, len(self.flat)), np.int32)])
        if i + 1 >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.starts[i] : end] = ids
        self.starts[i + 1] = end
        self.place[word] = i
        self.held += sys.getsizeof(word) + 4 * len(ids) + WORD_BYTES
        return i

    def _known(self, word: str) -> np.ndarray | list[int]:
        """The ids of a word: from the generation before, or worked out."""
        place, flat, starts = self.older
        i = place.get(word)
        return self.encode_word(word) if i is None else flat[starts[i] : starts[i + 1]]

    def _segment(self, text: str) -> np.ndarray:
        split = self.common_words
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if _ODD.search(text):
                text, split = text.translate(_LOWER), self.words
        words = split(text.lower())
        if self.held >= REMEMBERED:
            self._turn()
        place = self.place
        which = [place[w] for w in words]
        return _gather(self.flat, self.starts, np.array(which, np.int64))

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a text; strings of special tokens in it become their ids."""
        if not text:
            return np.zeros(0, np.int32)
        if not any(c in text for c in self.first_letters):
            return self._segment(text)
        pieces = self.at_special.split(text)
        return np.concatenate(
            [np.array([self.special[p]], np.int32) if i % 2 else self._segment(p) for i, p in enumerate(pieces) if p]
        )
    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids, from the offset table of the same file."""
        return self.table.decode(ids)


class OffsetTable:
    """The tokens' strings in one run of bytes, and where each begins: all that decoding needs."""

    def __init__(self, spec: dict):
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        shown = [f"{names.get(i, '')} ".encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(shown), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in shown])])

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings, with a space between them."""
        return _gather(self.blob, self.offsets, ids).tobytes().decode("utf-8")[:-1]


def _gather(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The pieces ``flat[starts[i]:starts[i + 1]]`` for i in ``which``, one after another."""
    first = starts[which]
    sizes = starts[which + 1] - first
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first - (ends - sizes), sizes) + np.arange(total)]


@lru_cache(4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, made once in a process."""
    return Tokenizer(path)


@lru_cache(4)
def offset_table(path: str) -> OffsetTable:
    """The offset table of a file, made once in a process."""
    with open(path, encoding="utf-8") as file:
        return OffsetTable(json.load(file))


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``BATCH_BYTES``."""
    for batch in batches:
        rows = max(1, batch.num_rows * BATCH_BYTES // max(BATCH_BYTES, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _replaced(df: DataFrame, column: str, name: str, kind) -> StructType:
    fields = [f for f in df.schema.fields if f.name not in (column, name)]
    return StructType([*fields, StructField(name, kind)])


def encode(df: DataFrame, path: str, column: str = "text", name: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the text ``column`` replaced by ``name``, the array of its token ids, and by
    ``decoded``, if that is given: the text that these decode to, as ``decode`` makes it, but in
    the same task, so that the ids need not come back from Spark to Python.

    ``path`` is a vocabulary file that every executor can read. A null or empty text has no
    ids; a text of any length is encoded whole. Rows are encoded where they lie, in batches
    of bounded size; other columns are kept, but for those called ``name`` and ``decoded``.
    """
    schema = _replaced(df, column, name, ArrayType(IntegerType(), False))
    if decoded is not None:
        schema = StructType([f for f in schema.fields if f.name != decoded] + [StructField(decoded, StringType())])
    names = schema.names
    rest = [c for c in names if c not in (name, decoded)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in _pieces(batches, column):
            ids = [own.encode(t.as_py()) for t in batch.column(column)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))
            columns = [*(batch.column(c) for c in rest), pa.ListArray.from_arrays(pa.array(ends), values)]
            if decoded is not None:
                columns.append(pa.array([own.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)
        own.forget()
        give_back()

    return document_batches(df.select(*rest, column)).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, column: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with ``name``, the text of the token ids in ``column``; a null array and one of no
    ids give an empty text. A column called ``name`` is replaced; the others are kept."""
    schema = StructType([f for f in df.schema.fields if f.name != name] + [StructField(name, StringType())])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = offset_table(path)
        for batch in _pieces(batches, column):
            lists = batch.column(column)
            texts = [
                "" if (x := lists[i].values) is None else own.decode(x.to_numpy(zero_copy_only=False).astype(np.int64))
                for i in range(len(lists))
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, name]
            )
        give_back()

    return document_batches(df.select(*kept)).mapInArrow(run, schema)
