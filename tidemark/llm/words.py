"""The words of many texts at once, for operators that work on Arrow batches."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters of scripts written without spaces; each is a word.
SINGLE = r"[\x{2E80}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"


class Words(NamedTuple):
    """Distinct forms, and for every word its form and its text (word by word, in order)."""

    forms: list[str]
    form_of: np.ndarray
    text_of: np.ndarray


def split_words(texts: pa.Array, digits: bool = False) -> Words:
    """Runs of letters (and ``digits``, if asked for) in lower case, single letters of Han and
    kana; null texts have none."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    spaced = pc.replace_substring_regex(lower, f"({SINGLE})", r" \1 ")
    lists = pc.split_pattern_regex(spaced, r"[^\p{L}\p{M}\p{N}]+" if digits else r"[^\p{L}\p{M}]+")
    coded = lists.flatten().dictionary_encode()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    text_of = np.repeat(np.arange(len(lists)), sizes)
    forms = coded.dictionary.to_pylist()
    form_of = coded.indices.to_numpy(zero_copy_only=False)
    kind = str.isalnum if digits else str.isalpha
    real = np.array([kind(f) or any(map(kind, f)) for f in forms], bool)
    keep = real[form_of] if len(form_of) else np.zeros(0, bool)
    return Words(forms, form_of[keep], text_of[keep])


def letter_groups(forms: list[str], least: int, most: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, form) of every group of ``least`` to ``most`` letters of each form, with a
    blank at either end of it, hashed to ``features`` (a power of two)."""
    sizes = np.array([len(f) + 2 for f in forms], np.int64)
    joined = "".join(f" {f} " for f in forms).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, np.uint32).astype(np.uint64)
    form = np.repeat(np.arange(len(forms)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # letters to the form's end
    found, forms_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    h = np.zeros(len(codes), np.uint64)
    shift = np.uint64(64 - (features.bit_length() - 1))
    for n in range(1, min(most, len(codes)) + 1):
        upto = len(codes) - n + 1
        h[:upto] = (h[:upto] + codes[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        if n >= least:
            inside = left >= n
            mixed = (h[inside] ^ (h[inside] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> shift).astype(np.int64))
            forms_of.append(form[inside])
    return np.concatenate(found), np.concatenate(forms_of)
