"""Counts over whole texts, a slice of rows at a time: no Python loop over words.

Words are coded by their bytes (a dictionary of the slice), so windows of words compare as numbers;
codes of 2, 4 and 8 words are built by doubling, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.llm.common import bytes_of, filled, slices

WINDOW = 8  # words; a power of two

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_lower", "n_wide", "n_digits", "n_marks",
    "n_shouts", "n_bare", "n_ends", "n_odd", "n_same",
)


def _members(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(chars)] = True
    return flags


SPACE = _members(b" \t\n\x0b\x0c\r")
SYMBOL = _members(b"#*$%&|<>")
UPPER = _members(bytes(range(65, 91)))
LOWER = _members(bytes(range(97, 123)))
DIGIT = _members(b"0123456789")
MARK = _members(b".,;:!?\"'()-")
PLAIN = _members(b".,;:?\"'()-")
SHOUT = _members(b"!")
END = _members(b".!?")
CONTINUED = np.array([0x80 <= b < 0xC0 for b in range(256)])
WIDE = np.array([b >= 0xC0 for b in range(256)])
ALNUM = UPPER | LOWER | DIGIT | CONTINUED | WIDE


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its code, its text's number, its first byte and the byte after its last."""
    inside = ~SPACE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[at] = True
    before = np.concatenate(([False], inside[:-1])) & ~breaks[:-1]
    after = np.concatenate((inside[1:], [False])) & ~breaks[1:] if len(data) else inside
    first = np.flatnonzero(inside & ~before)
    last = np.flatnonzero(inside & ~after) + 1
    ends = np.concatenate(([0], np.cumsum(last - first))).astype(np.int32)
    kept = np.ascontiguousarray(data[inside])
    words = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.searchsorted(at, first, side="right") - 1
    return codes, owner, first, last


def repeated_words(codes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Per text: words inside windows that occur at least twice in it."""
    if len(codes) < WINDOW:
        return np.zeros(texts, np.int64)
    same = codes
    span = 1
    while span < WINDOW:
        same = pd.factorize(same[:-span] * (int(same.max()) + 1) + same[span:])[0].astype(np.int64)
        span *= 2
    starts = np.flatnonzero(owner[:len(same)] == owner[WINDOW - 1:])
    keyed = pd.factorize(same[starts] * texts + owner[starts])[0]
    starts = starts[np.bincount(keyed, minlength=1)[keyed] > 1] if len(starts) else starts
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(owner[covered], minlength=texts)


def repeated_lines(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and how many of them equal an earlier one."""
    split = pc.split_pattern(texts, "\n")
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]")
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    use = worded.to_numpy(zero_copy_only=False).astype(bool)[code]
    lines = np.bincount(owner[use], minlength=len(texts))
    distinct = np.unique(code[use] * len(texts) + owner[use]) % max(len(texts), 1)
    return lines, lines - np.bincount(distinct, minlength=len(texts))


def counts(texts: pa.LargeStringArray) -> dict[str, np.ndarray]:
    data, at = bytes_of(texts)
    size = len(texts)
    codes, owner, first, last = words_of(data, at)
    lines, dup_lines = repeated_lines(texts)
    base = int(codes.max()) + 1 if len(codes) else 1
    distinct = pd.unique(owner * base + codes) // base
    alnum = np.concatenate(([0], np.cumsum(ALNUM[data], dtype=np.int64)))
    bare = alnum[last] == alnum[first]  # words without a letter or digit
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])) + 1
    closing = data[last - 1] if len(last) else np.zeros(0, np.uint8)
    return {
        "n_words": np.bincount(owner, minlength=size),
        "word_chars": _per_text(~SPACE[data] & ~CONTINUED[data], at),
        "n_symbols": _per_text(SYMBOL[data], at),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated_words(codes, owner, size),
        "n_lines": lines,
        "n_distinct": np.bincount(distinct, minlength=size),
        "n_upper": _per_text(UPPER[data], at),
        "n_lower": _per_text(LOWER[data], at),
        "n_wide": _per_text(WIDE[data], at),
        "n_digits": _per_text(DIGIT[data], at),
        "n_marks": _per_text(MARK[data], at),
        "n_same": np.bincount(owner[same], minlength=size),  # words equal to the one before
        "n_odd": _per_text(~(ALNUM | SPACE)[data] & ~PLAIN[data], at),
        "n_shouts": _per_text(SHOUT[data], at),
        "n_bare": np.bincount(owner[bare], minlength=size),
        "n_ends": np.bincount(owner[END[closing]], minlength=size),
    }


def with_counts(docs: DataFrame, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of ``docs`` and COUNTS (with a prefix), one row per row of ``docs``.

    A null text counts as an empty one. Only ``keep`` and ``text`` are read.
    """
    names = [*keep, *(prefix + c for c in COUNTS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch.column(batch.num_columns - 1))
            for low, high in slices(texts):
                found = counts(texts.slice(low, high - low))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(low, high - low) for i in range(len(keep))),
                     *(pa.array(found[c].astype(np.int64)) for c in COUNTS)],
                    names=names)

    read = docs.select(*keep, docs["text"].alias("_text"))
    fields = [*read.schema.fields[:-1], *(T.StructField(prefix + c, T.LongType()) for c in COUNTS)]
    return read.mapInArrow(count, T.StructType(fields))
