"""Longest-common-subsequence lengths of many text pairs: the one kernel that runs in Python.

Bit-parallel recurrence over whole Arrow batches: with V all ones and M[c] the positions of c in
the shorter text, each character c of the longer one does U = V & M[c], V = (V + U) | (V - U);
the zeros left in V count the subsequence.  One numpy step advances every pair of the batch.  Patterns
beyond 64 characters take several words, with the carry of the addition handed from one to the next.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Executors need not have this package installed: the kernel travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = 64
#: Words of a pattern at most; beyond, one long integer takes many characters a step, even for one pair.
_MOST_WORDS = 8
_CELLS = 1 << 19  # characters held at once


def _code_matrix(texts: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Character codes by position: one row per position, one column per text, 0 past its end."""
    width, count = int(sizes.max()), len(texts)
    encoded = texts.cast(pa.large_binary())
    _, offset_buffer, data_buffer = encoded.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[encoded.offset : encoded.offset + count + 1]
    if offsets[-1] - offsets[0] != sizes.sum():  # not ASCII: bytes are not characters
        strings = np.array(texts.to_pylist(), dtype=f"U{width}")
        return np.ascontiguousarray(strings.view(np.uint32).reshape(count, width).T)
    data = np.frombuffer(data_buffer, np.uint8)
    positions = np.arange(width)[:, None]
    cells = np.minimum(offsets[:-1] + positions, len(data) - 1)
    return data[cells] * (positions < sizes)


def _word_kernel(pattern: np.ndarray, sizes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bit-parallel LCS of many pairs at once."""
    words = -(-len(pattern) // _WORD)
    # Dense symbol numbers keep the mask table as narrow as the alphabet in use; 0 is the padding.
    used_codes = np.bincount(other.ravel()) > 0
    used_codes[0] = False
    numbers = np.zeros(max(int(pattern.max()) + 1, len(used_codes)), dtype=np.int32)
    numbers[: len(used_codes)] = np.where(used_codes, np.cumsum(used_codes), 0)
    width = int(used_codes.sum()) + 1
    row_start = np.arange(pattern.shape[1], dtype=np.int32) * np.int32(width)
    pattern_cells = numbers[pattern] + row_start
    other_cells = numbers[other] + row_start

    masks = np.zeros((words, len(row_start) * width), dtype=np.uint64)
    for position, cells in enumerate(pattern_cells):
        masks[position // _WORD][cells] |= np.uint64(1 << position % _WORD)
    masks[:, row_start] = 0

    state = np.full((words, len(row_start)), np.iinfo(np.uint64).max, dtype=np.uint64)
    for cells in other_cells:
        carry = None
        for word in range(words):
            before = state[word]
            hit = before & masks[word].take(cells)
            total = before + hit
            over = total < before
            if carry is not None:
                total += carry
                over |= total < carry
            state[word] = total | (before - hit)
            carry = over.astype(np.uint64) if word + 1 < words else None
    found = np.zeros(len(row_start), np.int64)
    for word in range(words):
        inside = np.clip(sizes - word * _WORD, 0, _WORD)
        used = np.where(
            inside >= _WORD,
            np.iinfo(np.uint64).max,
            (np.uint64(1) << np.minimum(inside, _WORD - 1).astype(np.uint64)) - np.uint64(1),
        )
        found += np.bitwise_count(~state[word] & used)
    return found


def _wide_lcs(pattern: str, other: str) -> int:
    """The same recurrence on one arbitrary-precision integer, for long texts."""
    masks: dict[str, int] = {}
    for position, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << position
    full = (1 << len(pattern)) - 1
    state = full
    for char in other:
        hit = state & masks.get(char, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(pattern) - state.bit_count()


def lcs_lengths(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Longest-common-subsequence length of each pair; 0 where a side is null."""
    result = np.zeros(len(left), dtype=np.int64)
    left_sizes, right_sizes = (
        pc.utf8_length(side).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for side in (left, right)
    )
    short, long_ = np.minimum(left_sizes, right_sizes), np.maximum(left_sizes, right_sizes)
    # Texts are grouped by length class, patterns by a power of two of words, so that padding stays below
    # a factor of two.
    classes = np.ceil(np.log2(np.maximum(long_, 8))).astype(int)
    words = np.ceil(np.log2(np.maximum(-(-short // _WORD), 1))).astype(int)
    words[short > _MOST_WORDS * _WORD] = -1
    # The kernel takes the shorter text as its pattern, so each order is a group of its own.
    for swapped, (pattern, other) in enumerate(((left, right), (right, left))):
        ordered = ((left_sizes > right_sizes) == bool(swapped)) & (short > 0)
        for length_class, word_class in np.unique(np.stack((classes, words))[:, ordered], axis=1).T.tolist():
            rows = np.flatnonzero(ordered & (classes == length_class) & (words == word_class))
            if word_class == -1:
                result[rows] = [_wide_lcs(pattern[row].as_py(), other[row].as_py()) for row in rows]
                continue
            step = max(_CELLS >> length_class, 1)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                taken = pa.array(part)
                result[part] = _word_kernel(
                    _code_matrix(pattern.take(taken), short[part]),
                    short[part],
                    _code_matrix(other.take(taken), long_[part]),
                )
    return result


@F.arrow_udf(IntegerType())
def lcs_length(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(lcs_lengths(left, right), type=pa.int32())
