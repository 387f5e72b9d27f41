"""Benchmark passages in documents, found by winnowed fingerprints.

A window is `WINDOW` consecutive words of an item; an item of fewer words is one window.  Texts are cut
into grams of `GRAM` words.  Of every `WINDOW - GRAM + 1` successive grams, the one with the smallest
hash is a fingerprint, on either side; so any shared window holds a shared fingerprint.  Fingerprints
are joined and each hit is extended by comparing words, up to the window's length on either side, so
hash collisions do no harm.  Items shorter than a window are looked up whole, by length.

Words: A-Z lower-cased, then runs of digits, a-z and all characters beyond ASCII.  Every document
row gives one row; a null text has no words.  Items without id or words take no part; equal items
count by their distinct ids.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, slices, stored

WINDOW, GRAM = 10, 6
KEEP = WINDOW - GRAM + 1
_SIDE = WINDOW - GRAM
#: Characters of benchmark text whose index is broadcast at once; a larger benchmark is met in blocks.
BLOCK_CHARS = 16 << 20

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class _Numbers(dict):
    """Numbers of the benchmark's words; 0 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Index(NamedTuple):
    numbers: dict[bytes, int]
    prints: np.ndarray  # sorted hashes
    starts: np.ndarray  # of each hash's contexts
    contexts: np.ndarray  # words around a fingerprint, -1 outside the item
    context_items: list[list[str]]
    short: dict[int, dict[bytes, list[str]]]  # by length, the items of each whole sequence


def gram_hashes(numbers: np.ndarray, length: int) -> np.ndarray:
    size = len(numbers) - length + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(size, np.uint64)
    for k in range(length):
        value = value * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + size].astype(np.uint64)
    value ^= value >> np.uint64(29)
    return value * np.uint64(0xBF58476D1CE4E5B9)


def winnow(hashes: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """Places of the smallest hash of every `keep` successive ones, all of them in a tie."""
    size = len(hashes) - keep + 1
    if size <= 0:
        return np.arange(0)
    least = hashes[:size].copy()
    for k in range(1, keep):
        np.minimum(least, hashes[k : k + size], out=least)
    chosen = np.zeros(len(hashes), bool)
    for k in range(keep):
        chosen[k : k + size] |= hashes[k : k + size] == least
    return np.flatnonzero(chosen)


def _around(numbers: np.ndarray, places: np.ndarray, outside: int) -> np.ndarray:
    padded = np.concatenate((np.full(_SIDE, outside), numbers, np.full(_SIDE, outside))).astype(np.int64)
    return padded[places[:, None] + np.arange(WINDOW + _SIDE)]


def build_index(items: list[tuple[str, str]]) -> Index:
    numbers: dict[bytes, int] = {}
    sequences: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item, text in items:
        sequence = tuple(numbers.setdefault(w, len(numbers) + 1) for w in words(text))
        if sequence:
            sequences[sequence].add(item)
    contexts: dict[bytes, set[str]] = defaultdict(set)
    short: dict[int, dict[bytes, list[str]]] = defaultdict(dict)
    for sequence, ids in sequences.items():
        own = np.array(sequence, np.int64)
        if len(own) < WINDOW:
            short[len(own)][own.tobytes()] = sorted(ids)
            continue
        for context in _around(own, winnow(gram_hashes(own, GRAM)), -1):
            contexts[context.tobytes()] |= ids
    rows = np.frombuffer(b"".join(contexts), np.int64).reshape(-1, WINDOW + _SIDE)
    hashes = np.array([gram_hashes(r[_SIDE : _SIDE + GRAM], GRAM)[0] for r in rows], np.uint64)
    order = np.argsort(hashes, kind="stable")
    prints, starts = np.unique(hashes[order], return_index=True)
    named = [sorted(x) for x in contexts.values()]
    return Index(numbers, prints, np.append(starts, len(rows)), rows[order], [named[k] for k in order], dict(short))


class Finder:
    def __init__(self, index: Index) -> None:
        self._index = index
        self._numbers = _Numbers(index.numbers)
        self._maybe = np.zeros(1 << 20, bool)
        self._maybe[(index.prints & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self._short = {n: np.sort(self._hashes_of(known, n)) for n, known in index.short.items()}

    @staticmethod
    def _hashes_of(known: dict[bytes, list[str]], length: int) -> np.ndarray:
        rows = np.frombuffer(b"".join(known), np.int64).reshape(-1, length)
        return np.array([gram_hashes(r, length)[0] for r in rows], np.uint64)

    def find(self, texts: list[str | None]) -> list[tuple[int, np.ndarray, set[str]]]:
        """For each text: its number of words, a hit mark for each word, and the items found."""
        split = [words(t) for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        ends = np.cumsum(sizes + 1)  # a word of no item stands after each text
        starts = ends - sizes - 1
        flat: list[bytes] = []
        for s in split:
            flat += s
            flat.append(b"")
        numbers = np.fromiter(map(self._numbers.__getitem__, flat), np.int64, len(flat))
        depth = np.zeros(len(flat) + 1, np.int64)
        found: list[set[str]] = [set() for _ in texts]
        if len(self._index.prints):
            self._extend(numbers, ends, depth, found)
        for length in self._short:
            self._look_up(length, numbers, ends, depth, found)
        hit = np.cumsum(depth[:-1]) > 0
        return [(int(n), hit[s : s + n], f) for n, s, f in zip(sizes, starts, found, strict=True)]

    def _extend(self, numbers, ends, depth, found) -> None:
        index = self._index
        hashes = gram_hashes(numbers, GRAM)
        places = winnow(hashes)
        places = places[self._maybe[(hashes[places] & np.uint64((1 << 20) - 1)).astype(np.int64)]]
        at = np.searchsorted(index.prints, hashes[places])
        at[at == len(index.prints)] = 0
        same = index.prints[at] == hashes[places]
        places, at = places[same], at[same]
        for step in range(0, len(places), 1 << 14):  # bounds the memory of the joined pairs
            self._extend_some(numbers, places[step : step + (1 << 14)], at[step : step + (1 << 14)], ends, depth, found)

    def _extend_some(self, numbers, places, at, ends, depth, found) -> None:
        index = self._index
        counts = index.starts[at + 1] - index.starts[at]
        places = np.repeat(places, counts)
        contexts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(index.starts[at], counts)
        equal = _around(numbers, places, 0) == index.contexts[contexts]
        left = np.cumprod(equal[:, _SIDE - 1 :: -1] if _SIDE else equal[:, :0], axis=1).sum(axis=1)
        right = np.cumprod(equal[:, _SIDE + GRAM :], axis=1).sum(axis=1)
        shared = equal[:, _SIDE : _SIDE + GRAM].all(axis=1) & (left + right >= _SIDE)
        places, contexts, left, right = places[shared], contexts[shared], left[shared], right[shared]
        np.add.at(depth, places - left, 1)
        np.add.at(depth, places + GRAM + right, -1)
        for text, context in set(zip(np.searchsorted(ends, places, "right").tolist(), contexts.tolist(), strict=True)):
            found[text].update(index.context_items[context])

    def _look_up(self, length, numbers, ends, depth, found) -> None:
        hashes, known = gram_hashes(numbers, length), self._short[length]
        at = np.searchsorted(known, hashes)
        at[at == len(known)] = 0
        for place in np.flatnonzero(known[at] == hashes).tolist():
            items = self._index.short[length].get(numbers[place : place + length].tobytes())
            if items:
                depth[place] += 1
                depth[place + length] -= 1
                found[int(np.searchsorted(ends, place, "right"))].update(items)


def _listed(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def find_items(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated of each document row.

    The documents are read once for each `block_chars` of benchmark text; usually that is once.
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    items = benchmark.select(benchmark[item].cast("string").alias("item"), benchmark[item_text].cast("string").alias("text"))
    items = items.dropna()
    blocks = _blocks_of(items, block_chars)
    if len(blocks) == 1:
        return _one_block(rows, _index_of(items), f"{key} {kind}", key)
    rows = rows.withColumn("sum", F.xxhash64("text"))
    hits = None
    for part in blocks:
        block = _block_hits(rows, _index_of(part))
        hits = block if hits is None else hits.unionByName(block)
    # One row for each block that hits a document; rows alike in key and text have the same hits.
    merged = stored(hits, "benchmark-hits").groupBy("key", "sum").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("n_hit"),
    )
    merged = merged.withColumnsRenamed({"key": "k", "sum": "s"})
    sizes = _word_counts(rows)
    met = sizes.join(merged, F.col("key").eqNullSafe(F.col("k")) & F.col("sum").eqNullSafe(F.col("s")), "left")
    listed = F.coalesce(F.array_join(F.array_sort("items"), ","), F.lit(""))
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return met.select(
        F.col("key").alias(key), "n_words", hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def _blocks_of(items: DataFrame, block_chars: int) -> list[DataFrame]:
    """The benchmark in parts of about `block_chars` characters."""
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = max(1, -(-size // block_chars))
    return [items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k) if count > 1 else items for k in range(count)]


def _index_of(items: DataFrame):
    """The broadcast index of a benchmark, or of a block of it, whose size has been checked."""
    return items.sparkSession.sparkContext.broadcast(build_index([tuple(r) for r in items.collect()]))


def _one_block(rows: DataFrame, index, typed_key: str, key: str) -> DataFrame:
    names = [key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]

    def run(batches):
        finder = Finder(index.value)
        for batch in slices(batches, "text"):
            found = finder.find(batch.column("text").to_pylist())
            hits = [int(h.sum()) for _, h, _ in found]
            columns = [
                batch.column("key"), pa.array([f[0] for f in found], pa.int64()), pa.array(hits, pa.int64()),
                pa.array([len(f[2]) for f in found], pa.int64()), pa.array([_listed(f[2]) for f in found], pa.string()),
                pa.array([h > 0 for h in hits], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    counts = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return arrow_map(rows, run, f"{typed_key}, {counts}")


def _block_hits(rows: DataFrame, index) -> DataFrame:
    def run(batches):
        finder = Finder(index.value)
        for batch in slices(batches, "text"):
            found = finder.find(batch.column("text").to_pylist())
            some = [k for k, f in enumerate(found) if f[2]]
            columns = [
                batch.column("key").take(pa.array(some, pa.int64())), batch.column("sum").take(pa.array(some, pa.int64())),
                pa.array([np.flatnonzero(found[k][1]) for k in some], pa.list_(pa.int64())),
                pa.array([sorted(found[k][2]) for k in some], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "sum", "places", "items"])

    kind = rows.schema["key"].dataType.simpleString()
    return arrow_map(rows, run, f"key {kind}, sum bigint, places array<bigint>, items array<string>")


def _word_counts(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches, "text"):
            counts = [len(words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("sum"), pa.array(counts, pa.int64())], ["key", "sum", "n_words"])

    return arrow_map(rows, run, f"key {rows.schema['key'].dataType.simpleString()}, sum bigint, n_words bigint")


def keep_clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents in which no window of an item occurs, with all columns; filtered where they are read."""
    items = benchmark.select(benchmark[item].cast("string").alias("item"), benchmark[item_text].cast("string").alias("text")).dropna()
    clean = documents
    for part in _blocks_of(items, BLOCK_CHARS):
        clean = arrow_map(clean, _clean_in(_index_of(part), text), documents.schema)
    return clean


def _clean_in(index, text: str):
    def run(batches):
        finder = Finder(index.value)
        for batch in slices(batches, text):
            found = finder.find(batch.column(text).to_pylist())
            yield batch.filter(pa.array([not f[2] for f in found], pa.bool_()))

    return run
