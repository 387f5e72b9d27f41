"""Reversed lexical search: the documents stream past an index of the queries.

The terms of all items make an inverted index: term, then the items that hold it and how often.  It is
broadcast; item texts beyond `BLOCK_CHARS` characters are split over several such indexes, each with a
pass of its own.  One pass over the documents counts, in each, all terms and the occurrences of the
index's terms, and stores these counts; they give the corpus' number of documents, its length and the
document frequencies.  A second pass streams the stored counts through the index: each task adds up
the scores of its documents for all items at once and keeps a heap of the best for each item.  The
heaps, of at most `best` rows an item and task, are merged, first in salted groups.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, only A-Z
lower-cased.  A null text has none.  Items of equal text are scored once and each get the result;
items without terms, or that no document scores for, have no row.  Every row of the documents is a
document, so repeated rows take several ranks.  Equal scores go by ascending key, a missing key last.
Other columns of either table do not matter.  An empty table of either kind gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, slices, stored

#: Characters of distinct item texts in one broadcast index.
BLOCK_CHARS = 4 << 20
#: Scores that a task holds at once, documents times items, and single contributions likewise.
_CELLS = 1 << 21
#: Groups in which an item's heaps are merged at first.
_SALTS = 32

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: What ends a term becomes a space, A-Z become small letters.
_PLAIN = bytes(b if b >= 0x80 or b in _KEPT else ord(chr(b).lower()) if 65 <= b <= 90 else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_PLAIN).split()


class Index:
    """Terms of the items, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[str]) -> None:
        held: dict[bytes, list[tuple[int, int]]] = {}
        for number, text in enumerate(texts):
            for term, times in Counter(terms(text.encode())).items():
                held.setdefault(term, []).append((number, times))
        self.items = len(texts)
        self.numbers = {term: k for k, term in enumerate(held)}
        self.degrees = np.array([len(p) for p in held.values()], np.int64)
        self.starts = np.cumsum(self.degrees) - self.degrees
        pairs = np.array([p for postings in held.values() for p in postings], np.int64).reshape(-1, 2)
        self.holders, self.times = pairs[:, 0], pairs[:, 1]


class _Later:
    """A key in a heap of the best: the later key is the worse one, and a missing one the worst."""

    __slots__ = ("key",)

    def __init__(self, key) -> None:
        self.key = key

    def __lt__(self, other: _Later) -> bool:
        if self.key is None or other.key is None:
            return self.key is None and other.key is not None
        return self.key > other.key


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, items: int, best: int) -> None:
        self._best = best
        self.heaps: list[list] = [[] for _ in range(items)]
        self._least = np.ones(items, np.int64)  # a full heap takes nothing below

    def add(self, keys: list, scores: np.ndarray) -> None:
        """Scores of some documents (rows) for all items (columns)."""
        if len(keys) > 4 * self._best:  # what the block itself holds often enough bounds it too
            cut = np.partition(scores, len(keys) - self._best, axis=0)[len(keys) - self._best]
            floor = np.maximum(self._least, cut)
        else:
            floor = self._least
        for row, item in zip(*map(np.ndarray.tolist, np.nonzero(scores >= floor)), strict=True):
            heap, entry = self.heaps[item], (int(scores[row, item]), _Later(keys[row]))
            if len(heap) < self._best:
                heapq.heappush(heap, entry)
            elif heap[0] < entry:
                heapq.heapreplace(heap, entry)
            if len(heap) == self._best:
                self._least[item] = max(1, heap[0][0])


def _term_counts(index):
    """For each document with a term: key, n_terms, and the index's terms in it with their occurrences."""

    def run(batches):
        numbers = index.value.numbers
        size = len(numbers) + 1
        for batch in slices(batches, "text"):
            raw = pc.cast(batch.column("text"), pa.binary()).to_pylist()
            found = [terms(r) if r else [] for r in raw]
            lengths = np.array([len(f) for f in found], np.int64)
            ids = np.fromiter((n for f in found for n in map(numbers.get, f, repeat(-1))), np.int64, int(lengths.sum()))
            rows = np.repeat(np.arange(len(found)), lengths)
            pairs, times = np.unique((rows * size + ids)[ids >= 0], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(found) + 1) * size)
            some = pa.array(lengths > 0)
            columns = [
                batch.column("key"), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs % size, pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(times, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_terms", "terms", "times"]).filter(some)

    return run


def _runs(sizes: np.ndarray, most_rows: int, most: int) -> list[tuple[int, int]]:
    """Successive rows, `most_rows` at most, whose sizes add up to about `most`; one row at least."""
    part = np.cumsum(sizes) // most + np.arange(len(sizes)) // most_rows
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _best_of(index, weights, documents: int, length: int, sums: list[str], best: int):
    """Each task's heaps: sum (of the item's text), key, score."""

    def run(batches):
        own, weight = index.value, weights.value
        heaps, kind = Heaps(own.items, best), None
        for batch in batches:
            kind = batch.schema.field("key").type
            lists = batch.column("terms")
            bounds = np.asarray(lists.offsets, np.int64)
            held = np.asarray(lists.values, np.int64)[bounds[0] : bounds[-1]]
            times = np.asarray(batch.column("times").values, np.int64)[bounds[0] : bounds[-1]]
            bounds = bounds - bounds[0]
            keys = batch.column("key").to_pylist()
            norms = np.array([25 + 75 * n * documents // length for n in batch.column("n_terms").to_pylist()], np.int64)
            degrees = own.degrees[held]
            work = np.concatenate(([0], np.cumsum(degrees)))
            for first, end in _runs(np.diff(work[bounds]), max(1, _CELLS // own.items), _CELLS):
                a, b = bounds[first], bounds[end]
                rows = np.repeat(np.arange(end - first), np.diff(bounds[first : end + 1]))
                part, count, posts = held[a:b], times[a:b], degrees[a:b]
                value = weight[part] * (1_000_000_000 * count // (1000 * count + 8 * norms[first + rows]))
                # The postings of each term that the documents hold.
                place = np.arange(int(posts.sum())) + np.repeat(own.starts[part] - (np.cumsum(posts) - posts), posts)
                scores = np.zeros((end - first) * own.items, np.int64)
                np.add.at(scores, np.repeat(rows * own.items, posts) + own.holders[place], np.repeat(value, posts) * own.times[place])
                heaps.add(keys[first:end], scores.reshape(end - first, own.items))
        if kind is not None:
            held = [(sums[k], e[1].key, e[0]) for k, heap in enumerate(heaps.heaps) for e in heap]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.string()), pa.array([h[1] for h in held], kind), pa.array([h[2] for h in held], pa.int64())],
                ["sum", "key", "score"],
            )

    return run


def weight_of(documents: int, holders: int) -> int:
    """1000 times the logarithm of how rare a term is, rounded down."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def _best(frame: DataFrame, best: int, *group: str | Column) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return frame.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def _search_block(rows: DataFrame, block: list, best: int) -> DataFrame | None:
    """sum, key, score: each task's best documents for the items of one block."""
    context, kind = rows.sparkSession.sparkContext, rows.schema["key"].dataType.simpleString()
    index = Index([r.text for r in block])
    if not index.numbers:
        return None
    shared = context.broadcast(index)
    counted = arrow_map(rows, _term_counts(shared), f"key {kind}, n_terms bigint, terms array<int>, times array<int>")
    counted = stored(counted, "ranking-counts")
    documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    if not documents:
        return None
    holders = np.zeros(len(index.numbers), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the index
        holders[r.term] = r["count"]
    weights = context.broadcast(np.array([weight_of(documents, int(h)) for h in holders], np.int64))
    return arrow_map(counted, _best_of(shared, weights, documents, length, [r.sum for r in block], best), f"sum string, key {kind}, score bigint")


def rank(
    documents: DataFrame, items: DataFrame, best: int = 10, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """item, rank (from 1), key, score of the `best` documents of each item.

    Each block of items leaves a table `ranking-counts-*` in the shared folder.
    """
    session, kind = documents.sparkSession, documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    asked = items.select(items[item].alias("item"), items[item_text].cast("string").alias("text")).filter("text is not null")
    asked = asked.withColumn("sum", F.md5("text"))
    distinct = asked.select("sum", "text").distinct()
    chars = distinct.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    found = session.createDataFrame([], f"sum string, key {kind}, score bigint")
    for number in range(blocks):
        block = distinct.filter(F.pmod(F.xxhash64("sum"), F.lit(blocks)) == number).collect()  # about block_chars characters
        part = _search_block(rows, block, best)
        found = found if part is None else found.unionByName(part)
    salted = _best(found.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(_SALTS))), best, "sum", "salt").drop("rank", "salt")
    ranked = _best(salted, best, "sum")
    return ranked.join(asked.drop("text"), "sum").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
