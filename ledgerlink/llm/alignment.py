"""Which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers encode a space and the text.  In a batch of documents each token has a span of bytes.
With `pandas.merge_asof`, keyed by document, the start of each token finds the other side's token that
covers it; the two directions together are all overlaps, and an overlap whose spans end together is a
link.  Each link ends a group: the tokens of either side since the link before.

Over the corpus, the links of each pair of ids are counted.  The counts go back to the documents: as a
broadcast array while there are at most `pair_rows` pairs, beyond that by a join on the pair.

A text that is null or empty, or whose tokens of either side do not stand for exactly a space and the
text, has no tokens: zeros and an empty hash.  Every row gives one row and counts by itself, repeated
ones too.  Other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, slices, stored, texts
from ledgerlink.llm.words import byte_encoder, piece_encoder

#: Pairs of ids whose counts are broadcast at most: 17 bytes each.
PAIR_ROWS = 1 << 22


def _spans(ids: list, lengths: np.ndarray) -> pd.DataFrame:
    """The tokens of all documents: id, doc, place, start, end; bytes are counted through the documents."""
    sizes = [len(x) for x in ids]
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(sizes)) if isinstance(ids[0], list) else np.concatenate(ids).astype(np.int64)
    ends = np.cumsum(lengths[flat])
    docs = np.repeat(np.arange(len(ids)), sizes)
    return pd.DataFrame({"id": flat, "doc": docs, "place": np.arange(len(flat)), "start": ends - lengths[flat], "end": ends})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """place_a, place_b, end_a, end_b of every pair of tokens that share bytes, in order."""
    names = ["doc", "place", "start"]

    def covering(own: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
        found = pd.merge_asof(own[names], other[names], on="start", by="doc", suffixes=("_own", "_other"))
        return found["place_other"].to_numpy(np.int64)

    alone = ~np.isin(b["start"].to_numpy(), a["start"].to_numpy())  # tokens that start together have met
    place_a = np.concatenate((a["place"].to_numpy(), covering(b, a)[alone]))
    place_b = np.concatenate((covering(a, b), b["place"].to_numpy()[alone]))
    order = np.argsort(place_a + place_b, kind="stable")
    place_a, place_b = place_a[order], place_b[order]
    ends = {"end_a": a["end"].to_numpy()[place_a], "end_b": b["end"].to_numpy()[place_b]}
    return pd.DataFrame({"place_a": place_a, "place_b": place_b, **ends})


class _Writer:
    """The groups of documents as text: `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, size_a: int, size_b: int) -> None:
        self._shift = 2 * size_a
        self._strings = [b"%d%s" % (k, mark) for k in range(size_a) for mark in (b",", b"|")]
        self._strings += [b"%d%s" % (k, mark) for k in range(size_b) for mark in (b",", b";")]

    def write(self, a: pd.DataFrame, b: pd.DataFrame, link_ends: np.ndarray, docs: int) -> list[str]:
        """Each document's hash; the links' ends are in rising order."""
        group_a, group_b = (np.searchsorted(link_ends, x["end"].to_numpy()) for x in (a, b))
        count = len(link_ends)
        before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=count))))
        through_a = np.cumsum(np.bincount(group_a, minlength=count))
        codes = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = (np.append(np.diff(g) > 0, True)[: len(g)] for g in (group_a, group_b))
        codes[np.arange(len(a)) + before_b[group_a]] = 2 * a["id"].to_numpy() + last_a
        codes[np.arange(len(b)) + through_a[group_b]] = self._shift + 2 * b["id"].to_numpy() + last_b
        sizes = sum(np.bincount(x["doc"].to_numpy(), minlength=docs) for x in (a, b))
        cuts = np.concatenate(([0], np.cumsum(sizes))).tolist()
        written, listed = [], codes.tolist()
        for start, end in pairwise(cuts):
            text = b"".join(map(self._strings.__getitem__, listed[start:end]))[:-1]
            written.append(hashlib.sha256(text).hexdigest() if text else "")
        return written


def _lists(values: np.ndarray, rows: np.ndarray, count: int, kind: pa.DataType) -> pa.ListArray:
    """The values of each row, rows in rising order."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(count + 1)), pa.int32()), pa.array(values, kind))


_COUNTS = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string"}
_PAIRS = {"pairs": "array<bigint>", "times": "array<bigint>"}
_TOKENS = {"a_ids": "array<bigint>", "b_ids": "array<bigint>", "overlaps_a": "array<bigint>", "overlaps_b": "array<bigint>"}


def align(
    documents: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", tokens: bool = False
) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times of each row.

    `pairs` has the distinct pairs of ids linked in the row, 2**32 times the first id plus the second,
    and `times` how many links hold each.  With `tokens` also the ids of both sides, and every overlap
    as places in them: a_ids, b_ids, overlaps_a, overlaps_b.
    """
    columns = _COUNTS | _PAIRS | (_TOKENS if tokens else {})

    def run(batches):
        first, second = byte_encoder(byte_path, special=False), piece_encoder(piece_path)
        writer = _Writer(len(first.lengths), len(second.lengths))
        for batch in slices(batches, "text"):
            whole = texts(batch)
            count = len(whole)
            ids_b = second.encode(whole)
            ids_b = [x if t and x is not None else [] for t, x in zip(whole, ids_b, strict=True)]
            ids_a = first.encode([f" {t}" if x else "" for t, x in zip(whole, ids_b, strict=True)])
            a, b = _spans(ids_a, first.lengths), _spans(ids_b, second.lengths)
            met = overlaps(a, b)
            linked = met[met["end_a"] == met["end_b"]]
            docs = a["doc"].to_numpy()[linked["place_a"].to_numpy()]
            pairs = (a["id"].to_numpy()[linked["place_a"].to_numpy()] << 32) | b["id"].to_numpy()[linked["place_b"].to_numpy()]
            distinct, place = np.unique(pairs, return_inverse=True)
            held, times = np.unique(docs * max(1, len(distinct)) + place, return_counts=True)
            rows, place = np.divmod(held, max(1, len(distinct)))
            links = np.bincount(docs, minlength=count)
            made = [
                batch.column("key"),
                *(pa.array(np.bincount(x["doc"].to_numpy(), minlength=count), pa.int64()) for x in (a, b)),
                pa.array(links, pa.int64()), pa.array(links, pa.int64()),
                pa.array(writer.write(a, b, linked["end_a"].to_numpy(), count), pa.string()),
                _lists(distinct[place], rows, count, pa.int64()), _lists(times, rows, count, pa.int64()),
            ]
            if tokens:
                doc_of = a["doc"].to_numpy()[met["place_a"].to_numpy()]
                made += [_lists(x["id"].to_numpy(), x["doc"].to_numpy(), count, pa.int64()) for x in (a, b)]
                for x, name in ((a, "place_a"), (b, "place_b")):
                    begins = np.searchsorted(x["doc"].to_numpy(), np.arange(count))
                    made.append(_lists(met[name].to_numpy() - begins[doc_of], doc_of, count, pa.int64()))
            yield pa.RecordBatch.from_arrays(made, [key, *columns])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    return arrow_map(rows, run, ", ".join([f"`{key}` {kind}", *(f"{n} {t}" for n, t in columns.items())]))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (links of the corpus that hold it), best (whether no pair with the same second id has more)."""
    pairs = aligned.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    second = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counted.withColumn("best", F.col("count") == F.max("count").over(second))


def _by_broadcast(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    listed = counted.toPandas().sort_values("pair")
    shared = aligned.sparkSession.sparkContext.broadcast([listed[c].to_numpy() for c in ("pair", "count", "best")])
    names = ["key", *_COUNTS]

    def run(batches):
        pairs, counts, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            bounds = np.asarray(lists.offsets, np.int64)
            held = np.asarray(lists.values)[bounds[0] : bounds[-1]]
            times = np.asarray(batch.column("times").values)[bounds[0] : bounds[-1]]
            place = np.searchsorted(pairs, held)
            sums = [
                np.diff(np.concatenate(([0], np.cumsum(x)))[bounds - bounds[0]])
                for x in (times * best[place], times * counts[place])
            ]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), *(pa.array(s, pa.int64()) for s in sums)], [*names, "n_best", "count_sum"]
            )

    typed = [f"key {aligned.schema['key'].dataType.simpleString()}", *(f"{n} {t}" for n, t in _COUNTS.items())]
    return arrow_map(aligned.select(*names, *_PAIRS), run, ", ".join([*typed, "n_best bigint", "count_sum bigint"]))


def _by_join(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    """The same by a join.  A row holds a pair once, so a pair on very many rows is a skew that Spark splits."""
    pairs = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = pairs.join(counted, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    met = aligned.select("row", "key", *_COUNTS).join(sums, "row", "left").drop("row")
    return met.na.fill(0, ["n_best", "count_sum"])


def agreement(
    documents: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", pair_rows: int = PAIR_ROWS
) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    n_best: the row's links whose pair is, over the corpus, the most frequent one of its second id,
    ties included.  count_sum: the corpus counts of the row's links added up.  Two tables stay in the
    shared folder, `alignment-documents-*` and `alignment-pairs-*`.
    """
    named = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    aligned = align(named, byte_path, piece_path, "key")
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "alignment-documents")
    counted = stored(pair_counts(aligned), "alignment-pairs")
    found = _by_broadcast(aligned, counted) if counted.count() <= pair_rows else _by_join(aligned, counted)
    return found.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
