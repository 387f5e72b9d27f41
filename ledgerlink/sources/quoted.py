"""CSV records with quoted line breaks, read by many tasks a file.

Whether a line starts inside a quoted cell depends on all lines before it, but a single line only ever does
one of four things to that: nothing, turn it over, leave the line outside, or leave it inside.  Which of
these is plain from the line's own text.  So each split is first summed up as one such effect, without its
texts, and a running sum over the splits of a file says how each of them begins.  Then every split gives its
whole records, for both ways in which it may begin until these give the same, and a join with the sums keeps
the right ones.  Only where a border of splits cuts a record are they read once more, for the pieces of such
records, and only these are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlink.sources.store import stored

# A cell's text up to its closing quote, and a whole cell.  All repetitions are possessive, so that a test
# takes time in proportion to the line.
_INNER = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_INNER}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS_FROM_OUTSIDE = rf'\A{_CELLS}"{_INNER}\z'
_OPENS_FROM_INSIDE = rf'\A{_INNER}(?:"[^,]*+,{_CELLS}"{_INNER})?+\z'

_KEEPS, _TURNS, _LEAVES, _ENTERS = range(4)
_CUT = -1  # line of a record that begins before its split


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split), value and effect of each line, if it is empty and if a carriage return ends it."""
    value = F.col("value")
    outside, inside = value.rlike(_OPENS_FROM_OUTSIDE), value.rlike(_OPENS_FROM_INSIDE)
    effect = (
        F.when(~value.contains('"'), _KEEPS)
        .when(outside, F.when(inside, _ENTERS).otherwise(_TURNS))
        .otherwise(F.when(inside, _KEEPS).otherwise(_LEAVES))
    )
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        "value", effect.cast("tinyint").alias("effect"), value.isin("", "\r").alias("empty"), value.endswith("\r").alias("returns"),
    )


def _after(effects: np.ndarray, inside: int) -> np.ndarray:
    """Whether each line ends inside a quoted cell, if the first one starts so (1) or not (0)."""
    turns = np.cumsum(effects == _TURNS)
    fixed = np.maximum.accumulate(np.where(effects >= _LEAVES, np.arange(len(effects)), -1))
    known = fixed >= 0
    state = np.where(known, effects[fixed] - _LEAVES, inside)
    return (state + turns - np.where(known, turns[fixed], 0)) % 2


def _joined(values: pa.Array, starts: np.ndarray) -> pa.Array:
    """The lines from each start to the next one as one text."""
    offsets = pa.array(np.append(starts, len(values)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")


class _Way:
    """The records of a split that begins inside a quoted cell (1) or outside (0)."""

    def __init__(self, inside: int) -> None:
        self.inside = inside
        self.line = _CUT if inside else None  # at which the open record begins
        self.open: list[str] = []

    def take(self, effects: np.ndarray, after: np.ndarray, values: pa.Array, number: int) -> tuple[list[int], pa.Array, pa.Array]:
        """The records that begin and end in this split and end in these lines: the lines that they begin at
        and their texts.  Last the lines of the record that the split begins in; `number` is that of the first."""
        nothing = values.slice(0, 0)
        if not len(effects):
            return [], nothing, nothing
        before = np.concatenate(([self.inside], after[:-1]))
        starts = np.flatnonzero(before == 0)
        self.inside = int(after[-1])
        first = int(starts[0]) if len(starts) else len(effects)
        cut = values.slice(0, first) if self.line == _CUT else nothing
        if first and self.line != _CUT:
            self.open += _joined(values.slice(0, first), np.array([0])).to_pylist()
        lines, texts = [], [nothing]
        if self.line is not None and (len(starts) or not self.inside):
            if self.line != _CUT:
                lines.append(self.line)
                texts.append(pa.array(["\n".join(self.open)], values.type))
            self.line, self.open = None, []
        if len(starts):
            found = _joined(values.slice(first), starts - first)
            if self.inside:
                self.line, self.open = number + int(starts[-1]), [found[-1].as_py()]
                starts, found = starts[:-1], found.slice(0, len(found) - 1)
            lines += (number + starts).tolist()
            texts.append(found)
        return lines, pa.concat_arrays(texts), cut


class _Split:
    """Both ways at once, and one for both from where they agree on being outside."""

    def __init__(self) -> None:
        self.lines = 0
        self.ways: dict[int | None, _Way] = {0: _Way(0), 1: _Way(1)}

    def take(self, run: pa.RecordBatch) -> Iterator[tuple[int | None, list[int], pa.Array, pa.Array]]:
        """Way (None: both) and what it takes from these lines."""
        effects, values = run.column("effect").to_numpy(), run.column("value")
        low = 0
        if None not in self.ways:
            after = {way: _after(effects, own.inside) for way, own in self.ways.items()}
            agree = np.flatnonzero((after[0] == 0) & (after[1] == 0))
            low = int(agree[0]) + 1 if len(agree) else len(effects)
            for way, own in self.ways.items():
                yield way, *own.take(effects[:low], after[way][:low], values.slice(0, low), self.lines)
            if len(agree):
                self.ways = {None: _Way(0)}
        if None in self.ways:
            own, rest = self.ways[None], effects[low:]
            yield None, *own.take(rest, _after(rest, own.inside), values.slice(low), self.lines + low)
        self.lines += len(effects)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where another split begins."""
    if not batch.num_rows:
        return
    files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)], strict=True):
        yield (files.dictionary[int(codes[low])].as_py(), int(starts[low])), batch.slice(low, high - low)


_WAY_SUM = "struct<inside: tinyint, filled: bigint, tail: bigint>"
_SUMS = f"file string, start bigint, returns boolean, outside {_WAY_SUM}, inside {_WAY_SUM}"
_WAY_TYPE = pa.struct([("inside", pa.int8()), ("filled", pa.int64()), ("tail", pa.int64())])


class _Sum:
    """What the other splits of a file must know of one of them, for both ways in which it may begin."""

    def __init__(self, returns: bool) -> None:
        self.returns, self.lines = returns, 0
        self.ways = [{"inside": way, "filled": None, "tail": None} for way in (0, 1)]

    def add(self, run: pa.RecordBatch) -> None:
        effects = run.column("effect").to_numpy()
        empty = run.column("empty").to_numpy(zero_copy_only=False)
        for way in self.ways:
            after = _after(effects, way["inside"])
            starts = np.flatnonzero(np.concatenate(([way["inside"]], after[:-1])) == 0)
            filled = starts[~empty[starts]]
            if way["filled"] is None and len(filled):
                way["filled"] = self.lines + int(filled[0])
            if len(starts):
                way["tail"] = self.lines + int(starts[-1])
            way["inside"] = int(after[-1])
            if not way["inside"]:
                way["tail"] = None  # the last record ends in this split
        self.lines += len(effects)


def _sum_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, own = None, None

    def row() -> pa.RecordBatch:
        columns = [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([own.returns])]
        columns += [pa.array([way], _WAY_TYPE) for way in own.ways]
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "returns", "outside", "inside"])

    for batch in batches:
        for key, run in _runs(batch):
            if key != at:
                if at is not None:
                    yield row()
                at, own = key, _Sum(run.column("returns")[0].as_py())
            own.add(run)
    if at is not None:
        yield row()


_FOUND = "file string, start bigint, way tinyint, line bigint, part bigint, record string"


def _found(key: tuple[str, int], way: int | None, lines: list[int], part: int, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    if n := len(lines):
        columns = [pa.repeat(pa.scalar(key[0]), n), pa.repeat(pa.scalar(key[1], pa.int64()), n), pa.repeat(pa.scalar(way, pa.int8()), n),
                   pa.array(lines, pa.int64()), pa.repeat(pa.scalar(part, pa.int64()), n), texts]
        yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in _FOUND.split(", ")])


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in one split."""
    at, split = None, None
    for batch in batches:
        for key, run in _runs(batch):
            if key != at:
                at, split = key, _Split()
            for way, lines, texts, _ in split.take(run):
                yield from _found(key, way, lines, 0, texts)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split has of records that its borders cut, in parts: of the one that it begins in, and the last."""
    at, split, part = None, None, 0

    def last() -> Iterator[pa.RecordBatch]:
        for way, own in split.ways.items() if split else ():
            if own.line not in (None, _CUT):
                yield from _found(at, way, [own.line], part, pa.array(["\n".join(own.open)], pa.string()))

    for batch in batches:
        for key, run in _runs(batch):
            if key != at:
                yield from last()
                at, split, part = key, _Split(), 0
            for way, _, _, cut in split.take(run):
                if len(cut):
                    yield from _found(key, way, [_CUT], part, _joined(cut, np.array([0])))
            part += 1
    yield from last()


def _placed(sums: DataFrame) -> DataFrame:
    """For each split its `way`, the place where the record that it begins in began, that of its last record
    if that goes on, and of its file the place of the header and if carriage returns belong to the line ends."""
    order = Window.partitionBy("file").orderBy("start")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = F.col("outside.inside"), F.col("inside.inside")
    fixed, turns = ends[0] == ends[1], ends[0] > ends[1]
    sums = sums.withColumn("turns", F.sum(turns.cast("int")).over(order))
    # Turns since the last split whose end is known whatever came before; a file begins outside.
    way = (
        F.coalesce(F.last(F.when(fixed, ends[0]), True).over(before), F.lit(0))
        + F.coalesce(F.last("turns").over(before), F.lit(0))
        - F.coalesce(F.last(F.when(fixed, F.col("turns")), True).over(before), F.lit(0))
    ) % 2
    sums = sums.withColumn("way", way.cast("tinyint")).withColumn("own", F.when(F.col("way") == 1, F.col("inside")).otherwise(F.col("outside")))
    place = lambda line: F.when(F.col(line).isNotNull(), F.struct(F.col("start").alias("start"), F.col(line).alias("line")))
    sums = sums.withColumn("tail", place("own.tail")).withColumn("filled", place("own.filled"))
    return sums.select(
        F.col("file").alias("of_file"), F.col("start").alias("of_start"), F.col("way").alias("of_way"),
        "tail", F.last("tail", True).over(before).alias("owner"),
        F.first("filled", True).over(whole).alias("head"), F.first("returns").over(whole).alias("two"),
    )


def _records(spark: SparkSession, path: str) -> DataFrame:
    """file, own (the split, and the line in it, at which it begins), record: of all records, also empty ones.

    `head` and `two` are those of the file.
    """
    lines = _lines(spark, path)
    splits = stored(_placed(lines.drop("value").mapInArrow(_sum_up, _SUMS)), "csv-splits")

    def of_the_right_way(found: DataFrame, *columns: str) -> DataFrame:
        known = found.join(splits.select("of_file", "of_start", "of_way", *columns), (F.col("file") == F.col("of_file")) & (F.col("start") == F.col("of_start")))
        return known.filter(F.col("way").isNull() | (F.col("way") == F.col("of_way")))

    texts = lines.select("file", "start", "value", "effect")
    whole = of_the_right_way(texts.mapInArrow(_whole, _FOUND), "head", "two")
    whole = whole.select("file", F.struct("start", "line").alias("own"), "head", "two", "record")
    if splits.filter("tail is not null").isEmpty():
        return whole
    pieces = of_the_right_way(texts.mapInArrow(_pieces, _FOUND), "owner", "head", "two")
    own = F.when(F.col("line") == _CUT, F.col("owner")).otherwise(F.struct("start", "line"))
    pieces = pieces.select("file", own.alias("own"), "head", "two", F.struct("start", "part", "record").alias("piece"))
    cut = pieces.groupBy("file", "own", "head", "two").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return whole.union(cut.select("file", "own", "head", "two", F.array_join("pieces.record", "\n")))


def scan_rows(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> DataFrame:
    """The cells of every record but the first of each file, and `pos`: file, split and line in it.

    As in the reader of whole files, empty lines are no records, and where a file's first line ends in a
    carriage return and a line feed, so do all.  A carriage return alone ends no line here, and a line end at the very end of a file is no part
    of a cell even if its quote is never closed.
    """
    found = _records(spark, path).filter(F.col("own") > F.col("head"))
    record = F.when(F.col("two"), F.regexp_replace("record", "\r(?=\n|\\z)", "")).otherwise(F.col("record"))
    position = F.struct("file", F.col("own.start").alias("start"), F.col("own.line").alias("row"))
    found = found.select(record.alias("record"), position.alias("pos")).filter("record <> ''")
    return found.select(F.from_csv("record", schema.simpleString(), options).alias("cells"), "pos").select("cells.*", "pos")
