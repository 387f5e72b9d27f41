"""Row numbers of a sorted table without a window over all of it.

The table is dealt to range partitions of its order and sorted there.  Each partition counts its own
rows, and what came before a partition is a running sum over these counts, one small row a partition
and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.sources.store import checkpointed

_BEFORE = (Window.unboundedPreceding, -1)
_PART, _SEQ = "placed_part", "placed_seq"


def _placed(frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """`frame` sorted in range partitions; sampling may move their bounds, so the placement is stored."""
    return checkpointed(
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_SEQ, F.monotonically_increasing_id())
    )


def _runs(placed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per partition and group: its first sequence number, its rows, and the group's rows before it."""
    counts = placed.groupBy(_PART, *by).agg(F.min(_SEQ).alias("first_seq"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(*by).orderBy(_PART).rowsBetween(*_BEFORE))
    return counts.withColumn("before", F.coalesce(before, F.lit(0)))


def numbered(frame: DataFrame, by: str, order: Sequence[str], name: str = "n") -> DataFrame:
    """`frame` with each row's number, from 0, in `order` within its value of `by` (null is a value).

    Rows alike in `by` and `order` are numbered in any order.
    """
    placed = _placed(frame, [by, *order])
    runs = _runs(placed, [by]).select(F.col(_PART).alias("run_part"), F.col(by).alias("run_by"), "first_seq", "before")
    same = (placed[_PART] == runs["run_part"]) & placed[by].eqNullSafe(runs["run_by"])
    number = F.col("before") + F.col(_SEQ) - F.col("first_seq")
    return placed.join(runs, same).select(*(placed[c] for c in frame.columns), number.alias(name))


def first_by(frame: DataFrame, order: str, limit: int) -> DataFrame:
    """The first `limit` rows by `order`, sorted, cut in the partition where the limit falls.

    Only the place of the cut goes to the driver, one row.
    """
    placed = _placed(frame, [order])
    cut = _runs(placed, []).filter(F.col("before") + F.col("rows") > limit).orderBy(_PART).first()
    if cut is not None:
        last = cut["first_seq"] + max(0, limit - cut["before"])
        placed = placed.filter(F.col(_SEQ) < last)
    return placed.select(*frame.columns)
