"""Which ids came and went between two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.operators.headers import Sheet, resolve_id


def record_ids(sheet: Sheet) -> DataFrame:
    """The table's id column as `id` (the first column if none has a known name)."""
    return sheet.frame.select(sheet[resolve_id(sheet.headers)].alias("id"))


def _presence(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per id whether each side has it. NULL is an id like any other."""
    sides = before.select("id", F.lit(True).alias("old"), F.lit(False).alias("new")).unionByName(
        after.select("id", F.lit(False).alias("old"), F.lit(True).alias("new"))
    )
    return sides.groupBy("id").agg(F.max("old").alias("old"), F.max("new").alias("new"))


def id_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids on one side only, as `added` or `removed`."""
    change = F.when(F.col("new"), "added").otherwise("removed").alias("change")
    return _presence(before, after).filter("old != new").select("id", change)


def id_change_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: ids before, ids after, added, removed, net change."""
    counts = _presence(before, after).agg(
        F.count_if(F.col("old")).alias("before"),
        F.count_if(F.col("new")).alias("after"),
        F.count_if(F.expr("new AND NOT old")).alias("added"),
        F.count_if(F.expr("old AND NOT new")).alias("removed"),
    )
    return counts.withColumn("net_change", F.col("added") - F.col("removed"))
