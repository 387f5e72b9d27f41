"""Greedy packing of ordered lines into messages of limited length.

A message takes lines until the next one would exceed the limit, so where it ends depends on all
lines before it.  Still no report has to pass through one task: for a run of consecutive lines,
what matters about the lines before it is only how full the current message is.  Each partition
of the sorted lines is summarised as a function of that fill, the summaries (one per partition)
are chained per report, and each partition then cuts its own lines.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.operators.positions import numbered
from ledgerlink.sources.store import checkpointed

# The grouped functions below travel with the query; executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MESSAGE_LIMIT = 3500  # fixed value: characters per message
PIECE_LINES = 1000

_LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


class _Run:
    """Consecutive lines of one report, by their lengths (line end included)."""

    def __init__(self, lengths: np.ndarray, limit: int):
        self.limit = limit
        self.ends = np.cumsum(lengths)
        starts = self.ends - lengths
        reach = np.searchsorted(self.ends, starts + limit, side="right")
        # Where the message that starts at a line is cut: always after at least that line.
        self.cut = np.maximum(reach, np.arange(1, len(lengths) + 1))
        self.starts = starts

    def first_cut(self, fill: int) -> int:
        return int(np.searchsorted(self.ends, self.limit - fill, side="right"))

    def outcomes(self) -> tuple[list[int], list[int], list[int]]:
        """Per possible first cut: its end position, the number of cuts, and the fill left over."""
        count = len(self.ends)
        possible = min(self.first_cut(0) + 1, count)
        # Pointer doubling: a line's message ends where `ahead` says; the last messages stay where they are.
        ahead = np.where(self.cut < count, self.cut, np.arange(count))
        steps = (self.cut < count).astype(np.int64)
        while (steps[ahead] > 0).any():
            steps, ahead = steps + steps[ahead], ahead[ahead]
        last = ahead[:possible]
        left = int(self.ends[-1]) - self.starts[last]
        return self.ends[:possible].tolist(), (steps[:possible] + 1).tolist(), left.tolist()

    def message_numbers(self, fill: int, message: int) -> np.ndarray:
        count = len(self.ends)
        breaks = np.zeros(count + 1, np.int64)
        # All lines that open a message: the first cut, and from those known so far twice as many steps on.
        opening, ahead = np.array([self.first_cut(fill)]), np.append(self.cut, count)
        while opening[-1] < count:
            opening = np.concatenate((opening, ahead[opening]))
            ahead = ahead[ahead]
        breaks[opening] = 1
        return message + np.cumsum(breaks[:count])


def _summaries(limit: int):
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = None  # the run that may continue in the next batch
        for batch in batches:
            for report, rows in batch.groupby("report", sort=False, dropna=False):
                lengths = rows["length"].to_numpy()
                part = rows["part"].iloc[0]
                if pending is not None and pending[0] == report:
                    pending[2].append(lengths)
                    continue
                if pending is not None:
                    yield describe(pending)
                pending = (report, part, [lengths])
        if pending is not None:
            yield describe(pending)

    def describe(run) -> pd.DataFrame:
        report, part, lengths = run
        ends, cuts, left = _Run(np.concatenate(lengths), limit).outcomes()
        total = int(sum(chunk.sum() for chunk in lengths))
        return pd.DataFrame(
            {"report": [report], "part": [part], "total": [total], "ends": [ends], "cuts": [cuts], "left": [left]}
        )

    return summarise


def _chain(limit: int):
    def chain(runs: pd.DataFrame) -> pd.DataFrame:
        """Fill and message number each run starts with; one row per partition of a report."""
        fill = message = 0
        entries = []
        for run in runs.sort_values("part").itertuples():
            entries.append((run.report, run.part, fill, message, not entries))
            if fill + run.total <= limit:
                fill += run.total
            else:
                first = np.searchsorted(np.asarray(run.ends), limit - fill, side="right")
                fill, message = run.left[first], message + run.cuts[first]
        return pd.DataFrame(entries, columns=["report", "part", "fill", "message", "opening"])

    return chain


def _cut(limit: int):
    def cut(lines: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        """The pieces of messages that lie in one run."""
        entry = entries.iloc[0]
        lines = lines.sort_values("seq")
        numbers = _Run(lines["length"].to_numpy(), limit).message_numbers(int(entry["fill"]), int(entry["message"]))
        pieces = (lines["line"] + "\n").groupby(numbers).agg("".join)
        if entry["opening"] and pieces.index[0] > 0:
            # An over-long first line pushes out the still empty first message.
            pieces = pd.concat([pd.Series({0: ""}), pieces])
        return pd.DataFrame(
            {"report": entry["report"], "part": entry["part"], "message_no": pieces.index, "text": pieces.to_numpy()}
        )

    return cut


def _in_order(column: str, text: str):
    """Concatenation of a small group's `text` by `column`."""
    ordered = F.array_sort(F.collect_list(F.struct(column, text)))
    return F.transform(ordered, lambda row: row[text])


def pack_lines(lines: DataFrame, by: str, order: Sequence[str], limit: int | None = MESSAGE_LIMIT) -> DataFrame:
    """(`by`, message_no, message) for rows of `by`, the `order` columns and `line`.

    Over-long lines are not split.  `limit=None` joins a report into one message without a final
    line end, its lines as they are; that is one value by definition, whatever its length.
    """
    # A null report is a report of its own; the steps in Python need a name that is never null.
    report = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))
    named = F.when(F.col("report") != "", F.substr("report", F.lit(2))).alias(by)
    if limit is None:
        keyed = lines.select(report.alias("report"), F.struct(*order).alias("key"), "line")
        whole = keyed.groupBy("report").agg(F.array_join(_in_order("key", "line"), "\n").alias("message"))
        return whole.select(named, F.lit(0).cast("bigint").alias("message_no"), "message")

    pieces = lines.select(report.alias("report"), *order, F.posexplode(F.split("line", _LINE_BREAKS)).alias("piece", "line"))
    keys = [*order, "piece"]

    # Sampling makes range bounds differ between runs, so the placement is stored before use.
    placed = checkpointed(
        pieces.repartitionByRange("report", *keys)
        .sortWithinPartitions("report", *keys)
        .select(
            "report", "line",
            (F.length("line") + 1).alias("length"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    runs = placed.select("report", "part", "length").mapInPandas(
        _summaries(limit), "report string, part int, total long, ends array<long>, cuts array<long>, left array<long>"
    )
    entries = runs.groupBy("report").applyInPandas(
        _chain(limit), "report string, part int, fill long, message long, opening boolean"
    )
    fragments = (
        placed.groupBy("report", "part")
        .cogroup(entries.groupBy("report", "part"))
        .applyInPandas(_cut(limit), "report string, part int, message_no long, text string")
    )
    messages = fragments.groupBy("report", "message_no").agg(F.array_join(_in_order("part", "text"), "").alias("message"))
    return messages.select(named, "message_no", "message")


def whole_pieces(lines: DataFrame, by: str, order: Sequence[str], piece_lines: int = PIECE_LINES) -> DataFrame:
    """(`by`, piece, text): each report as ordered pieces of `piece_lines` lines, for reports of any length.

    A report's pieces in order, with a line end between them, are its message without limit.  Lines are
    numbered by a running sum over range partitions, so no task holds more of a report than its range
    and no group more than one piece.
    """
    rows = numbered(lines.select(by, *order, "line"), by, order)
    piece = (F.col("n") - F.col("n") % piece_lines) / piece_lines
    rows = rows.select(by, piece.cast("bigint").alias("piece"), "n", "line")
    return rows.groupBy(by, "piece").agg(F.array_join(_in_order("n", "line"), "\n").alias("text"))
