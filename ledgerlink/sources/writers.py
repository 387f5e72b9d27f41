"""Result tables and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.operators.headers import with_missing

MATCHED_COLUMNS = (
    "track", "artist", "album", "matched_track", "matched_artist", "matched_album", "mediaid",
    "ratio_title", "ratio_artist", "ratio_album",
    "ngram_title", "ngram_artist", "ngram_album", "match_type",
)
NOT_FOUND_COLUMNS = ("track", "artist", "album")


def _write(frame: DataFrame, path: str, fmt: str, by_curation: bool) -> None:
    writer = frame.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # Quotes are doubled, empty text stays empty rather than turning into "", and spaces around a text stay.
        writer = writer.options(
            header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if by_curation:
        writer = writer.partitionBy("curation")
    writer.save(path)


def write_links_result(linked: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the matched and not-found tables of a linking run under `path`.

    The linked rows are stored once (`path`/linked) and both tables are read back from there, so
    the linking itself runs one time only and a lost executor costs a re-read, not a re-run.
    """
    spark = linked.sparkSession
    linked.write.mode("overwrite").parquet(f"{path}/linked")
    stored = spark.read.parquet(f"{path}/linked")
    found = F.col("match_type").isNotNull()
    _write(
        with_missing(stored.filter(found), (*MATCHED_COLUMNS, "curation")),
        f"{path}/matched", fmt, by_curation=True,
    )
    _write(
        with_missing(stored.filter(~found), (*NOT_FOUND_COLUMNS, "curation")),
        f"{path}/not_found", fmt, by_curation=True,
    )


def write_report(lines: DataFrame, path: str) -> None:
    """One text line per row of `line`; name the path after the run's time to keep old reports."""
    lines.select("line").write.mode("errorifexists").text(path)


def write_search_links(links: DataFrame, path: str, fmt: str = "csv") -> None:
    _write(links, path, fmt, by_curation=False)
