"""CSV scans.  Everything is read as text; a cell's type is decided where it is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlink.operators.headers import Sheet
from ledgerlink.sources.quoted import scan_rows

# Cell texts that count as missing for the search-link tool.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_FORMAT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.options(multiLine=multi_line, **_FORMAT)


def _has_large_file(spark: SparkSession, path: str) -> bool:
    """Whether any file is larger than a split; sizes are listed, nothing is read."""
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return not spark.read.format("binaryFile").load(path).filter(F.col("length") > split).isEmpty()


def _unique(headers: list[str]) -> list[str]:
    """Repeated headers get .1, .2 ... suffixes."""
    seen: dict[str, int] = {}
    result = []
    for header in headers:
        count = seen.get(header, 0)
        seen[header] = count + 1
        result.append(f"{header}.{count}" if count else header)
    return result


def scan_csv(spark: SparkSession, path: str, *, multi_line: bool = True, by_split: bool | None = None) -> Sheet:
    """Header row plus text cells; empty cells and the missing tail of short rows are ''.

    Only the header record is read up front: with the schema known, the scan needs no inference
    pass.  Quoted line breaks require `multi_line`.  Spark's own reader then takes each file as one
    split; with `by_split` (by default where a file is larger than a split) the same rows are found
    by many tasks a file, which read it twice.  Without `multi_line` Spark splits at any line break.

    `pos` is the file order: path, split start, row within the split.
    """
    first = _csv(spark, multi_line).csv(path).head()
    headers = _unique([cell or f"Unnamed: {i}" for i, cell in enumerate(first or ())])
    cells = [f"c{i}" for i in range(len(headers))]
    schema = StructType([StructField(c, StringType()) for c in cells])
    if cells and multi_line and (_has_large_file(spark, path) if by_split is None else by_split):
        rows = scan_rows(spark, path, schema, _FORMAT)
        position = F.col("pos")
    else:
        rows = _csv(spark, multi_line).schema(schema).option("header", True).csv(path)
        position = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        )
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in cells]
    return Sheet(rows.select(*filled, position.alias("pos")), tuple(headers))


def scan_csv_missing(spark: SparkSession, path: str, *, multi_line: bool = True) -> Sheet:
    """As `scan_csv`, with the usual spellings of a missing value read as NULL."""
    sheet = scan_csv(spark, path, multi_line=multi_line)
    return Sheet(missing_to_null(sheet.frame, len(sheet.headers)), sheet.headers)


def missing_to_null(frame: DataFrame, columns: int) -> DataFrame:
    cells = [F.when(~F.col(f"c{i}").isin(*MISSING_TEXTS), F.col(f"c{i}")).alias(f"c{i}") for i in range(columns)]
    return frame.select(*cells, *frame.columns[columns:])
