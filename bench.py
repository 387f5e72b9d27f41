"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs twice in one session and the second time counts: the first run pays for starting
the JVM's compiler and the Python workers.  Results are written to Spark's no-op sink, so nothing
is skipped and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from ledgerlink.workload import QUERIES

HEADLINE = (
    "match_cascade", "match_wide", "match_v2", "clean_text", "clean_documents", "pair_signals",
    "station_diff", "station_report_lines", "report_messages", "id_diff_stats", "search_links",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlink-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        # Pair work is quadratic in rows, so merging small partitions would idle cores.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        # Planning time, which counts on small data: wide score formulas make both expensive.
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.sql.maxPlanStringLength", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, second run, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "match_rows_per_sec": round(rows / seconds["match_cascade"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
