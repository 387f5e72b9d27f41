"""Named queries against their SQL checks on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from ledgerlink.checks import SQL
from ledgerlink.workload import QUERIES

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables not present")

SOME = (
    "clean_text_tail", "fold_documents", "pair_signals", "artist_blocks_v2", "match_cascade", "match_v2", "match_hot_word",
    "station_totals_v2", "station_report_lines", "report_messages", "id_changes", "search_links",
    "station_totals", "station_totals_large", "station_totals_rough", "station_totals_v2_mixed", "station_diff_of_totals",
    "report_messages_whole", "report_pieces", "search_links_first_100", "search_links_first_half",
    "report_from_file", "search_links_from_files", "documents_by_split",
)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", SOME)
def test_query_equals_check(spark, name):
    database = duckdb.connect()
    for table in DATA.glob("*.parquet"):
        database.execute(f"create view {table.stem} as select * from '{table}'")
    check = database.sql(entry_points.oracle_sql()[name])
    result = entry_points.queries()[name](spark, str(DATA))
    columns = sorted(result.columns)
    assert sorted(check.columns) == columns
    expected = [tuple(row[check.columns.index(c)] for c in columns) for row in check.fetchall()]
    got = [tuple(row[c] for c in columns) for row in result.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
