import csv
import random

import pytest

from ledgerlink.plans.ids import id_change_stats, record_ids
from ledgerlink.plans.linking import link_files
from ledgerlink.plans.search import search_links
from ledgerlink.plans.snapshots import compare_snapshots, report_lines, snapshot_rows
from ledgerlink.sources.readers import scan_csv, scan_csv_missing
from ledgerlink.sources.writers import write_links_result, write_report, write_search_links


def written(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_scan_keeps_empty_cells_and_text(spark, tmp_path):
    text = 'Track,track,Artist\n007,"a ""q"", b",NA\n\nx,,\n"line\nbreak",y,TRUE\nshort\n'
    sheet = scan_csv(spark, written(tmp_path / "a.csv", text, "utf-8-sig"))
    assert sheet.headers == ("Track", "track", "Artist")
    rows = sheet.frame.orderBy("pos").drop("pos").collect()
    assert [tuple(r) for r in rows] == [
        ("007", 'a "q", b', "NA"), ("x", "", ""), ("line\nbreak", "y", "TRUE"), ("short", "", ""),
    ]


def test_repeated_headers(spark, tmp_path):
    assert scan_csv(spark, written(tmp_path / "a.csv", "a,a,b\n1,2,3\n")).headers == ("a", "a.1", "b")


def test_file_order_over_many_splits(spark, tmp_path):
    path = written(tmp_path / "big.csv", "id\n" + "".join(f"{i:06}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        sheet = scan_csv(spark, path, multi_line=False)
        assert sheet.frame.rdd.getNumPartitions() > 4
        assert [int(r.c0) for r in sheet.frame.orderBy("pos").collect()] == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_spellings(spark, tmp_path):
    sheet = scan_csv_missing(spark, written(tmp_path / "a.csv", "track,artist\nNA,x\nnull,y\n,z\nok,n/a\nNone,v\nok,w\n"))
    assert [r.track for r in search_links(sheet).collect()] == ["ok"]
    assert sheet.frame.filter("c0 is null").count() == 4


def test_linking_files_end_to_end(spark, tmp_path):
    library = written(tmp_path / "lib.csv", "song,artists,album\nHotel California (Remastered),The Eagles,Hotel\nBohemian Rhapsody,Queen,Opera\n")
    first = written(tmp_path / "one.csv", "track,artist\nHotel California,Eagles\nBohemian Rhapsody,Queen\n")
    second = written(tmp_path / "two.csv", "Song Title,Artist Name,ALBUM\nBohemian Rhapsodi,queen,Opera\n")
    linked = link_files(spark, library, [first, second])
    write_links_result(linked, str(tmp_path / "out"))
    matched = spark.read.csv(str(tmp_path / "out" / "matched"), header=True)
    assert sorted((r.track, r.match_type, r.mediaid) for r in matched.collect()) == [
        ("Bohemian Rhapsodi", "fuzzy_album", None), ("Bohemian Rhapsody", "exact", None),
    ]
    missing = spark.read.csv(str(tmp_path / "out" / "not_found"), header=True)
    assert [(r.track, r.artist) for r in missing.collect()] == [("Hotel California", "Eagles")]
    with pytest.raises(ValueError):
        link_files(spark, library, [])


def test_reports_and_links_to_files(spark, tmp_path):
    old = scan_csv(spark, written(tmp_path / "old.csv", "Station,Songs,Hours\nx,1,1\n"))
    new = scan_csv(spark, written(tmp_path / "new.csv", "Station,Songs,Hours\nx,3,1.5\n"))
    lines = report_lines(compare_snapshots(snapshot_rows(old), snapshot_rows(new)))
    write_report(lines, str(tmp_path / "report_20260101"))
    text = [r.value for r in spark.read.text(str(tmp_path / "report_20260101")).collect()]
    assert text == ["[UPDATE] x: 1 songs, 1.00 hrs → 3 songs, 1.50 hrs (+0.50 hrs)"]

    sheet = scan_csv_missing(spark, written(tmp_path / "t.csv", 'track,artist\n"a, ""b""",c\n'))
    write_search_links(search_links(sheet).drop("pos"), str(tmp_path / "links"))
    part = next((tmp_path / "links").glob("*.csv"))
    with part.open(newline="") as file:
        assert next(csv.DictReader(file))["track"] == 'a, "b"'


def test_written_cells_come_back_as_they_were(spark, tmp_path):
    cells = [(" a ", ""), ('say "x", y', "line\nbreak"), ("\\", "007")]
    write_search_links(spark.createDataFrame(cells, "x string, y string"), str(tmp_path / "cells"))
    sheet = scan_csv(spark, str(tmp_path / "cells"))
    assert sheet.headers == ("x", "y")
    assert sorted((r.c0, r.c1) for r in sheet.frame.collect()) == sorted(cells)


def test_id_snapshots_from_files(spark, tmp_path):
    old = scan_csv(spark, written(tmp_path / "b.csv", "id,track\n123,x\n456,y\n789,z\n"))
    new = scan_csv(spark, written(tmp_path / "a.csv", "code,track\n123,x\n456,y\n999,z\n"))
    assert tuple(id_change_stats(record_ids(old), record_ids(new)).first()) == (3, 3, 1, 1, 0)


@pytest.fixture
def tiny_splits(spark):
    small = {"spark.sql.files.maxPartitionBytes": "16b", "spark.sql.files.openCostInBytes": "16b"}
    for name, value in small.items():
        spark.conf.set(name, value)
    yield
    for name in small:
        spark.conf.unset(name)


def by_file(sheet):
    """The rows of each file in file order."""
    found = {}
    for row in sheet.frame.orderBy("pos").collect():
        found.setdefault(row.pos.file, []).append(tuple(row)[:-1])
    return found


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_quoted_breaks_by_split(spark, tmp_path, tiny_splits, line_end):
    chance = random.Random(len(line_end))
    # Cells as a writer makes them, with breaks, and lines with stray quotes anywhere.
    for number in range(40):
        lines = ["x,y"]
        for _ in range(chance.randrange(12)):
            if number % 2:
                cells = ["".join(chance.choices('ab ,"\n', k=chance.randrange(9))).replace("\n", line_end) for _ in range(2)]
                lines.append(",".join('"' + c.replace('"', '""') + '"' for c in cells))
            else:
                lines.append("".join(chance.choices('aab ,"', k=chance.randrange(1, 9))))
        # Where the last quote is never closed, a line end after it would be part of the cell.
        text = line_end.join(lines) + (line_end if number % 2 else "")
        (tmp_path / f"{number:02}.csv").write_bytes(text.encode())
    whole = by_file(scan_csv(spark, str(tmp_path), by_split=False))
    parted = scan_csv(spark, str(tmp_path), by_split=True)
    assert parted.headers == ("x", "y")
    found = by_file(parted)
    assert found.keys() == whole.keys()
    wrong = [(f, whole[f], found[f]) for f in whole if whole[f] != found[f]]
    assert not wrong, (len(wrong), wrong[:2])


def test_large_files_with_quoted_breaks_have_many_tasks(spark, tmp_path):
    rows = [(f"{i:05}", "line\nbreak" * (i % 3), 'a "b"' if i % 7 else "") for i in range(5000)]
    with (tmp_path / "a.csv").open("w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([("id", "x", "y"), *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        sheet = scan_csv(spark, str(tmp_path / "a.csv"))
        assert len({r.start for r in sheet.frame.select("pos.start").distinct().collect()}) > 4
        assert [tuple(r)[:-1] for r in sheet.frame.orderBy("pos").collect()] == rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
