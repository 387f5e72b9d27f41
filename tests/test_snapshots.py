import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators.headers import MissingColumnError, Sheet
from ledgerlink.functions.numbers import round_half_even
from ledgerlink.operators.packing import pack_lines, whole_pieces
from ledgerlink.plans.snapshots import (
    NO_CHANGES,
    compare_snapshots,
    compare_totals,
    report_lines,
    report_messages,
    snapshot_rows,
    snapshot_rows_v2,
    station_totals,
)
from tests import plain


def sheet(spark, rows, headers=("Station", "song_count", "total_hours")):
    columns = [f"x{i}" for i in range(len(headers))]
    return Sheet.positional(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)), headers)


def totals(frame):
    return {r.station: (r.songs, r.hours) for r in station_totals(frame).collect()}


def test_totals(spark):
    rows = [("a", "1", "0.1"), ("a", "2.9", "0.2"), ("a", "1,250", "bad"), ("", " 12 ", "1e1"), ("b", "-3", "2.675"), ("c", "inf", "inf")]
    got = totals(snapshot_rows(sheet(spark, rows)))
    assert got == {"a": (3, 0.3), "": (12, 10.0), "b": (-3, 2.67), "c": (0, float("inf"))}


def test_totals_from_seconds(spark):
    rows = [("a", "1", "1800"), ("a", "1", "900"), ("b", "", "")]
    got = totals(snapshot_rows(sheet(spark, rows, ("name", "songs", "seconds"))))
    assert got == {"a": (2, 0.75), "b": (0, 0.0)}


def test_totals_v2(spark):
    rows = [(" a ", "1,250", "0.005", "36"), ("a", "1", "", "1,800"), ("  ", "5", "5", "5"), ("b", "x", "x", "3600")]
    got = totals(snapshot_rows_v2(sheet(spark, rows, ("station", "songs", "hours", "seconds"))))
    # 0.005 rounds to 0.01 by its binary value; hours win over seconds wherever they are not empty
    assert got == {"a": (1251, round(round(0.005, 2) + 0.5, 2)), "b": (0, 0.0)}


def test_required_columns(spark):
    with pytest.raises(MissingColumnError):
        snapshot_rows(sheet(spark, [("a", "1")], ("station", "songs")))
    with pytest.raises(MissingColumnError):
        snapshot_rows(sheet(spark, [("a", "1", "1")], ("station", "songs", "Total Hours")))


def test_changes_and_report(spark):
    before = sheet(spark, [("gone", "2", "3"), ("same", "1", "1"), ("é", "1", "1"), ("z", "1", "1.004")])
    after = sheet(spark, [("new", "4", "0.5"), ("same", "1", "1.001"), ("é", "2", "1"), ("z", "1", "1.006")])
    rows = snapshot_rows(before), snapshot_rows(after)
    changes = compare_snapshots(*rows)
    assert [r.line for r in report_lines(changes).collect()] == [
        "[UPDATE] gone: 2 songs, 3.00 hrs → 0 songs, 0.00 hrs (+-3.00 hrs)",
        "[UPDATE] new: 0 songs, 0.00 hrs → 4 songs, 0.50 hrs (+0.50 hrs)",
        "[UPDATE] z: 1 songs, 1.00 hrs → 1 songs, 1.01 hrs (+0.01 hrs)",
        "[UPDATE] é: 1 songs, 1.00 hrs → 2 songs, 1.00 hrs (+0.00 hrs)",
    ]
    again = compare_totals(*(station_totals(r) for r in rows))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, changes.collect()))
    assert [r.line for r in report_lines(compare_snapshots(rows[0], rows[0])).collect()] == [NO_CHANGES]
    assert [r.line for r in report_lines(compare_snapshots(rows[0].limit(0), rows[0].limit(0))).collect()] == [NO_CHANGES]


def test_messages(spark):
    changes = spark.createDataFrame([("r", f"s{i:03}", "x" * i) for i in range(40)], "report string, station string, line string")
    titles = spark.createDataFrame([("r", "Title"), ("quiet", "Nothing")], "report string, title string")
    lines = ["Title", *("x" * i for i in range(40))]
    got = report_messages(changes, titles, limit=100).orderBy("report", "message_no").collect()
    assert plain.well_packed(lines, [r.message for r in got if r.report == "r"], 100)
    assert [r.message for r in got if r.report == "quiet"] == [f"Nothing\n{NO_CHANGES}\n"]
    whole = {r.report: r.message for r in report_messages(changes, titles, limit=None).collect()}
    assert whole == {"r": "\n".join(lines), "quiet": f"Nothing\n{NO_CHANGES}"}


@pytest.mark.parametrize("limit", [10, 40])
def test_packing_across_partitions(spark, limit):
    rnd = random.Random(limit)
    rows, expected = [], {}
    for report in map(str, range(8)):
        count = 2500 if report in "01" else rnd.choice([1, 3, 50])
        long_ = [limit // 3, limit - 2, limit - 1, limit, limit + 3]
        lines = ["T" * rnd.choice([1, *long_])]
        lines += ["é" * (rnd.choice(long_) if rnd.random() < 0.2 else rnd.randint(0, 8)) for _ in range(count)] + ["end"]
        rows += [(report, i, line) for i, line in enumerate(lines)]
        expected[report] = lines
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "report string, i int, line string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {}
        for r in pack_lines(frame, "report", ("i",), limit).orderBy("report", "message_no").collect():
            got.setdefault(r.report, []).append(r.message)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == set(expected)
    assert all(plain.well_packed(lines, got[report], limit) for report, lines in expected.items())


def test_packing_by_hand(spark):
    rows = [("a", 0, "123456"), ("a", 1, "12"), ("a", 2, "1"), ("a", 3, "x" * 12), (None, 0, "n1"), (None, 1, "n2"), ("b", 0, "u\u2028v\rw")]
    frame = spark.createDataFrame(rows, "report string, i int, line string")
    got = {}
    for r in pack_lines(frame, "report", ("i",), 10).orderBy("report", "message_no").collect():
        got.setdefault(r.report, []).append(r.message)
    assert got == {"a": ["123456\n12\n", "1\n", "x" * 12 + "\n"], None: ["n1\nn2\n"], "b": ["u\nv\nw\n"]}
    whole = {r.report: r.message for r in pack_lines(frame, "report", ("i",), None).collect()}
    assert whole == {"a": "123456\n12\n1\n" + "x" * 12, None: "n1\nn2", "b": "u\u2028v\rw"}


def test_many_lines_of_a_report_without_name(spark):
    frame = spark.createDataFrame([(None, i, f"line {i}") for i in range(3000)], "report string, i int, line string").repartition(5)
    messages = [r.message for r in pack_lines(frame, "report", ("i",), 50).orderBy("message_no").collect()]
    assert plain.well_packed([f"line {i}" for i in range(3000)], messages, 50)


def test_sums_of_doubles_are_exact_in_any_order(spark):
    rnd, rows, exact = random.Random(5), [], {}
    for station in map(str, range(200)):
        for _ in range(rnd.choice([1, 2, 5, 40])):
            value = rnd.uniform(-1, 1) * 2.0 ** rnd.choice([rnd.randint(-60, 60), rnd.randint(-900, 900)])
            values = [rnd.choice([value, value, 2.0**32, -(2.0**64), 1e16, 5e-324, 1.7e308, -1.7e308, 1e15, 0.1])]
            values += [-values[0]] * (rnd.random() < 0.3)
            rows += [(station, "1", repr(v) + ("" if "e" in repr(v) else "e0")) for v in values]
            exact[station] = exact.get(station, Fraction(0)) + sum(map(Fraction, values))

    def nearest(x):
        try:
            return float(x)
        except OverflowError:
            return math.inf if x > 0 else -math.inf

    wanted = spark.createDataFrame([(k, nearest(v)) for k, v in exact.items()], "station string, hours double")
    wanted = {r.station: r.hours for r in wanted.select("station", round_half_even(F.col("hours"), 2).alias("hours")).collect()}
    for _ in range(2):
        rnd.shuffle(rows)
        assert {k: h for k, (_, h) in totals(snapshot_rows(sheet(spark, rows))).items()} == wanted


@pytest.mark.parametrize("digits", [14, 15, 17, 18, 19, 21])
def test_sums_beyond_the_digits_of_a_decimal(spark, digits):
    rnd = random.Random(digits)
    whole = [rnd.randint(10 ** (digits - 1), 10**digits) for _ in range(300)]
    rows = [("a", "1", str(v)) for v in whole] + [("b", "1", f"-{v}") for v in whole] + [("c", "1", "inf"), ("c", "1", str(whole[0]))]
    rows += [("d", "1", "inf"), ("d", "1", "-inf"), ("e", "1", "")]
    total = float(sum(whole) if digits <= 18 else sum(map(Fraction, map(float, whole))))
    got = totals(snapshot_rows(sheet(spark, rows)))
    assert (got["a"][1], got["b"][1], got["c"][1], got["e"][1]) == (total, -total, math.inf, 0.0)
    assert math.isnan(got["d"][1])
    rnd.shuffle(rows)
    assert repr(totals(snapshot_rows(sheet(spark, rows)))["a"]) == repr(got["a"])


def test_pieces_of_whole_reports(spark):
    sizes = {"long": 2503, "short": 3, None: 1200}
    rows = [(report, i, f"{report} {i}") for report, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "report string, i int, line string").repartition(6)
    got = {}
    for r in whole_pieces(frame, "report", ("i",), 100).orderBy("report", "piece").collect():
        got.setdefault(r.report, []).append((r.piece, r.text))
    for report, n in sizes.items():
        assert [p for p, _ in got[report]] == list(range(-(-n // 100)))
        assert "\n".join(t for _, t in got[report]) == "\n".join(f"{report} {i}" for i in range(n))
    assert whole_pieces(frame.limit(0), "report", ("i",)).count() == 0
