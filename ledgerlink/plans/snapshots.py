"""Snapshot comparison: station totals before and after, changed stations, report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.numbers import (
    exact_digits,
    fixed2,
    parse_number,
    parse_number_v2,
    plain_decimal,
    round_half_even,
    to_count,
    total_of_digits,
)
from ledgerlink.functions.text import strip_spaces
from ledgerlink.operators.headers import (
    HOURS,
    SECONDS,
    SONGS,
    STATION,
    MissingColumnError,
    Sheet,
    require_station,
    resolve_station,
)
from ledgerlink.operators.packing import MESSAGE_LIMIT, pack_lines, whole_pieces
from ledgerlink.sources.store import stored

NO_CHANGES = "[info] no changes."


def _cells(sheet: Sheet) -> dict[str, Column | None]:
    def text(header: str | None) -> Column | None:
        return None if header is None else F.coalesce(sheet[header].cast("string"), F.lit(""))

    cells = {
        "station": text(require_station(sheet.headers, STATION)),
        "songs": text(require_station(sheet.headers, SONGS)),
        "hours": text(resolve_station(sheet.headers, HOURS)),
        "seconds": text(resolve_station(sheet.headers, SECONDS)),
    }
    if cells["hours"] is None and cells["seconds"] is None:
        raise MissingColumnError(f"need an hours or a seconds column; available: {list(sheet.headers)}")
    return cells


def snapshot_rows(sheet: Sheet) -> DataFrame:
    """Typed rows: station, songs, and the amount of time split for an order-independent sum.

    Amounts written as plain decimals go to `exact`, everything else (exponents, infinities) to
    `rough`; `unit` divides the total into hours.  Bad cells count as 0.  The hours column wins
    over seconds for the whole table.
    """
    cells = _cells(sheet)
    amount = cells["hours"] if cells["hours"] is not None else cells["seconds"]
    exact = plain_decimal(amount)
    return sheet.frame.select(
        cells["station"].alias("station"),
        to_count(parse_number(cells["songs"])).alias("songs"),
        exact.alias("exact"),
        F.when(exact.isNull(), parse_number(amount)).otherwise(0.0).alias("rough"),
        F.lit(1.0 if cells["hours"] is not None else 3600.0).alias("unit"),
    )


def snapshot_rows_v2(sheet: Sheet) -> DataFrame:
    """v2 rules: thousands commas allowed, blank stations dropped, hours or else seconds per row,
    each row's hours rounded to 2 decimals before they are summed."""
    cells = _cells(sheet)

    def parsed(cell: Column | None) -> Column:
        """NULL for an empty cell."""
        return F.lit(None).cast("double") if cell is None else F.when(cell != "", parse_number_v2(cell))

    # Parsing and rounding are separate steps: rounding names its input many times.
    rows = sheet.frame.select(
        strip_spaces(cells["station"]).alias("station"),
        to_count(parse_number_v2(cells["songs"])).alias("songs"),
        parsed(cells["hours"]).alias("hours"),
        parsed(cells["seconds"]).alias("seconds"),
    ).filter("station != ''")
    rows = rows.select(
        "station", "songs",
        F.coalesce("hours", to_count(F.col("seconds")).cast("double") / 3600.0).alias("hours"),
    )
    rows = rows.select("station", "songs", round_half_even(F.col("hours"), 2).alias("hours"))
    # A double of two decimals is a decimal again; only huge, infinite or NaN hours stay rough.
    fits = (F.abs("hours") < 1e15) & ~F.isnan("hours")
    rows = rows.withColumn("exact", F.when(fits, F.col("hours").try_cast("decimal(28,9)")))
    return rows.select(
        "station", "songs", "exact",
        F.when(F.col("exact").isNull(), F.col("hours")).otherwise(0.0).alias("rough"),
        F.lit(1.0).alias("unit"),
    )


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Per value of `keys` and side: songs, and the parts of the hours, each summed without rounding.

    Decimals add up to the same total in any order, which doubles do not.  So doubles are summed as
    digits, by place; a row without doubles stays one row.  A place is summed per task, then over
    tasks, and a group has some seventy places at most.
    """
    parts = rows.withColumn("digits", exact_digits("rough")).select(
        *keys, "songs", "exact", "unit",
        F.when((F.abs("rough") == float("inf")) | F.isnan("rough"), F.col("rough")).alias("special"),
        F.explode(F.concat(F.array(F.struct(F.lit(None).cast("int").alias("place"), F.lit(0).cast("bigint").alias("digit"))), "digits")).alias("part"),
    )

    def own(column: str) -> Column:
        """The column, once a row."""
        return F.when(F.col("part.place").isNull(), F.col(column))

    return parts.groupBy(*keys, F.col("part.place").alias("place")).agg(
        F.sum(own("songs")).alias("songs"), F.sum(own("exact")).alias("exact"), F.sum(own("special")).alias("special"),
        F.max("unit").alias("unit"), F.sum(F.col("part.digit").cast("decimal(28,0)")).alias("digit"),
    )


def _totals(when: str = "true") -> tuple[Column, Column]:
    """(songs, hours) of a group of `_sums` rows, of those where `when` holds; hours are rounded after the sum."""

    def of(column: str) -> Column:
        return F.expr(f"CASE WHEN {when} THEN {column} END")

    digit = "named_struct('place', place, 'digit', CAST(digit AS DECIMAL(38,0)))"
    digits = F.expr(total_of_digits(f"collect_list(CASE WHEN {when} AND place IS NOT NULL THEN {digit} END)"))
    amount = F.coalesce(F.sum(of("exact")).cast("double"), F.lit(0.0)) + digits + F.coalesce(F.sum(of("special")), F.lit(0.0))
    amount = F.coalesce(amount / F.max(of("unit")), F.lit(0.0))
    # Rounding names its input many times; the one-element array computes it once.
    hours = F.element_at(F.transform(F.array(amount), lambda value: round_half_even(value, 2)), 1)
    return F.coalesce(F.sum(of("songs")), F.lit(0).cast("bigint")), hours


def station_totals(rows: DataFrame) -> DataFrame:
    songs, hours = _totals()
    return _sums(rows, "station").groupBy("station").agg(songs.alias("songs"), hours.alias("hours"))


def compare_snapshots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Stations whose songs or hours changed; a station absent from one side counts 0 there.

    Both snapshots go through one grouping (pre-aggregated per task) rather than two groupings and a
    full join.
    """
    both = before.withColumn("new", F.lit(False)).unionByName(after.withColumn("new", F.lit(True)))
    (b_songs, b_hours), (a_songs, a_hours) = _totals("NOT new"), _totals("new")
    totals = _sums(both, "station", "new").groupBy("station").agg(
        b_songs.alias("songs_before"), b_hours.alias("hours_before"),
        a_songs.alias("songs_after"), a_hours.alias("hours_after"),
    )
    return with_change(totals)


def compare_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """As `compare_snapshots`, for totals that exist already (one row per station and side)."""
    def side(totals: DataFrame, suffix: str) -> DataFrame:
        return totals.select("station", *(F.col(c).alias(f"{c}_{suffix}") for c in ("songs", "hours")))

    joined = side(before, "before").join(side(after, "after"), "station", "full")
    return with_change(joined.fillna(0))


def with_change(totals: DataFrame) -> DataFrame:
    """Keep changed stations and add the change in hours and the report line."""
    # NaN differs from everything, itself included.
    hours_differ = (
        (F.col("hours_before") != F.col("hours_after")) | F.isnan("hours_before") | F.isnan("hours_after")
    )
    changed = totals.filter((F.col("songs_before") != F.col("songs_after")) | hours_differ)
    delta = round_half_even(F.col("hours_after") - F.col("hours_before"), 2)
    return changed.withColumn("delta_hours", delta).withColumn("line", update_line())


def update_line() -> Column:
    """Fixed format of a report line. The plus sign is literal: a drop reads `+-3.00`."""
    return F.format_string(
        "[UPDATE] %s: %s songs, %s hrs → %s songs, %s hrs (+%s hrs)",
        "station", F.col("songs_before").cast("string"), fixed2(F.col("hours_before")),
        F.col("songs_after").cast("string"), fixed2(F.col("hours_after")), fixed2(F.col("delta_hours")),
    )


def report_lines(changes: DataFrame) -> DataFrame:
    """Report in station order, one line per change, or the single line that nothing changed."""
    lines = stored(changes.select("station", "line"), "report-lines")  # used twice, and sampled by the sort
    nothing = (
        lines.limit(1).agg(F.count("*").alias("n")).filter("n = 0")
        .select(F.lit("").alias("station"), F.lit(NO_CHANGES).alias("line"))
    )
    return lines.unionByName(nothing).orderBy("station").select("line")


def _sections(changes: DataFrame, titles: DataFrame, by: str) -> DataFrame:
    """The lines of all reports by section: the title, then changes by station or that there are none."""
    changes = stored(changes.select(by, "station", "line"), "report-changes")  # used twice, and sampled by the sort
    changed = changes.select(by).distinct().withColumn("changed", F.lit(True))
    titles = titles.withColumn("title_of", F.col(by)).drop(by)
    quiet = titles.join(changed, F.col("title_of").eqNullSafe(F.col(by)), "left").filter("changed is null")
    quiet, titles = (t.select(F.col("title_of").alias(by), "title") for t in (quiet, titles))
    return (
        titles.select(by, F.lit(0).alias("section"), F.lit("").alias("station"), F.col("title").alias("line"))
        .unionByName(changes.select(by, F.lit(1).alias("section"), "station", "line"))
        .unionByName(quiet.select(by, F.lit(1).alias("section"), F.lit("").alias("station"), F.lit(NO_CHANGES).alias("line")))
    )


def report_messages(
    changes: DataFrame, titles: DataFrame, by: str = "report", limit: int | None = MESSAGE_LIMIT
) -> DataFrame:
    """Messages of at most `limit` characters per report, title first, lines in station order.

    `changes` has a report column; `titles` one row (report, title) for every report that is sent,
    changed or not.  `limit=None` gives one message per report.
    """
    return pack_lines(_sections(changes, titles, by), by, ("section", "station"), limit)


def report_pieces(changes: DataFrame, titles: DataFrame, by: str = "report") -> DataFrame:
    """As `report_messages` without limit, each message as ordered pieces: report, piece, text."""
    return whole_pieces(_sections(changes, titles, by), by, ("section", "station"))
