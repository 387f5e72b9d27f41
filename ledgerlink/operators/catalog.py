"""Canonical catalog rows: track / artist / album, raw and cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.text import clean_text
from ledgerlink.operators.headers import MATCH_ALBUM, MATCH_ARTIST, MATCH_TRACK, Sheet, require, resolve

CLEAN = ("clean_track", "clean_artist", "clean_album")


def with_cleaned(frame: DataFrame, trim_tail: bool = False) -> DataFrame:
    """Add the cleaned form of track, artist and album."""
    cleaned = [clean_text(c, trim_tail).alias(f"clean_{c}") for c in ("track", "artist", "album")]
    return frame.select("*", *cleaned)


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _canonical(sheet: Sheet) -> tuple[list[Column], bool]:
    track = require(sheet.headers, MATCH_TRACK)
    artist = require(sheet.headers, MATCH_ARTIST)
    album = resolve(sheet.headers, MATCH_ALBUM)
    columns = [
        _text(sheet[track]).alias("track"),
        _text(sheet[artist]).alias("artist"),
        (F.lit("") if album is None else _text(sheet[album])).alias("album"),
    ]
    return columns, album is not None


def library_rows(sheet: Sheet, pos: str = "pos", trim_tail: bool = False) -> DataFrame:
    """Library rows: file position, media id ('' when the table has none), raw and clean texts."""
    columns, _ = _canonical(sheet)
    media = _text(sheet["mediaid"]) if "mediaid" in sheet.headers else F.lit("")
    rows = sheet.frame.select(F.col(pos).alias("pos"), media.alias("mediaid"), *columns)
    return with_cleaned(rows, trim_tail)


def curation_rows(sheet: Sheet, name: str, pos: str = "pos", trim_tail: bool = False) -> DataFrame:
    """Curation rows, with the curation's name and whether it has an album column at all."""
    columns, has_album = _canonical(sheet)
    rows = sheet.frame.select(
        F.col(pos).alias("cur_id"),
        F.lit(name).alias("curation"),
        F.lit(has_album).alias("has_album"),
        *columns,
    )
    return with_cleaned(rows, trim_tail)
