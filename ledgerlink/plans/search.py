"""Search links for tracks, e.g. those a linking run did not find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.text import strip_spaces
from ledgerlink.functions.urls import search_url, search_url_v1
from ledgerlink.operators.headers import LINK_ALBUM, LINK_ARTIST, LINK_TRACK, Sheet, require, resolve
from ledgerlink.operators.positions import first_by

#: Up to here each task keeps its own first rows and one task merges them; beyond, no task holds them all.
TOP_ROWS = 10_000


def first_rows(frame: DataFrame, limit: int | None, pos: str = "pos") -> DataFrame:
    """The first `limit` rows in file order; 0 or None keeps all."""
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    if not limit:
        return frame
    return frame.orderBy(pos).limit(limit) if limit <= TOP_ROWS else first_by(frame, pos, limit)


def complete(track: Column, artist: Column) -> Column:
    """Whether both stripped texts are there; the text `nan` stands for a missing cell."""
    return (track != "") & (track != "nan") & (artist != "") & (artist != "nan")


def search_text(track: Column, artist: Column, album: Column | None) -> Column:
    """`track artist album`; the album joins in wherever it is not missing, even if blank."""
    query = F.concat_ws(" ", track, artist)
    return query if album is None else F.when(album.isNotNull(), F.concat(query, F.lit(" "), album)).otherwise(query)


def search_links(sheet: Sheet, limit: int | None = None, pos: str = "pos") -> DataFrame:
    """pos, track, artist, album, url of every complete row among the first `limit` input rows.

    Missing cells are NULL.  Apart from a limit nothing here shuffles.
    """
    track = sheet[require(sheet.headers, LINK_TRACK)]
    artist = sheet[require(sheet.headers, LINK_ARTIST)]
    album_header = resolve(sheet.headers, LINK_ALBUM)
    album = F.lit(None).cast("string") if album_header is None else sheet[album_header].cast("string")

    def stripped(cell: Column) -> Column:
        return strip_spaces(F.coalesce(cell.cast("string"), F.lit("nan")))

    rows = first_rows(sheet.frame, limit, pos).select(
        pos, stripped(track).alias("track"), stripped(artist).alias("artist"), strip_spaces(album).alias("album")
    )
    query = search_text(F.col("track"), F.col("artist"), F.col("album"))
    return rows.filter(complete(F.col("track"), F.col("artist"))).withColumn("url", search_url(query))


def search_links_v1(sheet: Sheet, pos: str = "pos") -> DataFrame:
    """First column title, second artist, whatever they are called; texts go into the link raw."""
    if len(sheet.headers) < 2:
        raise ValueError("need a title and an artist column")
    track, artist = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("c0", "c1"))
    return sheet.frame.select(
        pos, track.alias("track"), artist.alias("artist"), search_url_v1(track, artist).alias("url")
    )
