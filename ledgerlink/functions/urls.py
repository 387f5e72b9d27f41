"""Search-link text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The links the reference opens.
SEARCH_PREFIX = "https://www.amazon.com/s?k="
SEARCH_SUFFIX = "&i=digital-music"


def form_encode(text: Column) -> Column:
    """Percent-encode for a query string, spaces as `+`, `~` kept and `*` encoded."""
    encoded = F.url_encode(text)
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))


def search_url(query: Column) -> Column:
    return F.concat(F.lit(SEARCH_PREFIX), form_encode(query), F.lit(SEARCH_SUFFIX))


def search_url_v1(track: Column, artist: Column) -> Column:
    """Raw parts joined by `+`, neither encoded nor limited to a category."""
    return F.concat(F.lit(SEARCH_PREFIX), track, F.lit("+"), artist)
