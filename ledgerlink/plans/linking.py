"""Record linkage: each curation row gets at most one library row.

First hit wins: exact on track, artist and album; exact on track and artist; best fuzzy candidate
of the row's block at or above the threshold.  All curations of a run go through one cascade, and
everything up to the last join works on distinct cleaned keys, not on rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.functions.numbers import round_half_even
from ledgerlink.operators.blocks import SLICE_ROWS, artist_directory, artist_pairs, title_pairs, word_pairs, word_seekers
from ledgerlink.operators import contenders as by_words
from ledgerlink.operators.catalog import CLEAN, curation_rows, library_rows
from ledgerlink.operators.features import features
from ledgerlink.operators.headers import with_missing
from ledgerlink.operators.scoring import SIGNALS, Weights, with_text_signals
from ledgerlink.sources.readers import scan_csv
from ledgerlink.sources.store import by_shuffle, stored
from ledgerlink.sources.writers import MATCHED_COLUMNS, NOT_FOUND_COLUMNS

KEY = ("clean_track", "clean_artist", "album_key")
PAIR_KEY = ("clean_track", "clean_artist")


def _album_key(has_album: Column | None = None) -> Column:
    """'+' and the clean album, or '' for a curation without album column, which joins nothing."""
    marked = F.concat(F.lit("+"), "clean_album")
    return marked if has_album is None else F.when(has_album, marked).otherwise("")


def library_index(library: DataFrame) -> DataFrame:
    """Per cleaned track, artist and album: row count, first and last row in file order.

    Everything the cascade looks up is derived from this.  The rows are carried through min and
    max aggregates, so each task reduces its copies of a key to one before the shuffle.
    """
    row = F.struct("pos", "mediaid", "track", "artist", "album", "clean_album")
    return library.groupBy(*CLEAN).agg(
        F.count("*").alias("n_rows"), F.min(row).alias("first"), F.max(row).alias("last")
    )


def keep_last(index: DataFrame, *key: str) -> DataFrame:
    """Per key the library row that comes last, as struct `hit`."""
    return index.groupBy(*key).agg(F.max("last").alias("hit"))


def keep_first(index: DataFrame, *key: str) -> DataFrame:
    """Per key the library row that comes first, as struct `hit`."""
    return index.groupBy(*key).agg(F.min("first").alias("hit"))


def distinct_keys(curation: DataFrame) -> DataFrame:
    """What a row's link depends on: clean track, clean artist, and the album key."""
    return curation.select(*PAIR_KEY, _album_key(F.col("has_album")).alias("album_key")).distinct()


def exact_lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Keys with their exact hit, by album first; `hit` and `match_type` are NULL without one."""
    by_album = index.select(*PAIR_KEY, _album_key().alias("album_key"), F.col("last").alias("album_hit"))
    by_pair = keep_last(index, *PAIR_KEY)
    match_type = F.when(F.col("album_hit").isNotNull(), "exact_album").when(F.col("hit").isNotNull(), "exact")
    return (
        keys.join(by_shuffle(by_album), list(KEY), "left")
        .join(by_shuffle(by_pair), list(PAIR_KEY), "left")
        .select(*KEY, F.coalesce("album_hit", "hit").alias("hit"), match_type.alias("match_type"))
    )


def exact_links(looked_up: DataFrame, *, v2: bool = False) -> DataFrame:
    """The exact hits with their signals.

    Titles and artists are equal, so only albums are compared: `exact` leaves them open.
    """
    albums = looked_up.filter("match_type is not null").select(
        "*",
        features("substr(album_key, 2)", bound=False).alias("own"),
        features("hit.clean_album", bound=False).alias("other"),
    )
    scored = with_text_signals(albums, {"album": ("own", "other")})

    def equal_texts(column: str, empty: float) -> Column:
        return F.when(F.col(column) == "", empty).otherwise(1.0)

    title, artist, album = equal_texts("clean_track", 0.5), equal_texts("clean_artist", 0.5), F.col("ratio_album")
    if v2:
        title = artist = F.lit(1.0)
        album = F.when(F.col("match_type") == "exact_album", 1.0).otherwise(album)
    return scored.select(
        *KEY, "hit",
        title.alias("ratio_title"), artist.alias("ratio_artist"), album.alias("ratio_album"),
        equal_texts("clean_track", 0.0).alias("ngram_title"),
        equal_texts("clean_artist", 0.0).alias("ngram_artist"),
        "ngram_album", "match_type",
    )


def open_keys(looked_up: DataFrame) -> DataFrame:
    """Keys without an exact hit."""
    return looked_up.filter("match_type is null").select(*KEY)


def _block_candidates(
    keys: DataFrame, offered: DataFrame, artists: DataFrame, weights: Weights, v2: bool, slice_rows: int
) -> DataFrame:
    """Pairs of keys (with `rank` and `floor`) and library rows from whole blocks, with exact signals."""
    asked = keys.select("clean_artist", F.lit(True).alias("asked")).distinct()
    artists = artists.join(by_shuffle(asked), "clean_artist", "left").withColumn("n_keys", F.when(F.col("asked"), F.col("n_keys")))
    blocks = artist_pairs(artists, weights, v2=v2, slice_rows=slice_rows, near=True)
    pairs = title_pairs(keys, offered, artists, blocks, weights)
    seekers = word_seekers(keys.filter("rank = 1"), artists, v2=v2)
    if weights.bounded and not seekers.isEmpty():
        pairs = pairs.unionByName(word_pairs(seekers, offered, weights, slice_rows))
    artist = {"ratio_artist": "ratio_artist", "ngram_artist": "ngram_artist"}
    return with_text_signals(
        pairs, {"title": ("key_title", "lib_title"), "album": ("key_album", "lib_album")},
        lambda bounds: weights.reachable(bounds | artist, "floor"),
    ).select(*KEY, "rank", "hit", *SIGNALS)


def fuzzy_candidates(
    keys: DataFrame, index: DataFrame, artists: DataFrame, weights: Weights | None = None, *,
    v2: bool = False, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Candidate pairs with exact signals and `score`; pairs below the threshold, or that another beats, may be absent.

    Library rows are reduced to the first one per track and artist, so later albums of a track
    do not compete. Under the v2 rules they do.

    `keys` and `artists` should be stored tables: what words can tell is asked here, and whether any
    key is left that they cannot tell.
    """
    weights = weights or Weights()
    offered = index.select(*PAIR_KEY, F.col("first").alias("hit")) if v2 else keep_first(index, *PAIR_KEY)
    if not weights.bounded:
        both = F.explode(F.array(F.lit(0), F.lit(1)))
        every = keys.select("*", both.alias("rank"), F.lit(weights.min_score).alias("floor"))
        scored = _block_candidates(every, offered, artists, weights, v2, slice_rows)
    else:
        shelf = by_words.shelf(offered)
        sought = by_words.sought(keys, artists, shelf, weights, v2, slice_rows)
        floored = by_words.with_floors(sought, shelf, weights, slice_rows)
        scored, left_over = by_words.contenders(floored, shelf, weights, slice_rows)
        if not left_over.isEmpty():
            scored = scored.unionByName(_block_candidates(left_over, offered, artists, weights, v2, slice_rows))
    return scored.select(*KEY, "rank", "hit", *SIGNALS, F.expr(weights.score()).alias("score"))


def best_links(candidates: DataFrame, weights: Weights | None = None, *, v2: bool = False) -> DataFrame:
    """Per key the best candidate at or above the threshold; ties go to the earlier library row.

    `row_number() = 1` lets Spark drop all but the local best of a key before the shuffle.  The
    threshold is tested on the winner: tested earlier, the whole score formula would be pushed
    down and evaluated twice.
    """
    weights = weights or Weights()
    floor = -1.0 if v2 else 0.0
    best_first = Window.partitionBy(*KEY).orderBy(F.col("score").desc(), "rank", "hit.pos")
    album_counts = (F.col("ratio_album") > 0) | (F.col("ngram_album") > 0)
    return (
        candidates.withColumn("_place", F.row_number().over(best_first))
        .filter((F.col("_place") == 1) & (F.col("score") > floor) & (F.col("score") >= weights.min_score))
        .select(
            *KEY, "hit", *SIGNALS,
            F.when(album_counts & (F.col("album_key") != ""), "fuzzy_album").otherwise("fuzzy").alias("match_type"),
        )
    )


def link(
    curation: DataFrame, library: DataFrame, weights: Weights | None = None, *,
    v2: bool = False, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """All curation rows with their library row, rounded signals and match type (NULL: not found).

    The steps up to the best fuzzy link of each key are stored when this is called, each as a table of
    its own, so that no job holds all of them.  The rest, exact links and the join to the rows, is lazy.

    The join back to the rows has one right row per key, so a key on very many rows is a skew that
    adaptive execution splits.
    """
    index = stored(library_index(library), "library-index")
    looked_up = stored(exact_lookup(distinct_keys(curation), index), "exact-lookup")
    remaining = open_keys(looked_up)
    artists = stored(artist_directory(remaining, index, v2=v2, slice_rows=slice_rows), "artists")
    candidates = fuzzy_candidates(remaining, index, artists, weights, v2=v2, slice_rows=slice_rows)
    best = stored(best_links(candidates, weights, v2=v2), "best-links")
    links = exact_links(looked_up, v2=v2).unionByName(best).select(
        *KEY,
        F.col("hit.mediaid").alias("mediaid"),
        F.col("hit.track").alias("matched_track"),
        F.col("hit.artist").alias("matched_artist"),
        F.col("hit.album").alias("matched_album"),
        *(round_half_even(F.col(signal), 3).alias(signal) for signal in SIGNALS),
        "match_type",
    )
    rows = curation.select(
        "cur_id", "curation", "track", "artist", "album",
        *PAIR_KEY, _album_key(F.col("has_album")).alias("album_key"),
    )
    return rows.join(by_shuffle(links), list(KEY), "left").drop(*KEY)


def matched(linked: DataFrame) -> DataFrame:
    return with_missing(linked.filter("match_type is not null"), ("cur_id", "curation", *MATCHED_COLUMNS))


def not_found(linked: DataFrame) -> DataFrame:
    return with_missing(linked.filter("match_type is null"), ("cur_id", "curation", *NOT_FOUND_COLUMNS))


def link_stats(linked: DataFrame) -> DataFrame:
    """Per curation: rows, matched, not found, match rate in percent."""
    counts = linked.groupBy("curation").agg(
        F.count("*").alias("total"), F.count("match_type").alias("matched")
    )
    return counts.select(
        "curation", "total", "matched",
        (F.col("total") - F.col("matched")).alias("not_found"),
        (100.0 * F.col("matched") / F.col("total")).alias("match_rate"),
    )


def link_files(
    spark: SparkSession,
    library_path: str,
    curation_paths: Sequence[str],
    weights: Weights | None = None,
    *,
    trim_tail: bool = False,
    v2: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """`link` over CSV files; each curation goes by its path."""
    library = library_rows(scan_csv(spark, library_path, multi_line=multi_line), trim_tail=trim_tail)
    curation = None
    for path in curation_paths:
        rows = curation_rows(scan_csv(spark, path, multi_line=multi_line), path, trim_tail=trim_tail)
        curation = rows if curation is None else curation.unionByName(rows)
    if curation is None:
        raise ValueError("no curation given")
    return link(curation, library, weights, v2=v2)
