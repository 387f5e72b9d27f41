"""Named queries over the test tables, which are viewed as catalogs, stations and id lists."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions.lcs import lcs_length
from ledgerlink.functions.similarity import indel_ratio
from ledgerlink.functions.text import clean_text, first_token, fold_ascii, token_set
from ledgerlink.operators.blocks import artist_directory, artist_pairs
from ledgerlink.operators.catalog import curation_rows, library_rows
from ledgerlink.operators.features import features
from ledgerlink.operators.headers import Sheet
from ledgerlink.operators.positions import numbered
from ledgerlink.operators.scoring import SIGNALS, Weights, with_text_signals
from ledgerlink.plans import ids, linking, search, snapshots
from ledgerlink.sources.readers import missing_to_null, scan_csv
from ledgerlink.sources.store import shared_folder, stored
from ledgerlink.sources.writers import write_links_result, write_report, write_search_links

# --- views: the same SQL text runs on Spark and on the checking database ---------------------------

LIBRARY = """
select p_partkey as pos, cast(p_partkey as varchar(20)) as mediaid,
  p_name as track, p_brand as artist, p_type as album
from part"""

# Eight kinds of damage, by key.
CURATION = """
select p_partkey as cur_id,
  case p_partkey % 8
    when 0 then p_name
    when 1 then concat(p_name, ' (Remastered 2011)')
    when 2 then concat(substring(p_name, 1, 2), substring(p_name, 4))
    when 3 then concat(p_name, ' feat. Someone Else')
    when 4 then p_name
    when 5 then concat(upper(p_name), '!')
    when 6 then concat('zzz ', p_name)
    else concat(p_name, ' - Live at Home') end as track,
  case p_partkey % 8
    when 4 then concat(p_brand, ' Orchestra')
    when 6 then 'Nobody'
    else p_brand end as artist,
  case p_partkey % 8
    when 1 then 'NO SUCH ALBUM'
    when 3 then ''
    when 4 then ''
    else p_type end as album
from part"""

# A word from the key makes titles nearly unique, so that every block has many candidates.
WIDE_LIBRARY = LIBRARY.replace("p_name as track", "concat(p_name, ' ', cast(p_partkey % 997 as varchar(10))) as track")
WIDE_CURATION = CURATION.replace(
    "from part", "from (select p_partkey, p_brand, p_type,"
    " concat(p_name, ' ', cast(p_partkey % 997 as varchar(10))) as p_name from part) as part"
)

# Many artists behind one first word; two of eight rows name an unknown one, with an album.
HOT_LIBRARY = LIBRARY.replace("p_brand as artist", "concat('The ', p_brand, ' ', cast(p_partkey % 101 as varchar(10))) as artist")
HOT_CURATION = """
select p_partkey as cur_id,
  case when p_partkey % 3 = 0 then concat('my ', p_name) else p_name end as track,
  concat('The ', case when p_partkey % 8 < 2 then 'Band ' else '' end, p_brand, ' ', cast(p_partkey % 101 as varchar(10))) as artist,
  case when p_partkey % 16 = 0 then concat('Box ', p_type) else p_type end as album
from part"""

STATIONS_ALL = """
select concat(event_type, '-', cast(user_id % 20 as varchar(20))) as station,
  case when event_id % 97 = 0 then '1,250' else '1' end as song_count,
  case when event_id % 89 = 0 then '' else cast(value as varchar(40)) end as total_seconds
from events"""
# Two snapshots that hold the whole table between them.
STATIONS_BEFORE = STATIONS_ALL + " where ts < timestamp '2024-01-16 00:00:00'"
STATIONS_AFTER = STATIONS_ALL + " where ts >= timestamp '2024-01-16 00:00:00'"

# Hours beyond 4e10 a station, with a third decimal that is never a 5.
STATIONS_LARGE = """
select concat(event_type, '-', cast(user_id % 20 as varchar(20))) as station, '1' as song_count,
  concat(cast(cast(floor(abs(value) * 1000000000) as bigint) as varchar(30)), '.00', cast(event_id % 5 * 2 as varchar(2))) as total_hours
from events"""

# Hours as whole numbers in exponent form, which are parsed as doubles; the totals pass 2^53.
STATIONS_ROUGH = """
select concat(event_type, '-', cast(user_id % 20 as varchar(20))) as station, '1' as song_count,
  concat(cast(cast(floor(abs(value) * 1000) as bigint) as varchar(30)), 'e', cast(event_id % 11 as varchar(2))) as total_hours
from events"""

# Blank and padded names; rows with hours, with seconds only, and with neither.
STATIONS_MIXED = """
select case when event_id % 13 = 0 then '   ' when event_id % 5 = 0 then concat('  ', event_type, ' ') else event_type end as station,
  case when event_id % 97 = 0 then '1,250' else '1' end as song_count,
  case when event_id % 3 = 0 then cast(cast(floor(abs(value) * 8) as bigint) / 8.0 as varchar(40)) else '' end as total_hours,
  case when event_id % 7 = 0 then '' else cast(value as varchar(40)) end as total_seconds
from events"""

IDS_BEFORE = "select distinct o_custkey as id from orders where o_orderdate < timestamp '1998-01-01 00:00:00'"
IDS_AFTER = "select distinct o_custkey as id from orders where o_orderdate >= timestamp '1998-01-01 00:00:00'"

TRACKS_TO_SEARCH = """
select p_partkey as pos,
  case when p_partkey % 11 = 0 then '' when p_partkey % 13 = 0 then 'nan' else p_name end as track,
  case when p_partkey % 17 = 0 then null else p_brand end as artist,
  case when p_partkey % 3 = 0 then null else concat(p_type, ' ~*&') end as album
from part"""


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str = "part") -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    # The test tables hold timestamps without zone; a literal of that type keeps filters pushable.
    sql = sql.replace(" timestamp '", " timestamp_ntz '").replace(f"from {table}", "from {source}")
    return spark.sql(sql, source=source)


def _sheet(frame: DataFrame, key: str) -> tuple[Sheet, str]:
    """A view as a sheet: its text columns by position, the key column kept by name."""
    texts = [c for c in frame.columns if c != key]
    return Sheet.positional(frame.select(*texts, key), texts), key


def _library(spark: SparkSession, sf_dir: str, trim: bool = False, sql: str = LIBRARY) -> DataFrame:
    sheet, key = _sheet(_view(spark, sf_dir, sql), "pos")
    return library_rows(sheet, key, trim)


def _curation(spark: SparkSession, sf_dir: str, trim: bool = False, album: bool = True, sql: str = CURATION) -> DataFrame:
    view = _view(spark, sf_dir, sql)
    sheet, key = _sheet(view if album else view.drop("album"), "cur_id")
    return curation_rows(sheet, "curation" if album else "curation_noalbum", key, trim)


def _stations(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return _view(spark, sf_dir, sql, "events")


def _station_rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return snapshots.snapshot_rows(Sheet.of(_stations(spark, sf_dir, sql)))


def _id_rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return ids.record_ids(Sheet.of(_view(spark, sf_dir, sql, "orders")))


# --- cleaning ---------------------------------------------------------------------------------------


def cleaned_curation(spark, sf_dir, trim=False):
    return _curation(spark, sf_dir, trim).select("cur_id", "clean_track", "clean_artist", "clean_album")


def folded_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", fold_ascii("text").alias("folded"))


def cleaned_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cleaned = documents.select("doc_id", clean_text("text").alias("clean"))
    return cleaned.select(
        "doc_id", "clean",
        first_token(F.col("clean")).alias("first_token"),
        F.size(token_set(F.col("clean"))).cast("bigint").alias("tokens"),
    )


# --- signals ----------------------------------------------------------------------------------------


def _pairs(spark, sf_dir):
    """Each curation row with its own library row and with the following one."""
    cur = _curation(spark, sf_dir).select("cur_id", "clean_track", "clean_artist", "clean_album")
    lib = _library(spark, sf_dir).select(
        "pos", *(F.col(f"clean_{c}").alias(f"lib_{c}") for c in ("track", "artist", "album"))
    )
    targets = cur.withColumn("pos", F.explode(F.array(F.col("cur_id"), F.col("cur_id") + 1)))
    return targets.join(lib, "pos")


def pair_signals(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    sides = {"title": "track", "artist": "artist", "album": "album"}
    pairs = pairs.select(
        "cur_id", "pos",
        *(features(f"clean_{text}", bound=False).alias(f"a_{name}") for name, text in sides.items()),
        *(features(f"lib_{text}", bound=False).alias(f"b_{name}") for name, text in sides.items()),
    )
    scored = with_text_signals(pairs, {name: (f"a_{name}", f"b_{name}") for name in sides})
    return scored.select(
        "cur_id", "pos",
        *(F.round(signal, 6).alias(signal) for signal in SIGNALS),
        F.round(F.expr(Weights().score()), 6).alias("score"),
    )


def indel_ratios(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    pairs = pairs.select("cur_id", "pos", "clean_track", "lib_track", lcs_length("clean_track", "lib_track").alias("lcs"))
    ratio = F.expr(indel_ratio("clean_track", "lib_track", "lcs"))
    return pairs.select("cur_id", "pos", F.col("lcs").cast("bigint").alias("lcs"), F.round(ratio, 6).alias("ratio"))


# --- linking ----------------------------------------------------------------------------------------


def _hit_columns(frame: DataFrame) -> DataFrame:
    return frame.select(*linking.PAIR_KEY, F.col("hit.pos").alias("pos"), F.col("hit.track").alias("track"))


def library_last(spark, sf_dir):
    return _hit_columns(linking.keep_last(linking.library_index(_library(spark, sf_dir)), *linking.PAIR_KEY))


def library_first(spark, sf_dir):
    return _hit_columns(linking.keep_first(linking.library_index(_library(spark, sf_dir)), *linking.PAIR_KEY))


def _lookup(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    index = stored(linking.library_index(_library(spark, sf_dir)), "library-index")
    return index, linking.exact_lookup(linking.distinct_keys(_curation(spark, sf_dir)), index)


def _link_columns(links: DataFrame) -> DataFrame:
    return links.select(
        *linking.KEY, F.col("hit.pos").alias("pos"), *(F.round(s, 6).alias(s) for s in SIGNALS), "match_type"
    )


def exact_links(spark, sf_dir, v2=False):
    _, looked_up = _lookup(spark, sf_dir)
    return _link_columns(linking.exact_links(looked_up, v2=v2))


def artist_blocks(spark, sf_dir, v2=False):
    index, looked_up = _lookup(spark, sf_dir)
    artists = stored(artist_directory(linking.open_keys(looked_up), index, v2=v2), "artists")
    return artist_pairs(artists, Weights(), v2=v2).select(
        "clean_artist", "lib_artist", F.col("rank").cast("bigint").alias("rank"),
        F.round("ratio_artist", 6).alias("ratio_artist"), F.round("ngram_artist", 6).alias("ngram_artist"),
    )


def fuzzy_best(spark, sf_dir):
    index, looked_up = _lookup(spark, sf_dir)
    keys = stored(linking.open_keys(looked_up), "open-keys")
    artists = stored(artist_directory(keys, index), "artists")
    return _link_columns(linking.best_links(linking.fuzzy_candidates(keys, index, artists)))


def match_cascade(spark, sf_dir, trim=False, v2=False, album=True):
    return linking.link(_curation(spark, sf_dir, trim, album), _library(spark, sf_dir, trim), v2=v2)


def match_wide(spark, sf_dir):
    return linking.link(_curation(spark, sf_dir, sql=WIDE_CURATION), _library(spark, sf_dir, sql=WIDE_LIBRARY))


def match_hot_word(spark, sf_dir):
    return linking.link(_curation(spark, sf_dir, sql=HOT_CURATION), _library(spark, sf_dir, sql=HOT_LIBRARY))


def _two_curations(spark, sf_dir):
    both = _curation(spark, sf_dir).unionByName(_curation(spark, sf_dir, album=False))
    return linking.link(both, _library(spark, sf_dir))


def matched_rows(spark, sf_dir):
    return linking.matched(_two_curations(spark, sf_dir))


def not_found_rows(spark, sf_dir):
    return linking.not_found(_two_curations(spark, sf_dir))


def match_stats(spark, sf_dir):
    stats = linking.link_stats(_two_curations(spark, sf_dir))
    return stats.withColumn("match_rate", F.round("match_rate", 6))


# --- snapshots --------------------------------------------------------------------------------------


def station_totals(spark, sf_dir):
    return snapshots.station_totals(_station_rows(spark, sf_dir, STATIONS_ALL))


def station_totals_large(spark, sf_dir):
    return snapshots.station_totals(_station_rows(spark, sf_dir, STATIONS_LARGE))


def station_totals_rough(spark, sf_dir):
    return snapshots.station_totals(_station_rows(spark, sf_dir, STATIONS_ROUGH))


def station_totals_v2(spark, sf_dir, sql=STATIONS_ALL):
    return snapshots.station_totals(snapshots.snapshot_rows_v2(Sheet.of(_stations(spark, sf_dir, sql))))


def station_diff(spark, sf_dir):
    before, after = (_station_rows(spark, sf_dir, sql) for sql in (STATIONS_BEFORE, STATIONS_AFTER))
    return snapshots.compare_snapshots(before, after)


def station_diff_of_totals(spark, sf_dir):
    before, after = (
        snapshots.station_totals(_station_rows(spark, sf_dir, sql)) for sql in (STATIONS_BEFORE, STATIONS_AFTER)
    )
    return snapshots.compare_totals(before, after)


def station_report_lines(spark, sf_dir):
    return snapshots.report_lines(station_diff(spark, sf_dir))


def station_report_unchanged(spark, sf_dir):
    rows = _station_rows(spark, sf_dir, STATIONS_ALL)
    return snapshots.report_lines(snapshots.compare_snapshots(rows, rows))


def _reports(spark, sf_dir):
    """Changes and titles: a report of each event type, and one of each as a name that no change has."""
    changes = station_diff(spark, sf_dir).withColumn("report", F.split_part("station", F.lit("-"), F.lit(1)))
    types = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("report")).distinct()
    names = types.select(F.explode(F.array("report", F.concat(F.lit("quiet "), "report"))).alias("report"))
    return changes, names.select("report", F.concat(F.lit("*Updates:* "), "report").alias("title"))


def report_messages(spark, sf_dir, limit=snapshots.MESSAGE_LIMIT):
    return snapshots.report_messages(*_reports(spark, sf_dir), limit=limit)


def report_pieces(spark, sf_dir):
    return snapshots.report_pieces(*_reports(spark, sf_dir))


# --- ids and links ----------------------------------------------------------------------------------


def id_changes(spark, sf_dir):
    return ids.id_changes(*(_id_rows(spark, sf_dir, sql) for sql in (IDS_BEFORE, IDS_AFTER)))


def id_diff_stats(spark, sf_dir):
    return ids.id_change_stats(*(_id_rows(spark, sf_dir, sql) for sql in (IDS_BEFORE, IDS_AFTER)))


def _to_search(spark, sf_dir):
    sheet, key = _sheet(_view(spark, sf_dir, TRACKS_TO_SEARCH), "pos")
    return Sheet(missing_to_null(sheet.frame, len(sheet.headers)), sheet.headers), key


def search_links(spark, sf_dir, limit=None):
    sheet, key = _to_search(spark, sf_dir)
    return search.search_links(sheet, limit, key)


def search_links_first_half(spark, sf_dir):
    """The first half of twelve copies of the table, more rows than one task takes."""
    sheet, key = _to_search(spark, sf_dir)
    copies = sheet.frame.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(11))))
    frame = copies.withColumn(key, F.col(key) * 12 + F.col("copy")).drop("copy")
    return search.search_links(Sheet(frame, sheet.headers), 6 * sheet.frame.count(), key)


def search_links_v1(spark, sf_dir):
    sheet, key = _sheet(_view(spark, sf_dir, TRACKS_TO_SEARCH), "pos")
    return search.search_links_v1(sheet, key)


# --- results written to files and scanned again -----------------------------------------------------


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _scanned(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table as text, by its headers."""
    sheet = scan_csv(spark, path)
    return sheet.frame.select(*(F.col(f"c{i}").alias(header) for i, header in enumerate(sheet.headers)))


def links_from_files(spark, sf_dir, table):
    path = _new_folder(spark, "links-result")
    write_links_result(match_cascade(spark, sf_dir), path)
    return _scanned(spark, f"{path}/{table}/curation=curation")


def report_from_file(spark, sf_dir):
    path = _new_folder(spark, "report")
    write_report(station_report_lines(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def search_links_from_files(spark, sf_dir):
    path = _new_folder(spark, "search-links")
    write_search_links(search_links(spark, sf_dir), path)
    return _scanned(spark, path)


def documents_by_split(spark, sf_dir):
    """Texts with line breaks and quotes through CSV files that many tasks read; numbered in file order."""
    path = _new_folder(spark, "documents")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_search_links(documents.select("doc_id", "lang", "text").orderBy("doc_id"), path)
    cells = scan_csv(spark, path, by_split=True).frame
    rows = cells.select(F.col("c0").cast("bigint").alias("doc_id"), F.col("c1").alias("lang"), F.md5("c2").alias("text_md5"), "pos")
    return numbered(rows, "lang", ["pos"], "place").drop("pos")


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "clean_text": cleaned_curation,
    "clean_text_tail": lambda spark, sf_dir: cleaned_curation(spark, sf_dir, trim=True),
    "fold_documents": folded_documents,
    "clean_documents": cleaned_documents,
    "indel_ratio": indel_ratios,
    "pair_signals": pair_signals,
    "library_last": library_last,
    "library_first": library_first,
    "exact_match": exact_links,
    "exact_match_v2": lambda spark, sf_dir: exact_links(spark, sf_dir, v2=True),
    "artist_blocks": artist_blocks,
    "artist_blocks_v2": lambda spark, sf_dir: artist_blocks(spark, sf_dir, v2=True),
    "fuzzy_match_best": fuzzy_best,
    "match_cascade": match_cascade,
    "match_cascade_trim": lambda spark, sf_dir: match_cascade(spark, sf_dir, trim=True),
    "match_cascade_no_album": lambda spark, sf_dir: match_cascade(spark, sf_dir, album=False),
    "match_v2": lambda spark, sf_dir: match_cascade(spark, sf_dir, v2=True),
    "match_wide": match_wide,
    "match_hot_word": match_hot_word,
    "matched_rows": matched_rows,
    "not_found_rows": not_found_rows,
    "match_stats": match_stats,
    "station_totals": station_totals,
    "station_totals_v2": station_totals_v2,
    "station_totals_large": station_totals_large,
    "station_totals_rough": station_totals_rough,
    "station_totals_v2_mixed": lambda spark, sf_dir: station_totals_v2(spark, sf_dir, STATIONS_MIXED),
    "station_diff": station_diff,
    "station_diff_of_totals": station_diff_of_totals,
    "station_report_lines": station_report_lines,
    "station_report_unchanged": station_report_unchanged,
    "report_messages": report_messages,
    "report_messages_whole": lambda spark, sf_dir: report_messages(spark, sf_dir, limit=None),
    "report_pieces": report_pieces,
    "id_changes": id_changes,
    "id_diff_stats": id_diff_stats,
    "search_links": search_links,
    "search_links_first_100": lambda spark, sf_dir: search_links(spark, sf_dir, limit=100),
    "search_links_first_half": search_links_first_half,
    "search_links_v1": search_links_v1,
    "matched_from_files": lambda spark, sf_dir: links_from_files(spark, sf_dir, "matched"),
    "not_found_from_files": lambda spark, sf_dir: links_from_files(spark, sf_dir, "not_found"),
    "report_from_file": report_from_file,
    "search_links_from_files": search_links_from_files,
    "documents_by_split": documents_by_split,
}
