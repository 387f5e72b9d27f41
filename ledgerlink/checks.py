"""The named queries again, as plain SQL for an independent database (DuckDB dialect)."""

from __future__ import annotations

from ledgerlink import workload as w
from ledgerlink.functions.text import EDITION_KEYWORDS
from ledgerlink.functions.urls import SEARCH_PREFIX, SEARCH_SUFFIX

# --- scalar pieces ----------------------------------------------------------------------------------


def _fold(x: str) -> str:
    # Enough for these tables: their only non-ASCII characters are accented letters and sharp s.
    return f"regexp_replace(strip_accents({x}), '[^[:ascii:]]', '', 'g')"


def _clean(x: str, trim: bool = False) -> str:
    if trim:
        x = rf"regexp_replace({x}, '\s*[-:–—]\s*({EDITION_KEYWORDS}).*$', '', 'gi')"
    x = _fold(x)
    x = rf"regexp_replace({x}, '\s*[\(\[].*?[\)\]]', '', 'g')"
    x = rf"regexp_replace({x}, 'feat\.? .*', '', 'gi')"
    return f"lower(trim(regexp_replace(replace({x}, '&', 'and'), '[^a-zA-Z0-9 ]', '', 'g')))"


def _tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def _rounded(x: str, digits: int) -> str:
    """Rounding by exact binary value, ties to even."""
    scale = f"{10**digits}::double"
    return (
        f"(select case when abs(s - f - 0.5) > 0.01 then floor(s + 0.5) when beyond > 0 then f + 1"
        f" when beyond < 0 then f else f + f % 2 end / {scale} * case when v < 0 then -1 else 1 end"
        f" from (select v, s, f, (hi * (2 * {scale}) - (2 * f + 1)) + (a - hi) * (2 * {scale}) as beyond"
        f" from (select v, a, a * {scale} as s, floor(a * {scale}) as f,"
        f" a * 134217729::double - (a * 134217729::double - a) as hi from (select ({x}) as v, abs({x}) as a))))"
    )


def _with(*steps: tuple[str, str], then: str, recursive: bool = False) -> str:
    body = ",\n".join(f"{name} as ({sql})" for name, sql in steps)
    return f"with {'recursive ' if recursive else ''}{body}\n{then}"


# --- linking ----------------------------------------------------------------------------------------


def _cleaned(sql: str, trim: bool) -> str:
    columns = ", ".join(f"{_clean(c, trim)} as clean_{c}" for c in ("track", "artist", "album"))
    return f"select *, {columns} from ({sql})"


def _base(trim=False, album=True, library=w.LIBRARY, curation=w.CURATION, both=False) -> list[tuple[str, str]]:
    """lib, cur, keys."""
    with_album = f"select *, 'curation' as curation, true as has_album from ({curation})"
    without = f"select * replace ('' as album), 'curation_noalbum' as curation, false as has_album from ({curation})"
    rows = f"{with_album} union all {without}" if both else (with_album if album else without)
    key = "case when has_album then '+' || clean_album else '' end as album_key"
    return [
        ("lib", _cleaned(library, trim)),
        ("cur", f"select *, {key} from ({_cleaned(rows, trim)})"),
        ("keys", "select distinct clean_track, clean_artist, album_key from cur"),
    ]


def _kept(key: str, order: str, name: str = "lib") -> str:
    return f"select * from {name} qualify row_number() over (partition by {key} order by pos {order}) = 1"


_LASTS = [
    ("last3", _kept("clean_track, clean_artist, clean_album", "desc")),
    ("last2", _kept("clean_track, clean_artist", "desc")),
]

# Exact pairs (key, library position, match type).
_EXACT = (
    "exact_pairs",
    """select k.*, coalesce(l3.pos, l2.pos) as pos, 0 as rank,
       case when l3.pos is not null then 'exact_album' else 'exact' end as match_type
     from keys k join last2 l2 using (clean_track, clean_artist)
     left join last3 l3 on l3.clean_track = k.clean_track and l3.clean_artist = k.clean_artist
       and k.album_key = '+' || l3.clean_album""",
)

_OPEN = (
    "open_keys",
    """select k.* from keys k
     where not exists (select 1 from lib l where l.clean_track = k.clean_track and l.clean_artist = k.clean_artist)""",
)


def _blocks(v2: bool) -> list[tuple[str, str]]:
    few = "coalesce(own.n, 0) < 10" if v2 else "own.n is null"
    return [
        ("lib_artists", "select clean_artist, count(*) as n from lib group by 1"),
        ("own_blocks", """select distinct k.clean_artist, k.clean_artist as lib_artist, 0 as rank
           from open_keys k join lib_artists using (clean_artist)"""),
        ("word_blocks", f"""select distinct k.clean_artist, a.clean_artist as lib_artist, 1 as rank
           from open_keys k left join lib_artists own using (clean_artist)
           join lib_artists a on split_part(a.clean_artist, ' ', 1) = split_part(k.clean_artist, ' ', 1)
           where {few}
             and a.clean_artist <> k.clean_artist"""),
        ("blocks", "select * from own_blocks union all select * from word_blocks"),
    ]


def _candidates(v2: bool) -> list[tuple[str, str]]:
    key = "clean_track, clean_artist" + (", clean_album" if v2 else "")
    return [
        ("firsts", _kept(key, "asc")),
        ("fuzzy_pairs", """select k.*, f.pos, b.rank, 'fuzzy' as match_type
           from open_keys k join blocks b using (clean_artist) join firsts f on f.clean_artist = b.lib_artist"""),
    ]


def _scored(pairs: str) -> list[tuple[str, str]]:
    """Signals and score of `pairs` (key columns, pos): string pairs are compared once each."""
    joined = f"""select p.*, l.clean_track as lt, l.clean_artist as la, l.clean_album as lal,
        case when p.album_key = '' then '' else p.album_key[2:] end as cal
      from {pairs} p join lib l using (pos)"""
    fields = {"title": ("clean_track", "lt"), "artist": ("clean_artist", "la"), "album": ("cal", "lal")}
    texts = " union ".join(f"select {a} as a, {b} as b from joined_pairs" for a, b in fields.values())
    lcs = (
        "length({0}) - bit_count(list_reduce(list_transform(string_split({1}, ''),"
        " lambda c: coalesce(m[c], 0::hugeint)),"
        " lambda v, k: ((v + (v & k)) | (v - (v & k))) & ((1::hugeint << length({0})) - 1),"
        " (1::hugeint << length({0})) - 1)) as {2}"
    )
    word_sets = f"""select a, b, {_tokens('a')} as ta, {_tokens('b')} as tb from ({texts})"""
    rests = """select a, b, ta, tb, list_intersect(ta, tb) as i,
        array_to_string(list_sort(list_filter(ta, lambda t: not list_contains(tb, t))), ' ') as x,
        array_to_string(list_sort(list_filter(tb, lambda t: not list_contains(ta, t))), ' ') as y from word_sets"""
    masks = """select s, map(list(c), list(bits)) as m from (
        select s, c, sum(1::hugeint << (i - 1))::hugeint as bits from (
          select s, unnest(string_split(s, '')) as c, unnest(range(1, length(s) + 1)) as i
          from (select a as s from rests where a <> '' union select x from rests where x <> ''))
        group by s, c) group by s"""
    full = f"""select r.a, r.b, len(ta) as na, len(tb) as nb, len(i) as ni,
        length(array_to_string(i, ' ')) as s, least(len(i), 1) as g, length(x) as lx, length(y) as ly,
        coalesce((select {lcs.format("r.a", "r.b", "n")} from masks where s = r.a and r.b <> ''), 0) as n,
        coalesce((select {lcs.format("r.x", "r.y", "n")} from masks where s = r.x and r.y <> ''), 0) as nr
      from rests r"""
    percent = "(100 - 100 * ({0})::double / ({1}))"
    r1 = percent.format("lx + ly - 2 * nr", "s + g + lx + s + g + ly")
    r2, r3 = (percent.format(f"g + {side}", f"s + s + g + {side}") for side in ("lx", "ly"))
    compared = f"""select a, b,
        (case when length(a) + length(b) = 0 then 1::double
           else (1 - (length(a) + length(b) - 2 * n)::double / (length(a) + length(b))) * 100 / 100 end
         + case when a = '' or b = '' then 0 when ni > 0 and (lx = 0 or ly = 0) then 100
             when ni > 0 then greatest({r1}, {r2}, {r3}) else {r1} end / 100) * 0.5::double as ratio,
        case when na = 0 or nb = 0 then 0::double else ni::double / greatest(na, nb) end as overlap
      from lcs"""
    signals = f"""select p.* exclude (lt, la, lal, cal), t.ratio as ratio_title, ar.ratio as ratio_artist,
        case when cal = '' or lal = '' then 0::double else al.ratio end as ratio_album,
        t.overlap as ngram_title, ar.overlap as ngram_artist, al.overlap as ngram_album
      from joined_pairs p
      join compared t on t.a = p.clean_track and t.b = p.lt
      join compared ar on ar.a = p.clean_artist and ar.b = p.la
      join compared al on al.a = p.cal and al.b = p.lal"""
    base = (
        "0.35::double * ratio_title + 0.45::double * ratio_artist"
        " + 0.1::double * ngram_title + 0.1::double * ngram_artist"
    )
    score = f"""select *, case when ratio_album > 0 or ngram_album > 0
        then {base} + 0.2::double * ((ratio_album + ngram_album) / 2) else {base} end as score from signals"""
    return [
        ("joined_pairs", joined), ("word_sets", word_sets), ("rests", rests), ("masks", masks),
        ("lcs", full), ("compared", compared), ("signals", signals), ("scored", score),
    ]


_BEST = (
    "best",
    """select * replace (case when (ratio_album > 0 or ngram_album > 0) and album_key <> '' then 'fuzzy_album' else 'fuzzy' end as match_type)
     from scored where match_type = 'fuzzy' and score > 0 and score >= 0.85
     qualify row_number() over (partition by clean_track, clean_artist, album_key order by score desc, rank, pos) = 1""",
)


def _exact_scored(v2: bool) -> str:
    forced = (
        " replace (1::double as ratio_title, 1::double as ratio_artist,"
        " case when match_type = 'exact_album' then 1::double else ratio_album end as ratio_album)"
        if v2
        else ""
    )
    return f"select *{forced} from scored where match_type <> 'fuzzy'"


def _signal_list(rounding) -> str:
    names = ("ratio_title", "ratio_artist", "ratio_album", "ngram_title", "ngram_artist", "ngram_album")
    return ", ".join(f"{rounding(n)} as {n}" for n in names)


def _round6(name: str) -> str:
    return f"round({name}, 6)"


def _exact_query(v2: bool) -> str:
    steps = [*_base(), *_LASTS, _EXACT, *_scored("exact_pairs"), ("links", _exact_scored(v2))]
    return _with(*steps, then=f"""select clean_track, clean_artist, album_key, pos, {_signal_list(_round6)}, match_type from links""")


def _cascade_steps(v2=False, **base) -> list[tuple[str, str]]:
    both = "select * from exact_pairs union all by name select * from fuzzy_pairs"
    links = f"({_exact_scored(v2)}) union all by name (select * from best)"
    best = (_BEST[0], _BEST[1].replace("score > 0 and ", "") if v2 else _BEST[1])
    linked = f"""select c.cur_id, c.curation, c.track, c.artist, c.album, l.mediaid,
        l.track as matched_track, l.artist as matched_artist, l.album as matched_album,
        {_signal_list(lambda n: _rounded("k." + n, 3))}, k.match_type
      from cur c left join links k using (clean_track, clean_artist, album_key) left join lib l on l.pos = k.pos"""
    return [
        *_base(**base), *_LASTS, _EXACT, _OPEN, *_blocks(v2), *_candidates(v2), ("all_pairs", both),
        *_scored("all_pairs"), best, ("links", links), ("linked", linked),
    ]


def _cascade(v2=False, **base) -> str:
    return _with(*_cascade_steps(v2, **base), then="select * from linked")


def _best_query() -> str:
    steps = [*_base(), _OPEN, *_blocks(False), *_candidates(False), *_scored("fuzzy_pairs"), _BEST]
    return _with(*steps, then=f"""select clean_track, clean_artist, album_key, pos, {_signal_list(_round6)}, match_type from best""")


def _blocks_query(v2: bool) -> str:
    """Artist pairs that can still reach the threshold with a perfect title and album."""
    pairs = """select b.*, '' as clean_track, '' as album_key, min(l.pos) as pos,
        max(case when length(k.album_key) > 1 then 0.2 else 0 end) as album
      from blocks b join open_keys k using (clean_artist) join lib l on l.clean_artist = b.lib_artist
      group by b.clean_artist, b.lib_artist, b.rank"""
    steps = [*_base(), _OPEN, *_blocks(v2), ("artist_pairs", pairs)]
    then = f"""select clean_artist, lib_artist, rank::bigint as rank,
        {_round6('ratio_artist')} as ratio_artist, {_round6('ngram_artist')} as ngram_artist
      from scored where rank = 0 or 0.35 + 0.1 + album + 0.45 * ratio_artist + 0.1 * ngram_artist >= 0.85"""
    return _with(*steps, *_scored("artist_pairs"), then=then)


_PAIRS = [
    *_base(),
    ("row_pairs", """select c.cur_id, c.clean_track, c.clean_artist, c.album_key, l.pos
       from (select *, unnest([cur_id, cur_id + 1]) as target from cur) c join lib l on l.pos = c.target"""),
]

# --- snapshots --------------------------------------------------------------------------------------


def _station_rows(sql: str) -> str:
    return f"""select station, coalesce(trunc(try_cast(song_count as double)), 0)::bigint as songs,
        coalesce(try_cast(total_seconds as decimal(28, 9)), 0) as seconds from ({sql})"""


def _station_sums(sql: str) -> str:
    hours = _rounded("total / 3600", 2)
    return f"""select station, songs, {hours} as hours from (select station, sum(songs)::bigint as songs,
        sum(seconds)::double as total from ({_station_rows(sql)}) group by station)"""


def _station_sums_v2(sql: str) -> str:
    row_hours = _rounded("coalesce(trunc(try_cast(replace(total_seconds, ',', '') as double)), 0) / 3600", 2)
    return f"""select station, songs, {_rounded('total', 2)} as hours from (
        select station, sum(songs)::bigint as songs, sum(hours)::double as total from (
          select trim(station) as station,
            coalesce(trunc(try_cast(replace(song_count, ',', '') as double)), 0)::bigint as songs,
            ({row_hours})::decimal(28, 9) as hours from ({sql}))
        where station <> '' group by station)"""


_DIFF = [
    ("before", _station_sums(w.STATIONS_BEFORE)),
    ("after", _station_sums(w.STATIONS_AFTER)),
    ("totals", """select station, coalesce(b.songs, 0) as songs_before, coalesce(b.hours, 0) as hours_before,
        coalesce(a.songs, 0) as songs_after, coalesce(a.hours, 0) as hours_after
      from before b full join after a using (station)"""),
    ("changes", f"""select *, format('[UPDATE] {{}}: {{}} songs, {{:.2f}} hrs → {{}} songs, {{:.2f}} hrs (+{{:.2f}} hrs)',
        station, songs_before, hours_before, songs_after, hours_after, delta_hours) as line
      from (select *, {_rounded('hours_after - hours_before', 2)} as delta_hours from totals
        where songs_before <> songs_after or hours_before <> hours_after)"""),
]

_REPORTS = [
    *_DIFF,
    ("report_changes", "select *, split_part(station, '-', 1) as report from changes"),
    ("types", "select distinct event_type from events"),
    ("titles", """select report, '*Updates:* ' || report as title
       from (select event_type as report from types union all select 'quiet ' || event_type from types)"""),
    ("report_text", """select report, row_number() over (partition by report order by section, station) as n, line from (
        select report, 0 as section, '' as station, title as line from titles
        union all select report, 1, station, line from report_changes
        union all select report, 1, '', '[info] no changes.' from titles t
          where not exists (select 1 from report_changes c where c.report = t.report))"""),
]

_PACKED = """select report, message_no, string_agg(line || chr(10), '' order by n) as message
  from packed group by report, message_no"""


def _packing() -> tuple[str, str]:
    return (
        "packed",
        """select report, n, line, 0::bigint as message_no, length(line) + 1 as fill from report_text where n = 1
         union all
         select t.report, t.n, t.line,
           p.message_no + case when p.fill + length(t.line) + 1 > 3500 then 1 else 0 end,
           case when p.fill + length(t.line) + 1 > 3500 then 0 else p.fill end + length(t.line) + 1
         from packed p join report_text t on t.report = p.report and t.n = p.n + 1""",
    )


# --- ids and links ----------------------------------------------------------------------------------

_ID_SIDES = [
    ("before", f"select distinct id from ({w.IDS_BEFORE})"),
    ("after", f"select distinct id from ({w.IDS_AFTER})"),
    ("added", "select id from after except select id from before"),
    ("removed", "select id from before except select id from after"),
]


def _links(rows: str) -> str:
    """Complete rows of a search table, with their link; missing spellings are already NULL."""
    query = "track || ' ' || artist || case when album is null then '' else ' ' || album end"
    encoded = f"replace(replace(url_encode({query}), '%20', '+'), '*', '%2A')"
    present = "coalesce(track, 'nan') not in ('', 'nan') and coalesce(artist, 'nan') not in ('', 'nan')"
    return f"select pos, track, artist, album, '{SEARCH_PREFIX}' || {encoded} || '{SEARCH_SUFFIX}' as url from ({rows}) where {present}"


_STRIPPED = "select pos, trim(track) as track, trim(artist) as artist, trim(album) as album"

SQL: dict[str, str] = {
    "clean_text": _with(*_base(), then="select cur_id, clean_track, clean_artist, clean_album from cur"),
    "clean_text_tail": _with(*_base(trim=True), then="select cur_id, clean_track, clean_artist, clean_album from cur"),
    "fold_documents": f"select doc_id, {_fold('text')} as folded from documents",
    "clean_documents": f"""select doc_id, clean, split_part(clean, ' ', 1) as first_token,
      len({_tokens('clean')})::bigint as tokens from (select doc_id, {_clean('text')} as clean from documents)""",
    "indel_ratio": _with(
        *_PAIRS, *_scored("row_pairs"),
        then="""select p.cur_id, p.pos, n::bigint as lcs, round(case when length(a) + length(b) = 0 then 1
            else (1 - (length(a) + length(b) - 2 * n)::double / (length(a) + length(b))) * 100 / 100 end, 6) as ratio
          from joined_pairs p join lcs on a = clean_track and b = lt""",
    ),
    "pair_signals": _with(
        *_PAIRS, *_scored("row_pairs"),
        then=f"select cur_id, pos, {_signal_list(_round6)}, round(score, 6) as score from scored",
    ),
    "library_last": _with(*_base(), *_LASTS, then="select clean_track, clean_artist, pos, track from last2"),
    "library_first": _with(
        *_base(), *_candidates(False)[:1], then="select clean_track, clean_artist, pos, track from firsts"
    ),
    "exact_match": _exact_query(False),
    "exact_match_v2": _exact_query(True),
    "artist_blocks": _blocks_query(False),
    "artist_blocks_v2": _blocks_query(True),
    "fuzzy_match_best": _best_query(),
    "match_cascade": _cascade(),
    "match_cascade_trim": _cascade(trim=True),
    "match_cascade_no_album": _cascade(album=False),
    "match_v2": _cascade(v2=True),
    "match_wide": _cascade(library=w.WIDE_LIBRARY, curation=w.WIDE_CURATION),
    "match_hot_word": _cascade(library=w.HOT_LIBRARY, curation=w.HOT_CURATION),
    "matched_rows": _with(
        *_cascade_steps(both=True), then="select * from linked where match_type is not null"
    ),
    "not_found_rows": _with(
        *_cascade_steps(both=True), then="select cur_id, curation, track, artist, album from linked where match_type is null"
    ),
    "match_stats": _with(
        *_cascade_steps(both=True),
        then="""select curation, count(*) as total, count(match_type) as matched, count(*) - count(match_type) as not_found,
          round(100 * count(match_type) / count(*), 6) as match_rate from linked group by curation""",
    ),
    "station_totals": _station_sums(w.STATIONS_ALL),
    "station_totals_v2": _station_sums_v2(w.STATIONS_ALL),
    # Sums of decimals that are never a tie, so decimal rounding is an independent check.
    "station_totals_large": f"""select station, sum(song_count::bigint)::bigint as songs,
      round(sum(total_hours::decimal(38, 9)), 2)::double as hours from ({w.STATIONS_LARGE}) group by station""",
    # Whole numbers below 2^64, which the cast rounds once.
    "station_totals_rough": f"""select station, sum(song_count::bigint)::bigint as songs,
      sum(split_part(total_hours, 'e', 1)::decimal(38, 0) * (10::bigint ** split_part(total_hours, 'e', 2)::int)::bigint)::decimal(38, 0)::double as hours
      from ({w.STATIONS_ROUGH}) group by station""",
    "station_totals_v2_mixed": f"""select station, sum(songs)::bigint as songs, round(sum(hours), 2)::double as hours from (
      select trim(station) as station, replace(song_count, ',', '')::bigint as songs,
        case when total_hours <> '' then {_rounded("try_cast(total_hours as double)", 2)}
          else {_rounded("coalesce(trunc(try_cast(total_seconds as double)), 0) / 3600", 2)} end::decimal(28, 9) as hours
      from ({w.STATIONS_MIXED})) where station <> '' group by station""",
    "station_diff": _with(*_DIFF, then="select * from changes"),
    "station_diff_of_totals": _with(*_DIFF, then="select * from changes"),
    "station_report_lines": _with(*_DIFF, then="select line from changes order by station"),
    "station_report_unchanged": f"""select '[info] no changes.' as line
      where (select count(*) from ({w.STATIONS_ALL})) >= 0""",
    "report_messages": _with(*_REPORTS, _packing(), then=_PACKED, recursive=True),
    "report_messages_whole": _with(
        *_REPORTS,
        then="select report, 0::bigint as message_no, string_agg(line, chr(10) order by n) as message from report_text group by report",
    ),
    "report_pieces": _with(
        *_REPORTS,
        then="""select report, (n - 1) // 1000 as piece, string_agg(line, chr(10) order by n) as text
          from report_text group by report, piece""",
    ),
    "id_changes": _with(
        *_ID_SIDES, then="select id, 'added' as change from added union all select id, 'removed' from removed"
    ),
    "id_diff_stats": _with(
        *_ID_SIDES,
        then="""select b as before, a as after, added, removed, added - removed as net_change from (select
          (select count(*) from before) as b, (select count(*) from after) as a,
          (select count(*) from added) as added, (select count(*) from removed) as removed)""",
    ),
    "search_links": _links(f"{_STRIPPED} from ({w.TRACKS_TO_SEARCH})"),
    "search_links_first_100": _links(f"{_STRIPPED} from ({w.TRACKS_TO_SEARCH}) order by pos limit 100"),
    "search_links_first_half": _links(f"""select pos * 12 + copy as pos, trim(track) as track, trim(artist) as artist, trim(album) as album
      from ({w.TRACKS_TO_SEARCH}), range(12) as copies(copy) order by 1 limit 6 * (select count(*) from part)"""),
    "search_links_v1": f"""select pos, coalesce(track, '') as track, coalesce(artist, '') as artist,
      '{SEARCH_PREFIX}' || coalesce(track, '') || '+' || coalesce(artist, '') as url from ({w.TRACKS_TO_SEARCH})""",
    "matched_from_files": _with(
        *_cascade_steps(),
        then=f"""select track, artist, album, matched_track, matched_artist, matched_album, mediaid, match_type,
          {_signal_list(lambda n: f"{n}::varchar")} from linked where match_type is not null""",
    ),
    "not_found_from_files": _with(*_cascade_steps(), then="select track, artist, album from linked where match_type is null"),
    "report_from_file": _with(*_DIFF, then="select line from changes"),
    "search_links_from_files": f"""select pos::varchar as pos, track, artist, coalesce(album, '') as album, url
      from ({_links(f"{_STRIPPED} from ({w.TRACKS_TO_SEARCH})")})""",
    "documents_by_split": """select doc_id, coalesce(lang, '') as lang, md5(coalesce(text, '')) as text_md5,
      row_number() over (partition by coalesce(lang, '') order by doc_id) - 1 as place from documents""",
}
