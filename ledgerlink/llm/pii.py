"""Personal data, and the terms that give it away.

Base spans are found by pattern: e-mail addresses, IP addresses, card numbers and phone numbers.  Each
distinct value is a protected entity.  The terms of a document are its words outside base spans, and they
meet every entity of the document, however far apart.  Over all documents, N in number, with c documents
where term and entity meet, and docs(term) that hold the word at all, the term's disclosure is

    log(N c / (docs(entity) docs(term))) / log(N / docs(entity)),

the share of the entity's information that the term carries: 1 says that the term implies the entity.
From `SUPPORT` meetings and a disclosure of `THRESHOLD` on, all the term's occurrences outside base spans,
in whatever document, are generalised to the prefix of the word, if the prefix itself stays below the
threshold for each entity that the term discloses, and else removed.

Every row gives one row.  A null text counts as empty.  Copies count as documents.  Rows alike in
key and text get the same spans.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, fresh, slices, stored, texts

SUPPORT, THRESHOLD = 3, 0.8
PREFIX, PREFIX_FROM = 3, 5
#: Places of the fixed-size filters that say which words or entities of a text may be wanted.
FILTER_PLACES = 1 << 23
#: So many different things a task counts before it sends the counts.
COUNTED = 100_000

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run's first digit is where a leftmost match in it starts, so the others need no try.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str):
    """Matches of local part and domain; the local part is read backwards from each @, in linear time."""
    last = reach = 0
    for match in _DOMAIN.finditer(text):
        at = match.start()
        reach = max(last, text.rfind("@", reach, at) + 1, reach)
        local = text[reach:at]
        size = len(local) - len(local.rstrip(_LOCAL))
        reach = at + 1
        if size:
            last = match.end()
            reach = max(reach, last)
            yield at - size, last


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_address(found: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found.split("."))


def _is_card(found: str) -> bool:
    digits = _digits(found)
    return 13 <= len(digits) <= 19 and _luhn(digits)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and then start."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if _is_address(m[0])]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else f"{kind}:{_digits(value)}"


def general(term: str) -> str | None:
    return f"{term[:PREFIX]}*" if len(term) >= PREFIX_FROM else None


def term_places(text: str, spans: list[tuple[str, int, int]], wanted=lambda word: True):
    """(term, start, end) of the words that `wanted` has, lower-cased, and that no base span touches."""
    ends: list[int] = []  # of the spans, overlapping ones joined
    starts: list[int] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    for match in _WORD.finditer(text):
        term = match[0].lower()
        if wanted(term):
            start, end = match.span()
            after = bisect_right(ends, start)  # the first that ends behind the word's start
            if after == len(ends) or starts[after] >= end:
                yield term, start, end


def listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _key(documents: DataFrame, key: str, text: str) -> DataFrame:
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    return rows.withColumn("sum", F.xxhash64("text"))


def base(rows: DataFrame) -> DataFrame:
    """key, sum, counts, base_sha256, base spans and the entities of each row (key, text, sum)."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, "text"):
            found = [base_spans(text) for text in texts(batch)]
            counts = [Counter(k for k, _, _ in spans) for spans in found]
            names = [listed(spans) for spans in found]
            columns = [
                batch.column("key"), batch.column("sum"), *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS),
                pa.array([hashlib.sha256(n.encode()).hexdigest() for n in names]), pa.array(names),
                pa.array([sorted({entity(k, t[s:e]) for k, s, e in f}) for t, f in zip(texts(batch), found, strict=True)], pa.list_(pa.string())),
            ]
            names = ["key", "sum", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "entities"]
            yield pa.RecordBatch.from_arrays(columns, names)

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    schema = f"key {kind}, sum bigint, {counts}, base_sha256 string, base string, entities array<string>"
    return arrow_map(rows, run, schema)


def _filter(names: DataFrame, column: str):
    """A broadcast filter of the values: a bit for each place of a hashed table, FILTER_PLACES in all."""
    places = names.select(F.pmod(F.crc32(F.encode(column, "UTF-8")), F.lit(FILTER_PLACES)).cast("int").alias("place")).distinct()
    wanted = np.zeros(FILTER_PLACES, bool)
    wanted[[r[0] for r in places.collect()]] = True
    return names.sparkSession.sparkContext.broadcast(np.packbits(wanted).tobytes())


def _marks(shared):
    """Whether a filter may have a value."""
    marks = shared.value

    def known(value: str) -> bool:
        place = zlib.crc32(value.encode()) % FILTER_PLACES
        return bool(marks[place >> 3] >> (7 - (place & 7)) & 1)

    return known


def pair_counts(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """entity, term, both: in how many rows (text) each of `entities` meets each term, prefixes as `abc*`.

    Only rows that may hold one of `entities` are taken apart.  Tasks send sums; entities that share a
    place of the filter by chance come too.  A null entity stands for any: in how many of the rows taken
    apart the term is.
    """
    shared = _filter(entities, "entity")

    def run(batches):
        known = functools.lru_cache(maxsize=200_000)(_marks(shared))
        counts: Counter[tuple[str | None, str]] = Counter()
        for batch in slices(batches, "text"):
            for text in texts(batch):
                spans = base_spans(text)
                own = {e for e in (entity(k, text[s:e]) for k, s, e in spans) if known(e)}
                if not own:
                    continue
                terms = {t for t, _, _ in term_places(text, spans)}
                terms |= {g for g in map(general, terms) if g}
                for name in (None, *own):
                    counts.update(zip(repeat(name), terms))
                    if len(counts) > COUNTED:
                        yield _counted_pairs(counts)
                        counts = Counter()
        yield _counted_pairs(counts)

    sums = arrow_map(rows.select("text"), run, "entity string, term string, both bigint")
    return sums.groupBy("entity", "term").agg(F.sum("both").alias("both"))


def _counted_pairs(counts: Counter[tuple[str | None, str]]) -> pa.RecordBatch:
    columns = [pa.array([p[k] for p in counts], pa.string()) for k in range(2)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["entity", "term", "both"])


def document_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """term, docs: in how many rows (text) each of `terms` occurs, prefixes as `abc*`.

    A filter tells a task which words to count; tasks send sums, never words by document.  Words that
    share a place of it by chance are counted in vain.
    """
    shared = _filter(terms, "term")

    def run(batches):
        known = _marks(shared)

        @functools.lru_cache(maxsize=200_000)
        def forms(word: str) -> tuple[str, ...]:
            word = word.lower()  # each by itself: lower-casing may add characters that end a word
            both = (word, general(word)) if len(word) >= PREFIX_FROM else (word,)
            return tuple(f for f in both if known(f))

        counts: Counter[str] = Counter()
        for batch in slices(batches, "text"):
            for text in texts(batch):
                counts.update({f for w in set(_WORD.findall(text)) for f in forms(w)})
            if len(counts) > COUNTED:
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    sums = arrow_map(rows.select("text"), run, "term string, docs bigint")
    return sums.groupBy("term").agg(F.sum("docs").alias("docs"))


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "docs"])


def disclosing(found: DataFrame, rows: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """entity, term, disclosure, action of the pairs beyond the threshold; `found` as `base` gives it."""
    total = found.count()
    entities = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("entity_docs"))
    # An entity of fewer documents than `support` meets no term that often; one of all documents says nothing.
    entities = stored(entities.filter((F.col("entity_docs") >= support) & (F.col("entity_docs") < total)), "pii-entities")
    pairs = stored(pair_counts(rows, entities).filter((F.col("both") >= support) | F.col("entity").isNull()), "pii-pairs")
    left = stored(_possible(pairs, entities, total, threshold), "pii-possible")
    terms = document_counts(rows, left.select("term"))
    scored = left.join(terms, "term").withColumn(
        "disclosure",
        F.log(total * F.col("both") / (F.col("entity_docs") * F.col("docs"))) / F.log(total / F.col("entity_docs")),
    )
    scored = stored(scored, "pii-scores")
    over = scored.filter(F.col("disclosure") >= threshold).filter("not endswith(term, '*')")
    prefixes = scored.select("entity", F.col("term").alias("prefix"), F.col("disclosure").alias("of_prefix"))
    judged = over.withColumn("prefix", _prefix(F.col("term"))).join(prefixes, ["entity", "prefix"], "left")
    # A prefix is met at least where the term is; one that is not scored is too common to reach the threshold.
    below = F.col("prefix").isNotNull() & (F.coalesce("of_prefix", F.lit(float("-inf"))) < threshold)
    return judged.select("entity", "term", "disclosure", F.when(below, "generalised").otherwise("removed").alias("action"))


def _possible(pairs: DataFrame, entities: DataFrame, total: int, threshold: float) -> DataFrame:
    """The pairs (with entity_docs) that may reach the threshold, of prefixes only those of such terms.

    A disclosure of t needs docs(term) <= both * (N / docs(entity)) ** (1 - t), and the rows with any
    entity that hold the term are a lower limit of docs(term).  So common words go before they are
    counted in all rows.
    """
    least = pairs.filter("entity is null").select("term", F.col("both").alias("least"))
    most = F.col("both") * F.pow(total / F.col("entity_docs"), F.lit(1 - threshold)) * (1 + 1e-9)
    met = pairs.join(entities, "entity").join(least, "term").filter(F.col("least") <= most).drop("least")
    words = met.filter("not endswith(term, '*')")
    wanted = words.select("entity", _prefix(F.col("term")).alias("term")).dropna().distinct()
    return words.unionByName(met.filter("endswith(term, '*')").join(wanted, ["entity", "term"], "left_semi"))


def _prefix(term):
    return F.when(F.length(term) >= PREFIX_FROM, F.concat(F.substring(term, 1, PREFIX), F.lit("*")))


def find(documents: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms, term_spans of each row.

    term_spans: array of (start, end, action), sorted; `spans` lists them after the base ones as kind `term`.
    """
    rows = _key(documents, key, text)
    return _found(rows, **limits).withColumnRenamed("key", key).drop("sum")


def occurrences(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """key, sum, term, places (start, end) of each row's words that may be among `terms`, outside base spans."""
    shared = _filter(terms, "term")
    kind = rows.schema["key"].dataType.simpleString()
    place = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        known = _marks(shared)
        wanted = functools.lru_cache(maxsize=200_000)(lambda word: known(word.lower()))
        for batch in slices(batches, "text"):
            made: list[tuple[int, str, list[dict]]] = []
            for row, text in enumerate(texts(batch)):
                if any(map(wanted, set(_WORD.findall(text)))):
                    met: dict[str, list[dict]] = {}
                    for term, start, end in term_places(text, base_spans(text), wanted):
                        met.setdefault(term, []).append({"start": start, "end": end})
                    made += [(row, term, own) for term, own in met.items()]
            own = pa.array([m[0] for m in made], pa.int64())
            columns = [batch.column("key").take(own), batch.column("sum").take(own), pa.array([m[1] for m in made], pa.string())]
            columns.append(pa.array([m[2] for m in made], pa.list_(place)))
            yield pa.RecordBatch.from_arrays(columns, ["key", "sum", "term", "places"])

    return arrow_map(rows, run, f"key {kind}, sum bigint, term string, places array<struct<start:bigint,end:bigint>>")


def _found(rows: DataFrame, **limits) -> DataFrame:
    found = stored(base(rows), "pii-base")
    pairs = disclosing(found, rows, **limits)
    # A term may disclose several entities; removing it outweighs generalising it.
    terms = stored(pairs.groupBy("term").agg(F.max("action").alias("action")), "pii-disclosing")
    hits = occurrences(rows, terms).join(terms, "term")
    own = F.transform("places", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.col("action").alias("action")))
    # Rows alike in key and text are reduced to one set of places before the shuffle.
    spans = hits.groupBy(F.col("key").alias("k"), F.col("sum").alias("s")).agg(
        F.sort_array(F.flatten(F.collect_set(own))).alias("term_spans")
    )
    both = F.col("key").eqNullSafe(F.col("k")) & F.col("sum").eqNullSafe(F.col("s"))
    joined = found.drop("entities").join(spans, both, "left")
    empty = F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")
    joined = joined.withColumn("term_spans", F.coalesce("term_spans", empty))
    names = F.transform("term_spans", lambda t: F.concat_ws(":", F.lit("term"), t["start"].cast("string"), t["end"].cast("string")))
    spans = F.array_join(F.concat(F.filter(F.array("base"), lambda b: b != ""), names), ",")
    return joined.select(
        "key", "sum", *(f"n_{k}" for k in KINDS), "base_sha256", spans.alias("spans"),
        F.size("term_spans").cast("bigint").alias("n_terms"), "term_spans",
    )


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each base span as its kind, each removed term as [TERM] and each generalised one as its prefix.

    Overlapping spans are joined to one and named after the first.
    """
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            at = max(at, end)
            continue
        name = {"removed": "[TERM]", "generalised": f"{text[start : start + PREFIX]}*"}.get(kind, f"[{kind.upper()}]")
        parts += [text[at:start], name]
        at = end
    return "".join([*parts, text[at:]])


def sanitise(documents: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The documents with sanitised texts, all columns and rows kept; a null text stays null."""
    names = documents.columns
    own_key, own_sum, own_terms, row_sum = (fresh(documents, n) for n in ("own_key", "own_sum", "own_terms", "row_sum"))
    hits = _found(_key(documents, key, text), **limits).filter("n_terms > 0")
    hits = stored(hits.select(F.col("key").alias(own_key), F.col("sum").alias(own_sum), F.col("term_spans").alias(own_terms)).distinct(), "pii-terms")
    rows = documents.withColumn(row_sum, F.xxhash64(documents[text].cast("string")))
    both = F.col(key).eqNullSafe(F.col(own_key)) & F.col(row_sum).eqNullSafe(F.col(own_sum))
    rows = rows.join(hits, both, "left").select(*names, own_terms)
    place = names.index(text)

    def run(batches):
        for batch in slices(batches, text):
            clean = []
            for value, terms in zip(batch.column(text).to_pylist(), batch.column(own_terms).to_pylist(), strict=True):
                spans = base_spans(value or "") + [(t["action"], t["start"], t["end"]) for t in terms or []]
                clean.append(value if value is None else redact(value, spans))
            yield batch.drop_columns([own_terms]).set_column(place, text, pa.array(clean, pa.string()))

    return arrow_map(rows, run, documents.schema)
