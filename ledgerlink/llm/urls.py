"""URL rules in a trie over reversed host labels and path segments.

A rule is an action (allow or block), a host and a path.  It fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's.  Of the rules that fit, the one with the
longest host and path together wins, then the one with the longer host, then block.  A URL that no
rule fits gets the default verdict.

Host: what follows the first "://" up to "/", "?", "#" or the end, A-Z lower-cased.  Path: from there
up to "?", "#" or the end.  A null URL, or one without "://", has an empty host and path.  Every row
gives one row.
"""

from __future__ import annotations

import pickle
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Bytes of a broadcast trie at most; larger rule sets are joined.
TRIE_BYTES = 64 << 20

# Keys of a node, beside its children's labels: under PATHS hangs the trie of path segments, and
# under ENDS the rules whose path ends within the next segment, as {rest of the path: rule}.
_PATHS, _ENDS = 0, 1


def _better(new: Rule, old: Rule | None) -> bool:
    rank = lambda r: (len(r.name), len(r.host), r.action == "block")
    return old is None or rank(new) > rank(old)


def build_trie(rules: list[Rule]) -> dict:
    root: dict = {}
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = node.setdefault(label, {})
        node = node.setdefault(_PATHS, {})
        *whole, rest = rule.path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(_ENDS, {})
        if _better(rule, ends.get(rest)):
            ends[rest] = rule
    return root


def longest_match(trie: dict, host: str, path: str) -> Rule | None:
    best = None
    segments = path.split("/")
    node = trie
    for label in [None, *reversed(host.split("."))]:
        node = node if label is None else node.get(label)
        if node is None:
            break
        under = node.get(_PATHS)
        for depth, segment in enumerate(segments):
            if under is None:
                break
            for rest, rule in under.get(_ENDS, {}).items():
                if segment.startswith(rest) and _better(rule, best):
                    best = rule
            under = under.get(segment) if depth < len(segments) - 1 else None
    return best


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    cut = rest[:end]
    slash = cut.find("/")
    host, path = (cut, "") if slash < 0 else (cut[:slash], cut[slash:])
    return host.translate(_LOWER), path


_LOWER = {k: k + 32 for k in range(ord("A"), ord("Z") + 1)}


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict of each row.

    The trie is broadcast if it takes at most TRIE_BYTES; a larger rule set is joined by host and path.
    """
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(pages[key].alias("key"), pages[url].cast("string").alias("url"))
    trie = pickle.dumps(build_trie(rules))
    context = pages.sparkSession.sparkContext
    shared = context.broadcast(trie if len(trie) <= TRIE_BYTES else b"")
    joined = len(trie) > TRIE_BYTES

    def run(batches):
        known = None if joined else pickle.loads(shared.value)
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column("url").to_pylist()]
            hits = [None if joined else longest_match(known, *p) for p in parts]
            columns = [
                batch.column("key"),
                pa.array([p[0] for p in parts], pa.string()),
                pa.array([p[1] for p in parts], pa.string()),
                pa.array([h and h.name for h in hits], pa.string()),
                pa.array([h.action if h else default for h in hits], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "host", "path", "rule", "verdict"])

    judged = arrow_map(rows, run, f"{key} {kind}, host string, path string, rule string, verdict string")
    return judge_by_join(judged.drop("rule", "verdict"), rules, default, key) if joined else judged


def judge_by_join(parts: DataFrame, rules: list[Rule], default: str, key: str) -> DataFrame:
    """The same for rows (key, host, path): each distinct host and path meets the rules of its domains."""
    spark = parts.sparkSession
    table = spark.createDataFrame(rules, "action string, rule_host string, rule_path string")
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    wanted = parts.select("host", "path").distinct()
    met = wanted.withColumn("rule_host", F.explode(F.array_append(domains, F.lit("")))).join(table, "rule_host")
    met = met.filter(F.startswith("path", "rule_path"))
    name = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(name), F.length("rule_host"), F.col("action") == "block")
    best = met.groupBy("host", "path").agg(F.max_by(F.struct(name.alias("rule"), "action"), rank).alias("best"))
    judged = parts.join(best, ["host", "path"], "left")
    return judged.select(key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
