import hashlib
import base64
import random

import duckdb
import pytest

from ledgerlink.llm import queries, urls, warc
from ledgerlink.llm.sql import SQL

from . import cases

URLS = [
    None, "", "no mark", "http://", "HTTP://A.Example.NET/en/x?y=/fr/", "http://example.net/en", "https://example.net/en/",
    "http://net", "http://net/", "http://notnet/", "http://a.org/fr/1#x", "http://a.org?/fr/", "http://x.example.com/de/a/b",
    "http://example.com/deutsch", "http://a.b.example.com/de/", "http://u@ÄB.Org/fr/", "x://y://z.net/a", "//a.net/", "http://..net/",
]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :].split("?")[0].split("#")[0]
        host, mark, tail = rest.partition("/")
        path = mark + tail
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.name), len(r.host), r.action == "block"), default=None)
    return host, path, best and best.name, best.action if best else "allow"


def pages(spark, found):
    return spark.createDataFrame([(k, u, "z") for k, u in enumerate(found)] + [(None, URLS[4], "z")] * 2, "page_id bigint, url string, key string")


def expected(found, rules):
    return [(k, *plain(u, rules)) for k, u in enumerate(found)] + [(None, *plain(URLS[4], rules))] * 2


def test_contract_rules(spark):
    frame = pages(spark, URLS)
    cases.same(urls.judge(frame, queries.URL_RULES), expected(URLS, queries.URL_RULES))
    database = duckdb.connect()
    database.register("pages", frame.toPandas())
    check = database.sql(SQL["op5_urls"]).select("page_id, host, path, rule, verdict").fetchall()
    assert sorted(check, key=repr)[: len(URLS)] == sorted(expected(URLS, queries.URL_RULES)[: len(URLS)], key=repr)


@pytest.mark.parametrize("limit", [urls.TRIE_BYTES, 0])
def test_many_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "TRIE_BYTES", limit)
    chance = random.Random(5)
    host = lambda: ".".join(chance.choices("ab", k=chance.randint(1, 3)))
    path = lambda: "".join(chance.choices(["/", "/c", "/d", "e"], k=chance.randint(0, 3)))
    rules = [urls.Rule(chance.choice(["allow", "block"]), chance.choice(["", host(), host()]), path()) for _ in range(60)]
    found = [f"http://{host()}{p if not p or p[0] == '/' else '/' + p}" for p in (path() for _ in range(200))]
    cases.same(urls.judge(pages(spark, found), rules), expected(found, rules))


def archive(spark):
    long = "é" * 50_000
    html = [None, "", "<p>a</p>", "<p>b\r\n\r\nWARC/1.1\r\n</p>", "<p>a</p>", long, long, "tail\r\n\r\n", "\r\n\r\n", "0\r\n\r\n"]
    found = [(k, f"http://x/{k}\n", h, "z") for k, h in enumerate(html)]
    found += [(None, None, "<p>a</p>", "z"), (None, None, "alone", "z"), (None, None, "alone", "z"), found[2], found[6]]
    return found, spark.createDataFrame(found, "page_id bigint, url string, html string, sum string").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_warc(spark, least):
    found, frame = archive(spark)
    want = []
    for key, _, html, _ in found:
        payload = (html or "").encode()
        same = [k for k, _, h, _ in found if (h or "") == (html or "") and k is not None]
        first = min(same, default=None)
        revisit = len(payload) >= least and first is not None and key != first
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((key, len(payload), sha, "revisit" if revisit else "response", first if revisit else None, None))
    cases.same(warc.round_trip(frame, min_bytes=least, chunk_bytes=100, segment_bytes=700), want)


def test_warc_fields(spark, tmp_path):
    found, frame = archive(spark)
    warc.write(frame, str(tmp_path / "warc"), segment_bytes=700, date="2020-02-03T04:05:06Z")
    every = [f for path in (tmp_path / "warc").glob("part-*") for f, _ in warc.records(path.read_bytes())]
    names = [f["warc-record-id"] for f in every]
    assert len(set(names)) == len(names) and {f["warc-date"] for f in every} == {"2020-02-03T04:05:06Z"}
    infos = {f["warc-record-id"] for f in every if f["warc-type"] == "warcinfo"}
    assert {f["warc-warcinfo-id"] for f in every if f["warc-type"] != "warcinfo"} == infos
    responses = {f["warc-record-id"]: f for f in every if f["warc-type"] == "response"}
    revisits = [f for f in every if f["warc-type"] == "revisit"]
    assert revisits
    for f in revisits:
        first = f["x-refers-to-page-id"]
        alike = [r for r in found if str(r[0]) == first]
        assert ("warc-refers-to" in f) == (len(alike) == 1)
        if "warc-refers-to" in f:
            response = responses[f["warc-refers-to"]]
            assert response["x-page-id"] == first and response["warc-payload-digest"] == f["warc-payload-digest"]


def test_warc_faults():
    parts = [next(warc.records(r + b"\r\n\r\n")) for r in warc.page_records(7, "u", b"x" * 900, None, 100, 300)]
    assert warc.restored(parts[::-1])[1] == 900
    assert warc.restored(parts[:-1])[5] == "segments are missing"
    assert warc.restored(parts[:1] + parts[2:])[5] == "segments are missing"
    fields, block = next(warc.records(next(warc.page_records(7, "u", b"abc", None, 2, 3000)) + b"\r\n\r\n"))
    assert warc.restored([(fields, block.replace(b"ab", b"xy"))])[5] == "the digest differs"
    assert warc.restored([(fields, block.replace(b"2\r\nab", b"3\r\nab"))])[5]


def test_empty(spark):
    assert urls.judge(pages(spark, []).limit(0), queries.URL_RULES).count() == 0
    assert warc.round_trip(archive(spark)[1].limit(0)).count() == 0
