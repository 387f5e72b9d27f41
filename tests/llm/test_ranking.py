import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlink.llm import ranking
from ledgerlink.llm.common import table

from . import cases

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(documents, items, best=10):
    """The ranking by its formula, document by document."""
    counts = [(key, Counter(t), len(t)) for key, text in documents if (t := terms(text))]
    size, length = len(counts), sum(n for *_, n in counts)
    holders = Counter(t for _, held, _ in counts for t in held)
    rows = []
    for item, text in items:
        found = []
        for key, held, n in counts:
            m = 100 - 75 + (75 * n * size) // length
            score = 0
            for term in terms(text):
                if tf := held[term]:
                    score += math.floor(1000 * math.log((2 * size + 2) / (2 * holders[term] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        rows += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:best], 1)]
    return rows


def test_terms():
    for text in cases.TEXTS + ["a_b-C9\x7fÄÖ Ünïcode日本.x", "[A]{z}`@/:", "\x00a\x01"]:
        assert [t.decode() for t in ranking.terms((text or "").encode())] == terms(text)


ITEMS = [
    (1, "one two three, THREE four"), (2, None), (3, ""), (4, "!!!"), (5, "日本語 word7 word8 word9 word7"), (6, "one two three, THREE four"),
    (None, "five"), (7, "nowhere"), (8, "tail é œ"), (8, "x " * 50 + "phone call"), (9, " ".join(f"word{k}" for k in range(0, 700, 3))),
]


def items(spark):
    return spark.createDataFrame([(k, t, "z", 1) for k, t in ITEMS], "item_id long, text string, key string, score int").repartition(2)


@pytest.mark.parametrize(("block_chars", "clashing"), [(1 << 20, True), (40, False)])
def test_rank(spark, block_chars, clashing):
    extra = cases.prose(4, 60) + [f"word{k} one five" for k in range(30)] + ["tail", "tail", "tail tail"]
    expected = plain([(r[0], r[1]) for r in cases.rows(extra)], ITEMS)
    assert len({e[0] for e in expected}) > 5
    result = ranking.rank(cases.documents(spark, extra, clashing=clashing), items(spark), block_chars=block_chars)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    cases.same(result, expected)


def test_heaps():
    """Documents that go through in one or in many runs."""
    heaps, whole = ranking.Heaps(2, 3), ranking.Heaps(2, 3)
    scores = np.random.default_rng(1).integers(0, 6, (200, 2))
    whole.add(list(range(200)), scores)
    for k in range(0, 200, 7):
        heaps.add(list(range(200))[k : k + 7], scores[k : k + 7])
    for item in range(2):
        best = sorted((-int(s), k) for k, s in enumerate(scores[:, item]) if s > 0)[:3]
        for made in (heaps, whole):
            assert sorted((-s, key.key) for s, key in made.heaps[item]) == best
    assert ranking._runs(np.array([5, 9, 1, 1]), 2, 6) == [(0, 1), (1, 2), (2, 4)]


def test_text_keys_and_ties(spark):
    documents = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "x"), ("d", "z")], "doc_id string, text string")
    asked = spark.createDataFrame([(1, "x")], "item_id int, text string")
    assert [tuple(r)[1:3] for r in ranking.rank(documents, asked, best=3).orderBy("rank").collect()] == [(1, "c"), (2, "a"), (3, "b")]


def test_empty_tables(spark):
    none, some = cases.documents(spark).limit(0), items(spark)
    assert ranking.rank(none, some).count() == 0
    assert ranking.rank(cases.documents(spark), some.limit(0)).count() == 0
    assert ranking.rank(cases.documents(spark), some.filter("item_id = 4")).count() == 0


def test_query_tables(spark):
    """The whole small tables, against the formula."""
    folder = "/root/testdata/sf0.001"
    documents, asked = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    expected = plain(*([tuple(r) for r in t.select(t.columns[0], "text").collect()] for t in (documents, asked)))
    cases.same(ranking.rank(documents, asked), expected)
