import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import sharding

from . import cases


def chances(total, good, draws):
    low, high = max(0, draws + good - total), min(draws, good)
    whole = math.comb(total, draws)
    return {k: math.comb(good, k) * math.comb(total - good, draws - k) / whole for k in range(low, high + 1)}


@pytest.mark.parametrize(("total", "good", "draws"), [(10, 4, 5), (7, 7, 3), (7, 0, 3), (60, 30, 20), (1000, 2, 400), (5000, 2500, 2500)])
def test_hypergeometric_draws(spark, total, good, draws):
    """Each quantile that the inversion gives is that of the exact law."""
    expected, points = chances(total, good, draws), 500
    drawn = spark.range(points).select(
        F.expr(sharding.hypergeometric(f"{total}L", f"{good}L", f"{draws}L", f"((id + 0.5D) / {points})")).alias("k")
    )
    counts = Counter(r.k for r in drawn.collect())
    assert set(counts) <= set(expected)
    below = reached = 0.0
    for k, chance in expected.items():
        below, reached = below + chance * points, reached + counts[k]
        assert abs(below - reached) <= 0.5 + 1e-6


def test_large_hypergeometric_is_near_its_mean(spark):
    total, good, draws = 40_000_000_000, 1_700_000_000, 20_000_000_000
    mean, deviation = draws * good / total, math.sqrt(draws * good / total * (1 - good / total) * (1 - draws / total))
    drawn = spark.range(40).select(
        F.expr(sharding.hypergeometric(f"{total}L", f"{good}L", f"{draws}L", sharding.uniform(5, "id"))).alias("k")
    )
    away = [(r.k - mean) / deviation for r in drawn.collect()]
    assert max(map(abs, away)) < 5 and 0.4 < sum(x * x for x in away) / 40 < 2


def test_matrix_margins(spark):
    counts = [5, 0, 17, 1, 0, 40, 2, 8, 3]
    sizes = [26, 25, 25]
    frame = spark.createDataFrame(list(enumerate(counts)), "part long, n long")
    found = {r.part: r.owed for r in sharding.communication_matrix(frame, len(counts), F.lit(sizes).cast("array<long>"), 1).collect()}
    assert [sum(found[k]) for k in range(len(counts))] == counts
    assert [sum(column) for column in zip(*found.values(), strict=True)] == sizes
    assert min(min(row) for row in found.values()) >= 0


def test_share_law(spark):
    """Over many nodes the left half's share of two shards follows the exact law."""
    nodes = spark.range(4000).selectExpr(
        "id as first", "array(3L, 4L) as counts", "array(4L, 3L) as owed", "7L as n_all", "3L as n_left"
    )
    shares = [r.share for r in nodes.select(F.expr(sharding._left_share(9)).alias("share")).collect()]
    assert all(sum(s) == 3 for s in shares)
    counts, expected = Counter(s[0] for s in shares), chances(7, 4, 3)
    assert sum((counts[k] - 4000 * p) ** 2 / (4000 * p) for k, p in expected.items()) < 16.3  # 0.1 % of three degrees


@pytest.mark.parametrize("clashing", [False, True])
def test_document_shards(spark, clashing):
    expected = []
    for key, text, *_ in cases.rows():
        raw = (text or "").encode()
        expected.append((key, len(raw) + 8, zlib.crc32(raw), "rows", None))
    frame = cases.documents(spark, clashing=clashing)
    found = sharding.document_shards(frame, 4, seed=3)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = found.collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows), key=repr) == sorted(expected, key=repr)
    check_places(rows, 4)


def check_places(rows, shards):
    counts = Counter(r.shard for r in rows)
    full = [counts[k] for k in range(shards)]
    assert full == sorted(full, reverse=True) and full[0] - full[-1] <= 1 and sum(full) == len(rows)
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))


@pytest.mark.parametrize(("rows", "parts", "shards"), [(5000, 13, 24), (10, 9, 24), (1, 3, 2), (700, 1, 3), (3000, 200, 5)])
def test_exact_sizes(spark, rows, parts, shards):
    found = sharding.shuffle(spark.range(rows).repartition(parts), shards, seed=rows).collect()
    assert sorted(r.id for r in found) == list(range(rows))
    check_places(found, shards)


def test_uniform(spark):
    """Partition, and order within it, say nothing of shard and slot."""
    frame = spark.range(0, 24_000, 1, 6).withColumn("from", F.spark_partition_id())
    found = sharding.shuffle(frame, 8, seed=11).collect()
    table = Counter((r["from"], r.shard) for r in found)
    assert sum((table[p, s] - 500) ** 2 / 500 for p in range(6) for s in range(8)) < 66.6  # 0.1 % of 35 degrees
    halves = Counter((r.id % 4000 < 2000, r.slot < 1500) for r in found)
    assert abs(halves[True, True] - 6000) < 5 * math.sqrt(24_000 / 16)
    again = sharding.shuffle(frame, 8, seed=12).collect()
    moved = {r.id: (r.shard, r.slot) for r in again}
    assert sum(moved[r.id] == (r.shard, r.slot) for r in found) < 12
    slots = {r.id: r.slot for r in found if r.shard == 0}
    pairs = [(slots[k], slots[k + 1]) for k in slots if k + 1 in slots]
    assert abs(sum(a < b for a, b in pairs) / len(pairs) - 0.5) < 0.13


def test_same_seed_same_result(spark):
    frame = spark.range(0, 3000, 1, 5)
    first, second = ({tuple(r) for r in sharding.shuffle(frame, 7, seed=2).collect()} for _ in range(2))
    assert first == second


def test_names_empty_tables_and_files(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", "b", "c")], "id long, shard string, slot string, part string")
    assert sharding.shuffle(frame, 2).collect()[0].asDict() == {"id": 1, "shard": "a", "slot": "b", "part": "c", "shard_": 0, "slot_": 0}
    assert sharding.document_shards(cases.documents(spark).limit(0), 24).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle(frame, 0)
    sharding.write_shards(spark.range(100).repartition(3), 4, f"{tmp_path}/shards", seed=1)
    back = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert sorted(r.id for r in back) == list(range(100))
    check_places(back, 4)


def test_native(spark, capsys):
    sharding.document_shards(cases.documents(spark), 24).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
