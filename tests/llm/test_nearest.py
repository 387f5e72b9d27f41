import numpy as np
import pytest

from ledgerlink.llm import ann, queries


def brute(ids, vectors, k=20):
    made = {}
    for q, own in zip(ids, vectors, strict=True):
        if q % 20 == 0:
            score = (vectors * own).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
            made[int(q)] = [(int(ids[j]), float(score[j])) for j in order]
    return made


def test_recall_and_exact_scores(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = queries.op3_nearest(spark, "/root/testdata/sf0.1").collect()
    rows = frame.toPandas()
    want = brute(rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(np.float64))
    got = {q: [] for q in want}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert all(len(g) == 20 for g in got.values())
    exact = {q: dict(brute_all) for q, brute_all in want.items()}
    assert np.mean([sum(v in exact[q] for v, _ in g) / 20 for q, g in got.items()]) >= 0.9
    for q, g in got.items():
        assert all(np.isclose(s, exact[q][v], atol=1e-12) for v, s in g if v in exact[q])
        assert g == sorted(g, key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("cell", [(4096, 2048), (50, 3)])
def test_odd_rows_and_ties(spark, monkeypatch, cell):
    monkeypatch.setattr(ann, "CELL_ROWS", cell[0])
    monkeypatch.setattr(ann, "CELL_QUERIES", cell[1])
    chance = np.random.default_rng(4)
    vectors = chance.integers(-2, 3, (300, 3)).astype(float)
    vectors[50:150] = [1.0, 2.0, 0.0]
    rows = [(k, v.tolist(), "z") for k, v in enumerate(vectors) if v.any()]
    odd = [(900, None), (920, []), (940, [0.0, 0.0, 0.0]), (960, [1.0, None, 1.0]), (980, [float("nan"), 1.0, 1.0]), (1000, [float("inf"), 1.0, 1.0]),
           (1020, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([*rows, *((k, v, "z") for k, v in odd)], "vec_id bigint, embedding array<double>, part string")
    found = ann.search(frame, lambda key: key % 20 == 0, recall=1.0).collect()
    want = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = [sum(v in dict(want[q]) for v, _ in g) / 20 for q, g in got.items()]
    assert set(got) == set(want) and np.mean(hits) > 0.9
    # Within what was searched, ties go to the smaller id.
    for g in got.values():
        assert g == sorted(g, key=lambda x: (-x[1], x[0]))


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(frame, lambda key: key % 20 == 0).collect())
    assert found == [(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.0)]
    assert ann.search(frame.limit(0), lambda key: key % 20 == 0).count() == 0
    assert ann.search(frame.filter("vec_id = 0"), lambda key: key % 20 == 0).count() == 0


def test_parts_are_balanced():
    vectors = np.random.default_rng(1).normal(size=(2000, 8))
    part = ann.balanced_parts(vectors, ann.neighbour_graph(vectors, 10), 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.1 * 2000 / 8)


def clustered(rows, seed=7, clusters=400, width=32):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(clusters, width))
    made = centres[chance.integers(0, clusters, rows)] + 0.35 * chance.normal(size=(rows, width))
    return made / np.linalg.norm(made, axis=1, keepdims=True)


def test_recall_of_rows_that_the_router_never_saw(spark):
    vectors = clustered(9000)
    vectors[6000:] = vectors[np.random.default_rng(2).integers(0, 50, 3000)]  # a third are copies of few
    ids = np.random.default_rng(3).permutation(9000)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id bigint, embedding array<double>")
    found = ann.search(frame, lambda key: key % 20 == 0, sample_rows=1024).collect()
    want = brute(ids, vectors)
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append(r.score)
    # By score, as copies tie beyond the twentieth place.
    hits = [np.sum(np.array(got.get(q, [])) >= w[-1][1] - 1e-12) / 20 for q, w in want.items()]
    assert np.mean(hits) >= 0.9


def test_pairs_grow_less_than_the_square_of_the_rows():
    pairs = []
    for rows in (20_000, 200_000):
        vectors = clustered(rows)
        router = ann.fit(vectors[np.random.default_rng(1).permutation(rows)[:8192]], rows, 20)
        ranked = router.ranked(vectors)
        sizes = np.bincount(ranked[:, 0], minlength=router.output.shape[1])
        pairs.append(sizes[ranked[::20, : router.probes]].sum())
    assert pairs[1] < pairs[0] * 10**1.5, (pairs, np.log10(pairs[1] / pairs[0]))
