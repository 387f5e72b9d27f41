"""Nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut into parts of nearly equal size with few edges
between them: halves along principal directions, then moves to the part of most neighbours while room
is left.  A small classifier learns each vector's part from the parts of its neighbours.  Every row is
indexed under its most probable part.  A query goes to its most probable parts, and all rows there are
ranked by their exact inner product.  Every fourth row of the sample is held out of all fitting; a query
searches as many parts as bring `RECALL` among these.  The number of parts follows that of the rows, up
to one for 48 fitted rows of the sample.  The fit runs on the driver, on at most `sample_rows` vectors.

Parts and queries meet in cells of bounded size, so no part, however large, lands in one task; a vector
is copied once for each block of queries that search its part.  Equal vectors of a cell are ranked once.
Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another
length than most (of equally frequent lengths the smallest counts).  Rows without an id take no part.
Repeated rows are candidates each.  An empty table gives no rows.  Other columns, of any names, are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import stored

SAMPLE_ROWS, GRAPH_NEIGHBOURS = 8192, 10
HELD_OUT = 4  # every so many rows of the sample, one
PART_ROWS, LEAST_PARTS, PART_SAMPLE = 1024, 16, 48
RECALL = 0.97
CELL_ROWS, CELL_QUERIES = 4096, 2048


class Router(NamedTuple):
    hidden: np.ndarray
    output: np.ndarray
    probes: int

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        inner = np.tanh(_unit(vectors) @ self.hidden)
        logits = np.concatenate((inner, np.ones((len(inner), 1))), axis=1) @ self.output
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)

    def ranked(self, vectors: np.ndarray) -> np.ndarray:
        return np.argsort(-self.probabilities(vectors), axis=1, kind="stable")


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Directions and, beside them, a constant."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.concatenate((vectors / np.maximum(length, 1e-300), np.ones((len(vectors), 1))), axis=1)


def neighbour_graph(vectors: np.ndarray, k: int, step: int = 1024) -> np.ndarray:
    """Places of each row's k nearest other rows."""
    k = max(0, min(k, len(vectors) - 1))
    found = np.zeros((len(vectors), k), np.int64)
    for low in range(0, len(vectors) if k else 0, step):
        near = vectors[low : low + step] @ vectors.T
        near[np.arange(len(near)), np.arange(low, low + len(near))] = -np.inf
        found[low : low + step] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for each row, none larger than a tenth over the mean."""
    part = np.zeros(len(vectors), np.int64)
    for _ in range((parts - 1).bit_length()):
        halves = np.zeros_like(part)
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            centred = vectors[own] - vectors[own].mean(axis=0)
            along = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1]
            halves[own[np.argsort(along, kind="stable")[len(own) // 2 :]]] = 1
        part = 2 * part + halves
    room = int(np.ceil(1.1 * len(vectors) / parts))
    for _ in range(sweeps):
        votes = np.zeros((len(vectors), parts))
        np.add.at(votes, (np.repeat(np.arange(len(graph)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        wanted = votes.argmax(axis=1)
        gain = votes.max(axis=1) - votes[np.arange(len(part)), part]
        sizes = np.bincount(part, minlength=parts)
        for row in np.argsort(-gain, kind="stable"):
            if gain[row] <= 0:
                break
            if sizes[wanted[row]] < room:
                sizes[part[row]] -= 1
                sizes[wanted[row]] += 1
                part[row] = wanted[row]
    return part


def learn(vectors: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, width: int = 64, steps: int = 150) -> tuple:
    """Weights of one hidden layer and a softmax, by Adam, towards the parts of a row and its neighbours."""
    target = np.zeros((len(vectors), parts))
    np.add.at(target, (np.repeat(np.arange(len(graph)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(part)), part] += max(1, graph.shape[1])
    target /= target.sum(axis=1, keepdims=True)
    chance = np.random.default_rng(1)
    inputs = _unit(vectors)
    weights = [chance.normal(0, 1.0, (inputs.shape[1], width)), np.zeros((width + 1, parts))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        inner = np.tanh(inputs @ weights[0])
        wide = np.concatenate((inner, np.ones((len(inner), 1))), axis=1)
        logits = wide @ weights[1]
        chances = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (chances / chances.sum(axis=1, keepdims=True) - target) / len(vectors)
        back = (error @ weights[1][:-1].T) * (1 - inner**2)
        for w, (first, second), slope in zip(weights, moments, (inputs.T @ back, wide.T @ error), strict=True):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return weights[0], weights[1]


def parts_for(rows: int, fitted: int) -> int:
    """A power of two: parts of about `PART_ROWS` rows, as far as the fitted rows can tell them apart."""
    wanted = max(LEAST_PARTS, rows // PART_ROWS)
    return 1 << max(0, min(wanted, fitted // PART_SAMPLE).bit_length() - 1)


def fit(vectors: np.ndarray, rows: int, k: int, recall: float = RECALL) -> Router:
    """The router of a sample of a table of so many rows; `probes` is the least number of parts that reaches
    the recall for held-out rows among held-out rows, by as many neighbours as match k in the table."""
    held = vectors[HELD_OUT - 1 :: HELD_OUT]
    fitted = np.delete(vectors, np.s_[HELD_OUT - 1 :: HELD_OUT], axis=0)
    parts = parts_for(rows, len(fitted))
    graph = neighbour_graph(fitted, GRAPH_NEIGHBOURS)
    part = balanced_parts(fitted, graph, parts)
    router = Router(*learn(fitted, graph, part, parts), parts)
    best = neighbour_graph(held, max(1, -(-k * len(held) // max(1, rows))))
    if not best.size:
        return router
    ranked = router.ranked(held)
    place = np.argsort(ranked, axis=1)  # of each part in each query's order
    needed = np.take_along_axis(place, ranked[best, 0], axis=1)
    found = [(needed < probes).mean() for probes in range(1, parts + 1)]
    return router._replace(probes=1 + int(np.argmax(np.array(found) >= recall)))


def rank_cell(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of a cell for each of its queries, ties to the smaller id."""
    columns = ["query_id", "query_row", "vec_id", "score"]
    if queries.empty or rows.empty:
        return pd.DataFrame({c: [] for c in columns})
    rows = rows.sort_values("vec_id", kind="stable")
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64) + 0.0
    distinct, of = np.unique(vectors, axis=0, return_inverse=True)
    ids = rows["vec_id"].to_numpy()
    # The smallest ids of each distinct vector: one more than asked, as a query does not find itself.
    order = np.argsort(of.ravel(), kind="stable")
    starts = np.append(np.flatnonzero(np.diff(of.ravel()[order], prepend=-1)), len(order))
    asked = np.stack(queries["vector"].to_numpy()).astype(np.float64) + 0.0
    near = asked @ distinct.T
    keep = min(k + 1, len(distinct))
    floor = -np.partition(-near, keep - 1, axis=1)[:, keep - 1]
    slack = 1e-9 * (1.0 + np.abs(near).max(axis=1))
    query, place = np.nonzero(near >= (floor - slack)[:, None])
    exact = (distinct[place] * asked[query]).sum(axis=1)
    # The first k + 1 ids of each vector found, each beside the vector's score.
    copies = np.minimum(np.diff(starts)[place], k + 1)
    within = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    query, score = np.repeat(query, copies), np.repeat(exact, copies)
    found = ids[order[np.repeat(starts[place], copies) + within]]
    other = found != queries["query_id"].to_numpy()[query]
    query, score, found = query[other], score[other], found[other]
    best = np.lexsort((found, -score, query))
    query, score, found = query[best], score[best], found[best]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    query, score, found = query[rank < k], score[rank < k], found[rank < k]
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[query], "query_row": queries["query_row"].to_numpy()[query],
                         "vec_id": found, "score": score})


def usable(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vector (doubles) of the rows that take part."""
    rows = frame.select(frame[key].cast("bigint").alias("vec_id"), frame[vector].cast("array<double>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    rows = rows.filter(~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (lengths[0] if lengths else 0))


def search(
    frame: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row for which `is_query(id column)` holds."""
    spark = frame.sparkSession
    rows = usable(frame, key, vector)
    # The smallest hashes of the vectors' ids: a bounded sample, the same however rows are stored.
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    router = spark.sparkContext.broadcast(fit(np.stack(sample["vector"].to_numpy()), rows.count(), k, recall))

    @F.pandas_udf("array<int>")
    def order_of_parts(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(router.value.ranked(np.stack(vectors.to_numpy())).astype(np.int32))) if len(vectors) else pd.Series([], dtype=object)

    routed = stored(rows.withColumn("order", order_of_parts("vector")), "vectors")
    sizes = {r[0]: r[1] for r in routed.groupBy(F.col("order")[0]).count().collect()}  # a row for each part
    queries = routed.filter(is_query(F.col("vec_id"))).select(
        F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("query_row"), "vector",
        F.explode(F.slice("order", 1, router.value.probes)).alias("part"),
    )
    searches = {r[0]: r[1] for r in queries.groupBy("part").count().collect()}  # a row for each part

    def blocks(counts: dict[int, int], size: int):
        return F.create_map(*(F.lit(x) for p, n in counts.items() for x in (p, -(-n // size))))[F.col("part")].cast("int")

    def dealt(frame: DataFrame, own: str, other: str, by: list[str]) -> DataFrame:
        """Each row in one block of its own side, and with all blocks of the other; none without such."""
        frame = frame.withColumn(own, F.pmod(F.xxhash64(*by), F.col(f"{own}s")).cast("int"))
        return frame.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop(f"{own}s", f"{other}s")

    if not searches:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sized = {"blocks": blocks(sizes, CELL_ROWS), "query_blocks": blocks(searches, CELL_QUERIES)}
    candidates = routed.select(F.col("order")[0].alias("part"), "vec_id", "vector").withColumns(sized)
    candidates = dealt(candidates, "block", "query_block", ["vec_id", "vector"])
    asked = queries.dropDuplicates(["query_id", "query_row", "part"]).withColumns(sized)
    asked = dealt(asked, "query_block", "block", ["query_id"])
    cell = ["part", "block", "query_block"]
    met = asked.groupBy(*cell).cogroup(candidates.groupBy(*cell))
    near = met.applyInPandas(lambda q, r: rank_cell(q, r, k), "query_id bigint, query_row bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
