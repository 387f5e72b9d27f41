"""Ordinal quality grades by cumulative-link regression on hashed text.

One weight vector w over hashed features is shared by all grades 0..K-1, with rising thresholds t:
P(grade <= k) = s(t[k] - w.x), s the logistic function.  Features are present or not: each distinct word,
and classes of a few statistics of the whole text.  It is fitted by full-batch Adam on a bounded sample of
rated documents (`SAMPLE_ROWS`, the smallest hashes of their ids, the same at every size), in one task;
features that fewer than `LEAST_DOCUMENTS` sampled documents have get no weight.

Every row gets one row.  A null text counts as empty.  Ratings that are null are left out.  Of rows that
share a rated key one text counts, that of the smallest hash, and an equal rating of it counts once.  The fit
does not depend on the order of rows.  Columns other than the named ones take no part, whatever their
names.  Without any
rating, or with one grade only, there is nothing to tell grades apart: every document gets the
smoothed frequencies of the grades and is kept.
"""

from __future__ import annotations

import functools
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, at_task_end, slices, texts

SAMPLE_ROWS = 12_000
BITS = 18
LEAST_DOCUMENTS = 20
STEPS, RATE, PENALTY = 250, 0.05, 1e-4

_WORD = re.compile(r"[^\W_]+")
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


@functools.lru_cache(maxsize=200_000)
def _place(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


at_task_end(_place.cache_clear)


def _share(part: int, whole: int, steps: int) -> int:
    return min(steps, int(steps * part / whole)) if whole else 0


def features(text: str) -> np.ndarray:
    """Places of a text's features, each once."""
    words = _WORD.findall(text.lower())
    distinct = set(words)
    raw = text.encode()
    lines = [x for x in text.split("\n") if x.strip()]
    without = lambda kind: len(raw) - len(raw.translate(None, kind))
    # The line break in these names keeps them apart from words.
    shape = [
        f"\ndistinct {_share(len(distinct), len(words), 10)}",
        f"\nlines {_share(len(set(lines)), len(lines), 10)}",
        f"\nupper {_share(without(_UPPER), len(raw), 20)}",
        f"\ndigits {_share(without(_DIGIT), len(raw), 20)}",
        f"\nmarks {_share(without(_MARKS), len(raw), 40)}",
        f"\nlength {len(words).bit_length()}",
        f"\nword {min(20, 2 * len(text) // max(1, len(words)))}",
    ]
    return np.unique(np.fromiter(map(_place, [*distinct, *shape]), np.int32))


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    trained: bool

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k), k from 1, one column each."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int) -> Model:
    """The model of sampled rows; thresholds start at the grades' smoothed frequencies."""
    size = 1 << BITS
    counts = np.bincount(grades, minlength=n_grades) + 1.0
    below = np.cumsum(counts)[:-1] / counts.sum()
    thresholds = np.log(below / (1 - below))
    weights = np.zeros(size)
    if len(np.unique(grades)) < 2:
        return Model(weights, thresholds, False)
    places = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    common = np.bincount(places, minlength=size)[places] >= min(LEAST_DOCUMENTS, 1 + len(rows) // 20)
    used, places = np.unique(places[common], return_inverse=True)  # only features in use, close together
    owner, n, each = owner[common], len(rows), np.arange(len(rows))
    state = np.concatenate((np.zeros(len(used)), thresholds))
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        own, cuts = state[: len(used)], state[len(used) :]
        score = np.bincount(owner, own[places], n)
        # Columns 0 and K stand for minus and plus infinity.
        chance = np.zeros((n, n_grades + 1))
        chance[:, 1:-1] = _logistic(cuts[None, :] - score[:, None])
        chance[:, -1] = 1.0
        slope = chance * (1 - chance)
        likely = np.maximum(chance[each, grades + 1] - chance[each, grades], 1e-9)
        by_score = (slope[each, grades + 1] - slope[each, grades]) / likely  # of minus the log likelihood
        by_cut = np.zeros((n, n_grades + 1))
        by_cut[each, grades + 1] -= slope[each, grades + 1] / likely
        by_cut[each, grades] += slope[each, grades] / likely
        down = np.concatenate((np.bincount(places, by_score[owner], len(used)) / n + PENALTY * own, by_cut[:, 1:-1].mean(axis=0)))
        first = 0.9 * first + 0.1 * down
        second = 0.999 * second + 0.001 * down * down
        state -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        state[len(used) :] = np.maximum.accumulate(state[len(used) :] + 1e-3 * np.arange(n_grades - 1)) - 1e-3 * np.arange(n_grades - 1)
    weights[used] = state[: len(used)]
    return Model(weights, state[len(used) :], True)


def train(documents: DataFrame, ratings: DataFrame, n_grades: int, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> Model:
    """The model of documents (key, text) and ratings (key, grade), from at most `sample_rows` rated ones."""
    sample = ratings.dropna().orderBy(F.xxhash64("key"), "key", "grade").limit(sample_rows)
    rated = documents.join(F.broadcast(sample), "key")
    # However often a rated key is repeated, one of its texts counts, so the sample stays bounded.
    rated = rated.groupBy("key", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("grade", "text")

    def featured(batches):
        for batch in slices(batches, "text"):
            found = [features(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(found, pa.list_(pa.int32()))], ["grade", "places"])

    def fitted(batches):
        grades, rows = [], []
        for batch in batches:
            grades += batch.column("grade").to_pylist()
            rows += [np.asarray(x.values, np.int32) for x in batch.column("places")]
        # Rows arrive in any order, and sums of doubles depend on it.
        order = sorted(range(len(rows)), key=lambda k: (grades[k], rows[k].tobytes()))
        model = fit([rows[k] for k in order], np.array([grades[k] for k in order], np.int64), n_grades)
        columns = [pa.array([model.weights.astype("<f4").tobytes()]), pa.array([model.thresholds.tolist()]), pa.array([model.trained])]
        yield pa.RecordBatch.from_arrays(columns, ["weights", "thresholds", "trained"])

    # The sample is bounded, and so is what its one task returns.
    places = arrow_map(rated, featured, "grade int, places array<int>").repartition(1)
    row = arrow_map(places, fitted, "weights binary, thresholds array<double>, trained boolean").first()
    return Model(np.frombuffer(row.weights, "<f4").astype(np.float64), np.array(row.thresholds), row.trained)


def grade(documents: DataFrame, ratings: DataFrame, n_grades: int, least: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, expected_grade, tail (P(grade >= k) for k from 1), keep of each row.

    `ratings` has key and grade (0 to n_grades - 1).  keep: P(grade >= least) is a half at least.
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    return _judged(rows, train(rows, ratings, n_grades), least, kind).withColumnRenamed("key", key)


def _scores(values: list[str], model: Model) -> np.ndarray:
    return model.at_least(np.array([model.weights[features(v)].sum() for v in values]))


def _judged(rows: DataFrame, model: Model, least: int, kind: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text"):
            tail = _scores(texts(batch), shared.value)
            keep = (tail[:, least - 1] >= 0.5) | (not shared.value.trained)
            columns = [batch.column("key"), pa.array(tail.sum(axis=1)), pa.array(list(tail), pa.list_(pa.float64())), pa.array(keep)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "expected_grade", "tail", "keep"])

    return arrow_map(rows, run, f"key {kind}, expected_grade double, tail array<double>, keep boolean")


def keep_good(documents: DataFrame, ratings: DataFrame, n_grades: int, least: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, with all columns; decided and filtered where they are read."""
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(train(rows, ratings, n_grades))

    def run(batches):
        for batch in slices(batches, text):
            tail = _scores(texts(batch, text), shared.value)
            keep = (tail[:, least - 1] >= 0.5) | (not shared.value.trained)
            yield batch.filter(pa.array(keep))

    return arrow_map(documents, run, documents.schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from two judgements: toxic 0, else poor 1, good 2; a null judgement gives none."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("toxic").isNotNull() & (F.col("quality") == 0), 1)
    grade = grade.when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    return labels.select(F.col("doc_id").alias("key"), grade.cast("int").alias("grade"))
