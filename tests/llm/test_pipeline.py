import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import bpe, jaccard
from ledgerlink.llm.queries import VOCABULARY

from . import cases


def write(spark, folder, documents):
    """The tables that the stages read, with ratings by a word of the text."""
    documents.write.parquet(f"{folder}/documents.parquet")
    rated = documents.filter("doc_id >= 1000").select(
        "doc_id", F.col("text").contains("fine").cast("int").alias("quality"), F.col("text").contains("vile").cast("int").alias("toxic")
    )
    rated.write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(f"bench{k}" for k in range(30))), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def corpus():
    """Odd rows, then rated prose: fine, dull and vile, a near copy of each fine one, a benchmark passage, an address."""
    chance = random.Random(2)
    prose = cases.prose(6, 240, vocabulary=900)
    made = []
    for k, text in enumerate(prose):
        words = text.split()
        mark = ["fine", "dull", "vile"][k % 3]
        for _ in range(6):
            words.insert(chance.randint(0, len(words)), mark)
        made.append((1000 + k, " ".join(words), "en", "s", 1))
    first = made[0][1]
    made.append((2000, first + " end", "en", "s", 1))
    made.append((2001, "fine fine " + " ".join(f"bench{k}" for k in range(5, 20)) + " fine fine fine", "en", "s", 1))
    made.append((2002, "fine fine fine write to some.one@mail.example.org fine fine " + made[9][1], "en", "s", 1))
    return made + [made[3], made[3]]


@pytest.mark.parametrize("clashing", [False, True])
def test_run(spark, tmp_path, clashing):
    frame = spark.createDataFrame([*cases.rows(), *corpus()], cases.DOCUMENTS)
    for name in ("key", "label", "number", "ids", "row") if clashing else ():
        frame = frame.withColumn(name, F.lit("z"))
    write(spark, tmp_path, frame)
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    texts = {}
    for row in bpe.decode(result, VOCABULARY).collect():
        texts.setdefault(row.doc_id, []).append(row.text)
    kept = {k for k in texts if k is not None and k >= 1000}
    fine = {1000 + k for k in range(240) if k % 3 == 0}
    assert len(kept & fine) >= 0.9 * len(fine) and not kept & {1000 + k for k in range(240) if k % 3 == 2}
    assert 2000 not in kept and 2001 not in kept  # a near copy of a smaller id, a benchmark passage
    assert all(len(texts[k]) == 1 for k in kept)
    assert "some.one@" not in "".join(t for own in texts.values() for t in own)


def test_empty_documents(spark, tmp_path):
    write(spark, tmp_path, spark.createDataFrame(corpus(), cases.DOCUMENTS))
    none = spark.createDataFrame([], cases.DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0


def test_the_same_row_stays(spark):
    """Rows alike in id and text but not in other columns: which one stays does not depend on the order."""
    rows = [(1, "a b c d e f", lang, None, k) for k, lang in enumerate("xyzuvw")]
    found = {jaccard.keep_first(spark.createDataFrame(r, cases.DOCUMENTS).repartition(n)).first() for r, n in ((rows, 1), (rows[::-1], 3))}
    assert len(found) == 1
