"""A corpus pipeline over `documents`: grades, near duplicates, benchmark passages, personal data, token ids.

Null and empty texts are documents without words: they have no near copies, benchmark passages or personal
data, and go through if the classifier lets them.  Rows without id take part; of repeated rows one stays.
Columns of any names pass all stages but the last.  An empty table of documents gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm import bpe, decontaminate, jaccard, pii, quality
from ledgerlink.llm.common import table
from ledgerlink.llm.queries import GRADES, LEAST_GRADE, VOCABULARY
from ledgerlink.sources.store import shared_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose grade is likely the best one."""
    return quality.keep_good(docs, quality.grades_of(table(spark, sf_dir, "labels")), GRADES, LEAST_GRADE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark passages."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data, and terms that give it away, taken out of their texts."""
    return pii.sanitise(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the token ids and checksums of ids and decoded text of each document."""
    return bpe.encode(docs, VOCABULARY)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", sanitisation),
    ("BPE encoding", token_ids),
]

#: No stage can be said in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
