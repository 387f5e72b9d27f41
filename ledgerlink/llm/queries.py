"""The operators over the test tables, with the parameters they are meant to run with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm import alignment, ann, bpe, decontaminate, jaccard, pii, quality, ranking, sharding, token_counts, urls, warc, wavelet
from ledgerlink.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]
GRADES, LEAST_GRADE = 3, 2
SHARDS = 24


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = quality.grades_of(table(spark, sf_dir, "labels"))
    return quality.grade(table(spark, sf_dir, "documents"), ratings, GRADES, LEAST_GRADE)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, token_ids=False)


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


def op9_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.agreement(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"), SHARDS)


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_quality, op3_nearest, op4_bpe, op5_urls, op6_warc, op7_decontaminate, op8_token_counts, op9_wavelet, op10_jaccard,
    op11_ranking, op12_alignment, op13_shards,
)}
