import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlink.functions.numbers import (
    fixed2,
    parse_number,
    parse_number_v2,
    plain_decimal,
    round_half_even,
    to_count,
)

TEXTS = [
    "1,250", " 12 ", "1e3", "inf", "nan", "1d", "12.7", "-3", "", "0x10", "1_000", "+5", ".5", "5.", "Infinity",
    "-inf", "1e400", "\t7\n", "1e", "--1", "NaN", "true", "1.5e-7", "+ 5", "-", "1_0", "_1", "-1e400",
]


def test_round_like_python(spark):
    rnd = random.Random(2)
    values = [2.675, 0.7125, 0.0625, 1.005, -2.675, -0.001, 0.125, 0.5, float("inf")]
    values += [k / 16 for k in range(100)] + [(2 * k + 1) / 2000 for k in range(2000)] + [(2 * k + 1) / 200 for k in range(2000)]
    values += [rnd.random() * 10 ** rnd.randint(-3, 9) for _ in range(5000)] + [-rnd.random() for _ in range(500)]
    values += [(2 * rnd.randint(0, 10**10) + 1) / 200 for _ in range(2000)]
    values += [50000000000.126, 123456789012.345, -123456789012.345, 2.0**30, 2.0**30 - 0.005, 2.0**52 - 0.5, 2.0**52 + 1]
    values += [rnd.choice([-1, 1]) * rnd.random() * 10 ** rnd.randint(9, 16) for _ in range(5000)]
    values += [rnd.randint(2**30, 2**40) + k / 1024 for k in range(1024)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    got = frame.select("x", round_half_even(F.col("x"), 2).alias("a"), round_half_even(F.col("x"), 3).alias("b"))
    assert all((repr(r.a), repr(r.b)) == (repr(round(r.x, 2)), repr(round(r.x, 3))) for r in got.collect())


def test_parse(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    got = frame.select(
        "x", parse_number(F.col("x")).alias("a"), parse_number_v2(F.col("x")).alias("b"),
        to_count(parse_number(F.col("x"))).alias("n"),
    ).collect()
    expected = pd.to_numeric(pd.Series(TEXTS), errors="coerce").fillna(0).tolist()

    def v2(text):
        try:
            return float(text.replace(",", "").strip() or 0)
        except ValueError:
            return 0.0

    for r, number in zip(got, expected):
        assert r.a == number, r.x
        assert repr(r.b) == repr(v2(r.x)), r.x
        assert r.n == (0 if abs(number) == float("inf") else int(number)), r.x


def test_counts_beyond_bigint(spark):
    frame = spark.createDataFrame([(9.2e18,), (-9.2e18,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert [r.n for r in frame.select(to_count(F.col("x")).alias("n")).collect()] == [92 * 10**17, -92 * 10**17, 0, 0, 0]
    with pytest.raises(Exception, match="a count is too large"):
        spark.createDataFrame([(1e20,)], "x double").select(to_count(F.col("x"))).collect()


def test_plain_decimal_and_fixed2(spark):
    frame = spark.createDataFrame([("1.25",), ("1e3",), ("",), (" 7 ",)], "x string")
    assert [None if r.d is None else float(r.d) for r in frame.select(plain_decimal(F.col("x")).alias("d")).collect()] == [
        1.25, None, None, 7.0,
    ]
    frame = spark.createDataFrame([(-0.0,), (3.1,), (float("inf"),), (float("nan"),)], "x double")
    assert [r.t for r in frame.select(fixed2(F.col("x")).alias("t")).collect()] == ["-0.00", "3.10", "inf", "nan"]
