"""Small inputs with everything that may be odd: nulls, empty and long texts, repeated rows, clashing names."""

import random

from pyspark.sql import types as T

LONG = " ".join(f"word{k % 700}" for k in range(20_000))
TEXTS = [
    None, "", " \n\t ", "One.", "one two three four five", "One two THREE four five", LONG, LONG + " tail",
    "Write to Ann.Lee@mail.example.com or 10.0.0.255, card 4111 1111 1111 1111, call +49 (30) 123-4567.",
    "é è œ ß 日本語 🙂 a\x1cb <|endoftext|> don't  two  spaces\n\nlines", "x" * 3000, "1.2.3.4.5 +1 256.1.1.1 a@b @c.d",
]
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use inside.
CLASHING = ("key", "sum", "place", "node", "rank", "ids", "first", "label", "number", "first_key", "own_key", "row_sum")


def rows(extra=()):
    texts = [*TEXTS, *extra]
    made = [(k, t, "en", None, None) for k, t in enumerate(texts)]
    return [*made, made[4], made[8], (None, "one two three four five", None, "s", 1), (None, None, None, None, None)]


def documents(spark, extra=(), clashing=False):
    frame = spark.createDataFrame(rows(extra), DOCUMENTS).repartition(3)
    for name in CLASHING if clashing else ():
        frame = frame.selectExpr("*", f"'z' as {name}")
    return frame


def prose(seed, count, vocabulary=400):
    chance = random.Random(seed)
    words = ["".join(chance.choice("abcdefghij") for _ in range(chance.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(chance.choices(words, k=chance.randint(8, 120))) for _ in range(count)]


def same(result, expected):
    """The rows as a sorted list, against expected tuples of the same columns."""
    got = sorted((tuple(r) for r in result.collect()), key=repr)
    assert got == sorted((tuple(e) for e in expected), key=repr)
