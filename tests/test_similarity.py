import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlink.functions.lcs import lcs_lengths
from ledgerlink.operators.features import features, overlap_bound, ratio_bound
from ledgerlink.operators.scoring import Weights, _with_shared, text_bounds, tight_bounds, with_text_signals
from tests import plain


def test_kernel_of_long_texts():
    """Patterns of one word to many, of sizes around the words' ends, against the plain table."""
    rnd = random.Random(8)
    text = lambda size, letters: "".join(rnd.choices(letters, k=size))
    sizes = [63, 64, 65, 127, 128, 129, 191, 192, 200, 256, 257, 300, 500]
    pairs = [(text(rnd.choice(sizes), a), text(rnd.choice(sizes), a)) for a in ("ab", "abcdefgh ", "aé日 b") for _ in range(40)]
    pairs += [("a" * 130, "a" * 500), ("ab" * 64, "ba" * 64), ("a" * 1030, "ab" * 600)]
    got = lcs_lengths(pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]))
    assert got.tolist() == [plain.lcs(*p) for p in pairs]


def test_kernel_agrees_with_table_method():
    rnd = random.Random(3)
    alphabets = ["ab ", "abcdefghij ", "éßa日", "abcdefghijklmnopqrstuvwxyz0123456789 "]
    left, right = [], []
    for _ in range(800):
        letters = rnd.choice(alphabets)
        for side in (left, right):
            side.append("".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 20, 63, 64, 65, 130]))))
    left[5] = right[9] = None
    got = lcs_lengths(pa.array(left), pa.array(right))
    assert got.tolist() == [plain.lcs(a or "", b or "") for a, b in zip(left, right)]


def scored(spark, pairs):
    frame = spark.createDataFrame(pairs, "a string, b string")
    frame = frame.select("a", "b", features("a").alias("x"), features("b").alias("y"))
    frame = frame.select(
        "*", F.expr(ratio_bound("x", "y")).alias("ratio_limit"), F.expr(overlap_bound("x", "y")).alias("overlap_limit")
    )
    return with_text_signals(frame, {"title": ("x", "y")}).collect()


@pytest.mark.parametrize(
    ("a", "b", "ratio", "overlap"),
    [
        ("", "", 0.5, 0.0),  # equal texts, but no words
        ("abc", "", 0.0, 0.0),
        ("abc", "abc", 1.0, 1.0),
        ("love", "love me do", (8 / 14 + 1) / 2, 1 / 3),  # one word set inside the other
        ("abcd", "abed", (6 / 8 + 6 / 8) / 2, 0.0),
        # shared "the": remainders "x" and "y" differ, best is the shared word against a side
        ("the x", "the y", (8 / 10 + 8 / 10) / 2, 0.5),
    ],
)
def test_hand_computed(spark, a, b, ratio, overlap):
    row = scored(spark, [(a, b)])[0]
    assert row.ratio_title == pytest.approx(ratio, abs=1e-12)
    assert row.ngram_title == pytest.approx(overlap, abs=1e-12)


def test_signals_and_bounds_on_random_pairs(spark):
    rnd = random.Random(4)
    words = ["the", "love", "lovely", "a", "aa", "zz9", "song", "songs", "mississippi", "b1", "night", "nights"]
    text = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6)))
    pairs = [(text(), text()) for _ in range(3000)]
    pairs += [(a, a.replace("s", "", 1)) for a, _ in pairs[:500]]
    for row in scored(spark, pairs):
        assert (row.ratio_title, row.ngram_title) == plain.signals(row.a, row.b)
        assert row.ratio_limit >= row.ratio_title - 1e-12
        assert row.overlap_limit >= row.ngram_title - 1e-12


def test_limits_of_pairs(spark):
    """Whatever the texts, the limits before the kernel are not below the exact signals."""
    rnd = random.Random(1)
    words = ["the", "a", "love", "xx", "night 7", "brand 12 34", "brand 12 43", "the the", "evol"]
    phrase = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 4)))
    letters = lambda: " ".join("".join(rnd.choices("abc ", k=rnd.randint(0, 14))).split())
    rows = [(make(), make()) for make in (phrase, letters) for _ in range(3000)]
    pairs = spark.createDataFrame(rows, "a string, b string").select(features("a").alias("a"), features("b").alias("b"))
    for name in ("title", "album"):
        fields = {name: ("a", "b")}
        exact = with_text_signals(pairs, fields)
        limits = {signal: F.expr(limit).alias(f"limit_{signal}") for signal, limit in tight_bounds(fields).items()}
        both = _with_shared(exact, fields, limits=True).select(f"ratio_{name}", f"ngram_{name}", *limits.values())
        assert both.filter(f"limit_ratio_{name} < ratio_{name} - 1e-9 or abs(limit_ngram_{name} - ngram_{name}) > 1e-12").count() == 0
        kept = with_text_signals(pairs, fields, lambda b: F.expr(f"{b[f'ratio_{name}']} >= 0.6 - 1e-9"), ("a.text", "b.text"))
        assert kept.filter(f"ratio_{name} >= 0.6").count() == exact.filter(f"ratio_{name} >= 0.6").count() > 100


def test_artist_pairs_that_reach_the_kernel(spark):
    """Behind one first word, few of the pairs that the join lets through are compared exactly."""
    names = [f"the brand {k} {k * 7 % 101}" for k in range(400)]
    left = spark.createDataFrame([(n,) for n in names], "l string").select(features("l").alias("a"))
    right = spark.createDataFrame([(n.replace("brand", "band brand"),) for n in names], "r string").select(features("r").alias("b"))
    fields, weights = {"artist": ("a", "b")}, Weights()
    reach = lambda b: weights.reachable(b | {"ratio_album": "0D", "ngram_album": "0D"})
    joined = left.join(right, reach(text_bounds("artist", "a", "b")))
    compared = _with_shared(joined, fields, limits=True).filter(reach(tight_bounds(fields)))
    matching = with_text_signals(joined, fields).filter(reach({"ratio_artist": "ratio_artist", "ngram_artist": "ngram_artist"}))
    assert 0 < matching.count() <= compared.count() < joined.count() / 4
