import random
import re
import unicodedata

from pyspark.sql import functions as F

from ledgerlink.functions.text import clean_text, first_token, fold_ascii, strip_spaces, token_set


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")


def test_fold_every_character(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(chars[i : i + 64]) for i in range(0, len(chars), 64)]
    got = rows(spark, texts).select("s", fold_ascii("s").alias("f")).collect()
    assert all(r.f == unicodedata.normalize("NFKD", r.s).encode("ascii", "ignore").decode() for r in got)


def test_clean_edge_cases(spark):
    cases = {
        None: "", "": "", "   ": "", "NA": "na", "None": "none", "Song (Live) [2011]": "song",
        "a (b]c": "a" + "c", "a ((b) c)": "a c", "a (b\nc) d": "a bc d", "a (b\rc) d": "a d",
        "Defeat the Foe": "de", "x FEAT. y": "x", "A&B": "aandb", "a  b": "a  b", "a\tb": "ab",
        "Café": "cafe", "ﬁne": "fine", "日本": "", "½": "12", "（x） y": "y",
    }
    got = {r.s: r.c for r in rows(spark, list(cases)).select("s", clean_text("s").alias("c")).collect()}
    assert got == cases


def test_edition_tail(spark):
    cases = {
        "Song - Live at Home": "song", "Song: Remastered 2011": "song", "Song — Radio Edit": "song",
        "Song - Lively": "song", "Song - Other": "song  other", "Song-Mix": "song", "Live": "live",
    }
    got = {r.s: r.c for r in rows(spark, list(cases)).select("s", clean_text("s", True).alias("c")).collect()}
    assert got == cases


def test_cleaning_random_texts_leaves_plain_ones(spark):
    rnd = random.Random(1)
    atoms = [
        " ", "  ", "(", ")", "[", "]", "-", ":", "–", "feat", "feat. ", "FEAT ", "ﬁ", "é", "½", "（", "\n", "\r", "\t",
        "\x1c", "\x85", " ", "&", "live", "remaſter", "Remastered 2011", "mİx", "radio edit", "a", "b", "Z",
        "9", "~", "　", "K", "日", "​",
    ]
    texts = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 14))) for _ in range(5000)]
    got = rows(spark, texts).select(
        "s", clean_text("s").alias("a"), clean_text("s", True).alias("b"), strip_spaces(F.col("s")).alias("c")
    )
    for r in got.collect():
        assert re.fullmatch("[a-z0-9 ]*", r.a) and r.a == r.a.strip()
        assert re.fullmatch("[a-z0-9 ]*", r.b) and r.b == r.b.strip()
        assert r.c == r.s.strip()


def test_tokens(spark):
    got = rows(spark, ["", "b a  b", "x"]).select(token_set(F.col("s")).alias("t"), first_token(F.col("s")).alias("f"))
    assert [(r.t, r.f) for r in got.collect()] == [([], ""), (["b", "a"], "b"), (["x"], "x")]
