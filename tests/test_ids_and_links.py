from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from ledgerlink.functions.urls import form_encode
from ledgerlink.operators.headers import MissingColumnError, Sheet
from ledgerlink.plans.ids import id_change_stats, id_changes, record_ids
from ledgerlink.plans.search import search_links, search_links_v1


def tracks(spark, ids):
    frame = spark.createDataFrame([(i, "t", "a") for i in ids], "x string, y string, z string")
    return record_ids(Sheet.positional(frame, ["id", "track", "artist"]))


def test_id_changes(spark):
    before, after = tracks(spark, ["123", "456", "789"]), tracks(spark, ["123", "456", "999"])
    assert {(r.id, r.change) for r in id_changes(before, after).collect()} == {("999", "added"), ("789", "removed")}
    assert tuple(id_change_stats(before, after).first()) == (3, 3, 1, 1, 0)


def test_null_ids_and_copies(spark):
    before, after = tracks(spark, [None, "1", "1"]), tracks(spark, ["1", None, "2", "2"])
    assert [tuple(r) for r in id_changes(before, after).collect()] == [("2", "added")]
    assert tuple(id_change_stats(before.limit(0), after).first()) == (0, 3, 3, 0, 3)


def searchable(spark, rows, headers=("Title", "Artist Name", "album")):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos long, a string, b string, c string")
    return Sheet.positional(frame.select("a", "b", "c", "pos"), headers)


def test_search_links(spark):
    rows = [
        (" Hotel California ", "Eagles", None), ("A&B ~*", "X", " Gold "), ("t", "a", " "), ("", "a", "b"),
        ("nan", "a", "b"), ("t", None, "b"), ("t", "   ", "b"), ("é", "ü", None),
    ]
    prefix = "https://www.amazon.com/s?k="
    got = search_links(searchable(spark, rows)).orderBy("pos").collect()
    assert [(r.pos, r.url) for r in got] == [
        (0, prefix + "Hotel+California+Eagles&i=digital-music"),
        (1, prefix + "A%26B+~%2A+X+Gold&i=digital-music"),
        (2, prefix + "t+a+&i=digital-music"),
        (7, prefix + "%C3%A9+%C3%BC&i=digital-music"),
    ]


def test_limit_counts_input_rows(spark):
    rows = [("", "a", None), ("t", "a", None), ("u", "a", None)]
    sheet = searchable(spark, rows)
    assert [r.pos for r in search_links(sheet, 2).collect()] == [1]
    assert search_links(sheet, 0).count() == 2
    with pytest.raises(ValueError):
        search_links(sheet, -1)
    with pytest.raises(MissingColumnError):
        search_links(searchable(spark, rows, ("x", "y", "z")))


def test_links_v1_are_raw_and_positional(spark):
    got = search_links_v1(searchable(spark, [("a b", "c&d", None), (None, "x", None)], ("any", "name", "z")))
    assert [r.url for r in got.orderBy("pos").collect()] == [
        "https://www.amazon.com/s?k=a b+c&d", "https://www.amazon.com/s?k=+x",
    ]


def test_encoding_of_every_low_character(spark):
    chars = [chr(c) for c in range(1, 0x250)] + ["日", "😀", "a b~*c"]
    frame = spark.createDataFrame([(c,) for c in chars], "s string")
    assert all(r.e == quote_plus(r.s) for r in frame.select("s", form_encode(F.col("s")).alias("e")).collect())
