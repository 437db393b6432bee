"""Query strings and links, case by case."""

from pyspark.sql import functions as F

from skerry.functions import text

#: Query strings and what they mean: text, collections, videos, keyframes, error.
QUERY_BOX = [
    ("red car", "red car", "", "", "", None),
    ("L21, red car, at night", "red car at night", "L21", "", "", None),
    ("L21_V001, L21_V001, L22", "", "L22", "L21_V001", "", None),
    ("L21_V001_007, L21_V002_12", "", "", "L21_V001,L21_V002", "L21_V001_7,L21_V002_12", None),
    ("L21_V001, 7", "", "", "L21_V001", "L21_V001_7", None),
    ("L21_V001_007, dog", None, "", "", "", "keyframe ids cannot be combined with other terms"),
    ("7, 8", None, "", "", "", "a keyframe number goes with exactly one video id"),
    ("l21", "l21", "", "", "", None),
    (" , ", "", "", "", "", None),
]

URLS = [
    ("https://www.youtube.com/watch?v=abcdefghijk&t=5", "abcdefghijk"),
    ("https://youtu.be/abcdefghij_?x=1", "abcdefghij_"),
    ("http://m.youtube.com/shorts/ABCDEFGHIJK", "ABCDEFGHIJK"),
    ("https://youtube.com/embed/abc-efghijk", "abc-efghijk"),
    ("https://example.org/watch?v=abcdefghijk", None),
    ("https://youtube.com/watch?v=short", None),
    ("nonsense", None),
]


def test_query_strings(spark):
    d = spark.createDataFrame([(r[0],) for r in QUERY_BOX], "raw string").select("raw", text.parsed_queries(F.col("raw")).alias("q"))
    d = d.select("raw", "q.text", *[F.array_join(f"q.{c}", ",").alias(c) for c in ("collections", "videos", "keyframes")], "q.error")
    assert sorted(map(repr, map(tuple, d.collect()))) == sorted(map(repr, QUERY_BOX))


def test_links(spark):
    d = spark.createDataFrame([(a,) for a, _ in URLS], "url string").select("url", text.video_id_of(F.col("url")).alias("video"))
    assert {r.url: r.video for r in d.collect()} == dict(URLS)
