import pytest
from pyspark.sql import functions as F

from skerry.functions import text
from skerry.sources import records

RAW = "video_id string, title string, keywords array<string>, length long, publish_date string"


def test_organiser_fields(spark):
    d = spark.createDataFrame([("v", "  ", [" a", ""], 3, "1/2/2024"), ("w", " t ", None, None, None)], RAW)
    got = {r.video_id: r for r in records.organiser_fields(d).collect()}
    assert got["v"][1:] == (None, ["a"], 3, "2024-02-01") and got["w"][1:] == ("t", None, None, None)


@pytest.mark.parametrize("row,message", [(("v", "t", [], -1, None), "negative"), (("v", "t", [], 1, "soon"), "unsupported date")])
def test_bad_fields_are_errors(spark, row, message):
    with pytest.raises(Exception, match=message):
        records.organiser_fields(spark.createDataFrame([row], RAW)).collect()


@pytest.mark.parametrize("query,language,message", [("  ", "auto", "is empty"), ("x", "klingon", "unsupported query language")])
def test_query_plans_are_checked(spark, query, language, message):
    with pytest.raises(Exception, match=message):
        spark.range(1).select(text.query_plan(F.lit(query), F.lit(language), F.lit("english"), F.lit(None).cast("boolean")).alias("p")).collect()


def test_removed_prefixes_must_match(spark):
    one = lambda words, removed: spark.createDataFrame([(words, removed)], "w array<string>, r string").select(text.without_prefix(F.col("w"), F.col("r")).alias("x")).first().x
    assert one(["Ab,", "c", "d"], "ab C") == ["d"] and one(["a"], "b") is None and one(["a"], "") == ["a"] and one([], "a") is None and one(["a"], "A") == []
