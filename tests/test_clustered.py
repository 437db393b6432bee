"""Clustered tables: look-ups skip row groups by statistics and Bloom filters, rows stay whole."""

import random

import pytest
from pyspark.sql import functions as F

from skerry.sources import clustered
from skerry.sources.shared import new_path, removed


@pytest.fixture(scope="module")
def table(spark):
    n = 40_000
    h = F.xxhash64("id")
    d = spark.range(n).select(
        F.col("id"), F.pmod(h, F.lit(1000)).alias("score"), F.concat(F.lit("entity "), F.pmod(F.xxhash64(h), F.lit(40)).cast("string")).alias("entity"),
        F.sha2(F.col("id").cast("string"), 256).alias("key"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 9).cast("string"))).alias("source"),
    )
    path = new_path(spark, "clustered")
    clustered.write(d, path, ["score", "source"], ["key"], files=8, row_group_bytes=64 << 10, distinct=2000)
    yield d, path, n
    removed(spark, path)


def _look(spark, path, condition):
    d = spark.read.parquet(path).filter(condition)
    rows = sorted(map(tuple, d.collect()))
    return rows, clustered.rows_scanned(d)


@pytest.mark.parametrize(
    "condition, most",
    [("score = 17", 0.15), ("source = 's4'", 0.6), ("score BETWEEN 10 AND 30 AND source = 's4'", 0.1), ("score = 123 AND source = 'hot'", 0.1), ("score > 5000", 0.0)],
)
def test_look_ups_skip_row_groups(spark, table, condition, most):
    d, path, n = table
    rows, scanned = _look(spark, path, condition)
    assert rows == sorted(map(tuple, d.filter(condition).collect()))
    assert len(rows) <= scanned <= most * n


def test_bloom_filter_finds_points(spark, table):
    d, path, n = table
    one = d.filter("id = 31234").first()["key"]
    rows, scanned = _look(spark, path, F.col("key") == one)
    assert [r[0] for r in rows] == [31234] and scanned <= 0.2 * n
    # statistics alone can't tell: digests of every row group span their whole range
    rows, scanned = _look(spark, path, F.col("key") == "8" + one[1:-1] + ("0" if one[-1] != "0" else "1"))
    assert rows == [] and scanned <= 0.1 * n


def test_files_are_even_beside_a_hot_key(spark, table):
    _, path, n = table
    files = clustered.layout(spark, path, ["score", "source"]).collect()
    assert len(files) == 8 and sum(f.rows for f in files) == n
    assert max(f.rows for f in files) < 2 * n / 8
    # a file over a jump of the curve may span all scores; on average files are narrow
    assert sum(f.score_most - f.score_least for f in files) / len(files) < 600


def test_one_value_is_dealt_over_files(spark):
    path = new_path(spark, "clustered")
    clustered.write(spark.range(8000).withColumn("k", F.lit(1)), path, ["k"], files=4)
    assert sorted(f.rows for f in clustered.layout(spark, path, ["k"]).collect())[0] > 1000
    removed(spark, path)


def test_nulls_texts_repeats_and_empty_tables(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, "", "é", "a" * 300, "zz\0"]), rng.choice([None, float("nan"), float("inf"), -1.5, 0.0]), rng.choice([None, True, False])) for _ in range(300)]
    schema = "text string, x double, flag boolean"
    for data in (rows, rows[:1] * 5, [(None, None, None)] * 3, []):
        path = new_path(spark, "clustered")
        clustered.write(spark.createDataFrame(data, schema), path, ["text", "x", "flag"], ["text"], files=3)
        got = spark.read.schema(schema).parquet(path)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, data))
        removed(spark, path)
    with pytest.raises(ValueError, match="no such columns"):
        clustered.write(spark.range(3), "/nowhere", ["x"])
    with pytest.raises(ValueError, match="names of this function"):
        clustered.write(spark.range(3).withColumn("digest_of_row", F.lit(1)), "/nowhere", ["id"])
    with pytest.raises(TypeError):
        clustered.write(spark.range(3).withColumn("a", F.array("id")), "/nowhere", ["a"])


def test_ranks_by_bisection(spark):
    for bounds in ([0.0], [1.0, 2.0, 5.0], [float(x) for x in range(255)]):
        values = [-1.0, 0.0, 0.5, 1.0, 2.0, 4.9, 5.0, 300.0, None]
        got = [r.r for r in spark.createDataFrame([(v,) for v in values], "v double").select(clustered._rank(F.col("v"), bounds).alias("r")).collect()]
        assert got == [0 if v is None else sum(b <= v for b in bounds) for v in values]


def test_ranks_are_taken_in_batches(spark):
    """a batch of values is searched at once, not a lambda per row and step; values that compare oddly rank as before."""
    d = spark.createDataFrame([(float("nan"),), (float("-inf"),), (-0.0,), (float("inf"),), (None,)], "v double")
    d = d.select(clustered._rank(F.col("v"), [0.0, 0.0, 1.0, float("nan")]).alias("r"))
    assert [r.r for r in d.collect()] == [4, 0, 2, 3, 0]
    assert "lambda" not in d._jdf.queryExecution().executedPlan().toString()


def test_statistics(spark, table):
    d, _, n = table
    got = {r.column: r for r in clustered.statistics(d.withColumn("id", F.when(F.col("id") >= 10, F.col("id"))), ["id", "score", "entity"]).collect()}
    assert (got["id"].rows, got["id"].nulls, got["id"].least, got["id"].most) == (n, 10, 10.0, n - 1.0)
    assert got["score"].distinct == pytest.approx(1000, rel=0.1) and got["entity"].distinct == pytest.approx(40, rel=0.1)
    empty = clustered.statistics(d.limit(0), ["score"]).collect()
    assert [(r.rows, r.least, r.distinct) for r in empty] == [(0, None, 0)]
