"""Greedy chunks by blocks against the plain rule."""

import random

import pytest
from pyspark.sql import functions as F

from skerry.operators.folds import folded
from skerry.plans import packing

SCHEMA = "g string, pos long, video_id long, bytes long"


def _plain(rows, most, most_bytes):
    """The rule, a row at a time."""
    out, state = {}, {}
    for g, pos, video, size in sorted(rows, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        chunk, n, used = state.get(g, (-1, 0, 0))
        size = most_bytes if size is None else max(size, 0)
        if not n or n >= most or used + size > most_bytes:
            chunk, n, used = chunk + 1, 0, 0
        state[g] = chunk, n + 1, used + size
        out[g, video] = chunk
    return out


@pytest.mark.parametrize("block", [1, 3, 16, 4096])
@pytest.mark.parametrize("most, most_bytes", [(1, 50), (5, 100), (40, 60), (7, 10_000)])
def test_blocks_equal_the_rule(spark, monkeypatch, block, most, most_bytes):
    monkeypatch.setattr(packing, "BLOCK", block)
    rng = random.Random(block * 100 + most)
    rows = []
    for k in range(700):
        g = rng.choice([None, "hot", "hot", "hot", "b", "c"])
        pos = rng.choice([None, k, k, k, 7, -k, 10**9 + k])  # repeated, missing, negative and far positions
        rows.append((g, pos, k, rng.choice([None, 0, -3, 60, 200, *[rng.randint(0, 40)] * 6])))
    got = {(r.g, r.video_id): r.chunk for r in packing.greedy_chunks(spark.createDataFrame(rows, SCHEMA), "g", most, most_bytes).collect()}
    assert got == _plain(rows, most, most_bytes)


def test_more_equal_positions_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 10)
    rows = [("g", 5, k, k % 4) for k in range(205)]
    got = {(r.g, r.video_id): r.chunk for r in packing.greedy_chunks(spark.createDataFrame(rows, SCHEMA), "g", 8, 11).collect()}
    assert got == _plain(rows, 8, 11)
    assert packing.greedy_chunks(spark.createDataFrame([], SCHEMA), "g", 8, 11).count() == 0


def _dealt(d):
    """How many exchanges of a plan are repartitions by columns; Spark keeps those together that it adds by itself only where no join becomes a broadcast."""
    return d._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_COL")


def test_blocks_are_dealt_after_their_entries_are_known(spark):
    d = packing.greedy_chunks(spark.createDataFrame([("g", 5, 1, 1)], SCHEMA), "g", 12, 150)
    assert _dealt(d) == 3


def test_a_fold_deals_rows_that_come_from_a_join(spark):
    rows = spark.range(2000).select((F.col("id") % 3).alias("g"), "id")
    few = rows.groupBy("g").agg(F.count("*").alias("n"))
    joined = rows.hint("merge").join(few, "g").select("g", "id")

    def step(state, row):
        state[0] += 1
        return state[0]

    found = folded(joined, "g", ["id"], lambda: [0], step, "place long")
    assert _dealt(found) == 1
    assert found.filter("place <> floor(id / 3) + 1").count() == 0
