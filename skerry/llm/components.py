"""Connected components of a table of links, by alternating large-star and small-star steps (DataFrame functions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first())


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links(a, b: long) -> id, root: the smallest id of its component, for every id with a link but the roots.

    Each round points nodes at smaller ones; the number of rounds grows with the logarithm of the longest chain. Rounds
    are written to the shared folder, so lineage stays short; a node's many links are never gathered in a row.
    """
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = scratch.put(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.put(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.put(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        scratch.drop(e, large)
        e, before, state = new, state, _state(new)
        if state == before:
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
