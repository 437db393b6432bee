"""Ordered unions and set differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stacked(*tables: DataFrame) -> DataFrame:
    """UNION ALL by name with source, the table's place, so that later steps can keep the order; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("source", F.lit(k)) for k, t in enumerate(tables)])


def ordered_union(key: str, order: str, *tables: DataFrame) -> DataFrame:
    """Distinct union: each key once, from the first table and place that has it: key, source, order."""
    rows = stacked(*[t.select(key, order) for t in tables])
    return rows.groupBy(key).agg(F.min(F.struct("source", order)).alias("at")).select(key, "at.source", f"at.{order}")


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, side: in the left set only or in the right only."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def intersection_size(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("shared"))
