"""Tables laid out for look-ups by several columns: interleaved sort keys, Bloom filters, statistics of columns and files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a key's rank: 256 ranges of about equal counts.
BITS = 8
#: Error of a rank's bounds: one in so many.
ACCURACY = 2000


def _number(name: str, kind: T.DataType) -> Column:
    """A number in the order of the column's values; of a text its first six bytes, so longer texts may tie."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        c = c.cast("timestamp")
    if isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("double")
    raise TypeError(f"{name}: rows can't be ordered by {kind.simpleString()}")


def _rank(value: Column, bounds: Sequence[float]) -> Column:
    """How many bounds are at or below the value, by bisection; a null value has rank 0. Equal bounds count each, so a frequent value has ranks to itself."""
    ordered = np.sort(np.asarray(bounds, dtype=float))

    @F.pandas_udf("long")
    def rank(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ordered, values.to_numpy(), side="right"))

    # NaN is above all numbers in both engines; a null would look like one
    return F.when(value.isNull(), 0).otherwise(rank(value)).cast("long")


def interleaved(d: DataFrame, keys: Sequence[str]) -> Column:
    """A row's place on the curve that takes the keys' ranks bit by bit in turn, so that near rows are near in every key.

    Ranks come from one pass over the keys that gathers quantile sketches; 255 bounds a key come to the driver.
    """
    if not 1 <= len(keys) <= 7:
        raise ValueError("1 to 7 keys are needed")
    numbers = {k: _number(k, d.schema[k].dataType) for k in keys}
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = d.agg(*[F.percentile_approx(numbers[k], shares, ACCURACY).alias(f"b{i}") for i, k in enumerate(keys)]).first()
    ranks = [_rank(numbers[k], sorted(found[f"b{i}"] or [0.0])) for i, k in enumerate(keys)]
    bits = [F.shiftleft(F.shiftright(r, b).bitwiseAND(1), b * len(keys) + i) for b in range(BITS) for i, r in enumerate(ranks)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write(d: DataFrame, path: str, keys: Sequence[str], look_ups: Sequence[str] = (), files: int = 16, row_group_bytes: int = 64 << 20, distinct: int = 1_000_000) -> None:
    """Writes d as Parquet, clustered by the keys; columns of look_ups get Bloom filters, made for so many distinct values a row group.

    Files hold about equal numbers of rows: rows of one place on the curve, a hot key's too, are dealt by a digest of
    the row, so only identical rows have to share a file. Rows and columns stay as they are; nulls stand first; an
    empty table is written empty.
    """
    missing = [c for c in (*keys, *look_ups) if c not in d.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    place, digest = "place_on_curve", "digest_of_row"
    if place in d.columns or digest in d.columns:
        raise ValueError(f"{place} and {digest} are names of this function")
    hashed = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in k else F.col(f"`{c}`") for c, k in d.dtypes])
    rows = d.withColumn(place, interleaved(d, keys)).withColumn(digest, hashed)
    rows = rows.repartitionByRange(files, place, digest).sortWithinPartitions(place, *[F.col(f"`{k}`") for k in keys], digest)
    writer = rows.drop(place, digest).write.option("parquet.block.size", row_group_bytes)
    for c in look_ups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", distinct)
    writer.parquet(path)


def layout(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """file, rows, and <key>_least and <key>_most of each file: what a look-up by the key can skip."""
    d = spark.read.parquet(path)
    bounds = [f(F.col(f"`{k}`")).alias(f"{k}_{n}") for k in keys for n, f in (("least", F.min), ("most", F.max))]
    return d.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *bounds)


def statistics(d: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, rows, nulls, least, most, distinct (a sketch's estimate, off by two hundredths or so): one pass, numbers as doubles.

    What a cost-based choice of plans would ask for. Of an empty table least and most are null.
    """
    numbers = {c: _number(c, d.schema[c].dataType) for c in columns}
    facts = [
        F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(n.isNull()).alias("nulls"), F.min(n).alias("least"), F.max(n).alias("most"),
            F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias("distinct"),
        ).alias(f"s{i}")
        for i, (c, n) in enumerate(numbers.items())
    ]
    return d.agg(*facts).select(F.inline(F.array(*[f"s{i}" for i in range(len(facts))])))


def rows_scanned(d: DataFrame) -> int:
    """Rows that the scans of an executed DataFrame gave to its plan: row groups and pages skipped by statistics or Bloom filters aren't among them."""
    plan = d._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        below = node.children()
        todo += [below.apply(i) for i in range(below.size())]
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
    return total
