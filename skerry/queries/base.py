"""Registry of queries. A query takes a loader of tables and views; its SQL may name views in braces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Both engines report whole numbers as 64 bits and fractions as doubles.
_WIDER = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}


class Loader:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.sf_dir, name)

    def rows(self, values: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(values, schema)

    def vector(self, vector_id: int) -> list[float]:
        """One stored vector, as a query."""
        found = self("embeddings").filter(F.col("vec_id") == vector_id).select("embedding").first()
        if found is None:
            raise ValueError(f"no vector {vector_id}")
        return list(found[0])


def widened(d: DataFrame) -> DataFrame:
    return d.select([F.col(f"`{c}`").cast("double" if k.startswith("decimal") else _WIDER[k]).alias(c) if k in _WIDER or k.startswith("decimal") else F.col(f"`{c}`") for c, k in d.dtypes])


def query(sql: str | None = None) -> Callable:
    """Registers a function of a Loader under its name; sql: the same rows and columns in DuckDB."""

    def register(f: Callable[[Loader], DataFrame]) -> Callable[[Loader], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: widened(f(Loader(spark, sf_dir)))
        if sql:
            ORACLE[f.__name__] = tables.expand(sql)
        return f

    return register
