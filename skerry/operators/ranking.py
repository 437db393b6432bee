"""Vector ranking: exact and inverted-file top-k, more-like-this, paging, sampling, budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.functions import vectors

MAX_K = 200


def checked_k(k: int) -> int:
    if not 1 <= k <= MAX_K:
        raise ValueError(f"top_k must be 1..{MAX_K}, got {k}")
    return k


def cosine_top_k(rows: DataFrame, query: Sequence[float], k: int, id_column: str = "vector_id") -> DataFrame:
    """The k rows nearest by inner product of unit vectors, ties by id: each task keeps k rows, no full sort."""
    scored = rows.withColumn("score", vectors.dot(F.col("embedding"), query))
    return scored.orderBy(F.desc("score"), id_column).limit(k)


def l2_top_k(rows: DataFrame, query: Sequence[float], k: int, id_column: str = "vector_id") -> DataFrame:
    return rows.withColumn("distance", vectors.l2(F.col("embedding"), query)).orderBy("distance", id_column).limit(k)


def ranked(top: DataFrame, by: str = "score", id_column: str = "vector_id", ascending: bool = False) -> DataFrame:
    """rank from 1 over a bounded result (top-k), which is why one partition is enough."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.asc(by) if ascending else F.desc(by), id_column)))


def search(rows: DataFrame, query: Sequence[float], top_k: int, pool_factor: int = 2) -> DataFrame:
    """The pool that grouping works on: twice top_k ranked rows."""
    return ranked(cosine_top_k(rows, query, pool_factor * checked_k(top_k)))


def more_like_this(rows: DataFrame, source_id: int, query: Sequence[float], k: int) -> DataFrame:
    """Top k by a stored vector; the source is taken out after the cut, so k - 1 rows are usual."""
    return ranked(cosine_top_k(rows, query, k)).filter(F.col("vector_id") != source_id)


def recall(exact: DataFrame, other: DataFrame, k: int, query: str = "query_id") -> DataFrame:
    """Per query: share of the exact ids found, and whether the first agrees."""
    a = exact.groupBy(query).agg(F.collect_set("vector_id").alias("a"), F.min_by("vector_id", "rank").alias("top_a"))
    b = other.groupBy(query).agg(F.collect_set("vector_id").alias("b"), F.min_by("vector_id", "rank").alias("top_b"))
    return a.join(b, query, "left").select(query, (F.coalesce(F.size(F.array_intersect("a", "b")), F.lit(0)) / k).alias("recall"), F.coalesce(F.col("top_a") == F.col("top_b"), F.lit(False)).alias("same_top"))


def recall_gate(found: DataFrame, mean: float = 0.98, top: float = 0.99) -> DataFrame:
    d = found.agg(F.avg("recall").alias("mean_recall"), F.min("recall").alias("min_recall"), F.avg(F.col("same_top").cast("double")).alias("top1"))
    return d.withColumn("passed", (F.col("mean_recall") >= mean) & (F.col("top1") >= top))


def ivf(rows: DataFrame, lists: int, seed: int = 20260817):
    """Coarse quantiser: k-means over the vectors. Returns the rows with their list, and the centroids (lists of them)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = rows.withColumn("features", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))))
    model = KMeans(k=lists, seed=seed, maxIter=10, featuresCol="features", predictionCol="list").fit(data)
    return model.transform(data).drop("features"), [list(map(float, c)) for c in model.clusterCenters()]


def ivf_top_k(indexed: DataFrame, centroids: list[list[float]], query: Sequence[float], k: int, probes: int) -> DataFrame:
    """Top k among the rows of the probed lists; a table partitioned by list reads only those."""
    near = sorted(range(len(centroids)), key=lambda i: -sum(a * b for a, b in zip(centroids[i], query)))[:probes]
    return ranked(cosine_top_k(indexed.filter(F.col("list").isin(near)), query, k))


def page(rows: DataFrame, number: int, size: int, total: int, position: str = "rank") -> DataFrame:
    """One page (from 1) of a result whose position column is dense; the number is clamped."""
    pages = max(1, -(-total // size))
    number = min(max(1, number), pages)
    return rows.filter(F.col(position).between((number - 1) * size + 1, number * size))


def evenly(n: Column, maximum: int) -> Column:
    """Positions (from 0) of at most maximum evenly spaced rows of n, rounded half to even; one: the middle."""
    if maximum == 1:
        return F.array(F.floor(n / 2).cast("long"))
    spaced = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(maximum - 1)), lambda i: F.bround(i * (n - 1) / (maximum - 1)).cast("long")))
    return F.when(n <= maximum, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).otherwise(spaced)


def evenly_sampled(rows: DataFrame, group: str, order: list[str], maximum: int) -> DataFrame:
    w = Window.partitionBy(group)
    d = rows.withColumn("place", F.row_number().over(w.orderBy(*order)) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    return d.filter(F.array_contains(evenly(F.col("n"), maximum), F.col("place").cast("long"))).drop("n")


def stratified(rows: DataFrame, stratum: str, identity: str, size: int) -> DataFrame:
    """Round-robin over strata, each in the order of its identities' sha256; each stratum gives size rows at most to the final cut."""
    d = rows.withColumn("digest", F.sha2(F.col(identity).cast("string"), 256))
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy("digest", identity))
    return d.withColumn("turn", turn).filter(F.col("turn") <= size).orderBy("turn", stratum).limit(size).drop("digest")


def first_that_fit(rows: DataFrame, group: str, order: list[str], length: Column, budget: int) -> DataFrame:
    """The longest prefix of each group's rows whose lengths, with a joint of one between them, stay within the budget."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("used", F.sum(length + 1).over(w) - 1).filter(F.col("used") <= budget)


def largest_even_fit(rows: DataFrame, group: str, order: list[str], length: Column, budget: int, most: int) -> DataFrame:
    """group, n: the largest n <= most such that n evenly sampled rows fit the budget together; 0 if none does."""
    w = Window.partitionBy(group)
    d = rows.select(group, (F.row_number().over(w.orderBy(*order)) - 1).alias("place"), F.count(F.lit(1)).over(w).alias("total"), length.alias("size"))
    wanted = F.array(*[F.struct(F.lit(n).alias("n"), F.array_contains(evenly(F.col("total"), n), F.col("place").cast("long")).alias("taken")) for n in range(1, most + 1)])
    d = d.select(group, "size", F.explode(wanted).alias("x")).groupBy(group, F.col("x.n").alias("n")).agg(F.sum(F.when(F.col("x.taken"), F.col("size") + 1).otherwise(0)).alias("used"))
    return d.groupBy(group).agg(F.coalesce(F.max(F.when(F.col("used") - 1 <= budget, F.col("n"))), F.lit(0)).alias("n"))
