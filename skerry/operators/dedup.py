"""Near-duplicate grouping of ranked pools, and distances of hashes and token sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.functions import vectors


def anchored(pool: DataFrame, threshold: float = 0.94, penalty: float = 0.4) -> DataFrame:
    """Adds duplicates (better-ranked rows at the threshold or above), similar_to (the best of them), adjusted score and adjusted_rank.

    pool: vector_id, rank, score, embedding; a pool is a few hundred rows (twice top_k), so each row meets all better ones.
    """
    better = pool.select(F.col("vector_id").alias("other"), F.col("rank").alias("other_rank"), F.col("embedding").alias("other_embedding"))
    close = (F.col("other_rank") < F.col("rank")) & (vectors.dot(F.col("embedding"), F.col("other_embedding")) >= threshold)
    found = pool.join(F.broadcast(better), close).groupBy("vector_id").agg(F.count(F.lit(1)).alias("duplicates"), F.min_by("other", "other_rank").alias("similar_to"))
    d = pool.join(F.broadcast(found), "vector_id", "left").withColumn("duplicates", F.coalesce("duplicates", F.lit(0)))
    d = d.withColumn("adjusted", F.col("score") * F.pow(F.lit(penalty), "duplicates"))
    return d.withColumn("adjusted_rank", F.row_number().over(Window.orderBy(F.desc("adjusted"), "rank")))


def trimmed(grouped: DataFrame, top_k: int) -> DataFrame:
    return grouped.filter(F.col("adjusted_rank") <= top_k)


def clusters(grouped: DataFrame) -> DataFrame:
    """anchor, members (by rank), size of anchors that are still in the result; clusters whose anchor was trimmed vanish."""
    anchors = grouped.select(F.col("vector_id").alias("anchor"))
    members = grouped.filter("similar_to IS NOT NULL").join(F.broadcast(anchors), F.col("similar_to") == F.col("anchor"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "vector_id"))), lambda x: x["vector_id"])
    return members.groupBy("anchor").agg(ids.alias("members"), F.count(F.lit(1)).alias("size"))


def _complete(distance: np.ndarray, limit: float) -> np.ndarray:
    """Cluster number of each row: merge the two clusters whose farthest members are nearest, while that is within the limit."""
    n = len(distance)
    label = np.arange(n)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    while n > 1:
        i, j = divmod(int(d.argmin()), n)
        if not d[i, j] <= limit:
            break
        i, j = min(i, j), max(i, j)
        label[label == j] = i
        d[i] = np.maximum(d[i], d[j])
        d[:, i] = d[i]
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
    return label


def linked(pool: DataFrame, threshold: float = 0.94, penalty: float = 0.4) -> DataFrame:
    """Complete linkage over a pool: cluster (its best vector_id), position by rank, adjusted score.

    A pool is bounded (twice top_k <= 400 rows), so it is one group.
    """

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", ignore_index=True)
        v = np.asarray(pdf["embedding"].tolist(), dtype=float)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        label = _complete(1 - v @ v.T, 1 - threshold + 1e-12)
        pdf["cluster"] = pdf["vector_id"].to_numpy()[label]
        pdf["position"] = pdf.groupby("cluster").cumcount()
        pdf["adjusted"] = pdf["score"] * penalty ** pdf["position"]
        return pdf[["vector_id", "rank", "score", "cluster", "position", "adjusted"]]

    d = pool.select("vector_id", "rank", "score", "embedding").withColumn("pool", F.lit(0))
    return d.groupBy("pool").applyInPandas(lambda k, pdf: group(pdf), "vector_id long, rank int, score double, cluster long, position long, adjusted double")


def linkage_clusters(labelled: DataFrame, least: int = 2) -> DataFrame:
    """Clusters of two or more, with their members by rank."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "vector_id"))), lambda x: x["vector_id"])
    return labelled.groupBy("cluster").agg(ids.alias("members"), F.count(F.lit(1)).alias("size")).filter(F.col("size") >= least)


def mode_counts(grouped: DataFrame, labelled: DataFrame) -> DataFrame:
    """mode, clusters, images of both groupings."""
    a = clusters(grouped).agg(F.lit("anchor").alias("mode"), F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum(F.col("size") + 1), F.lit(0)).alias("images"))
    b = linkage_clusters(labelled).agg(F.lit("linkage").alias("mode"), F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("size"), F.lit(0)).alias("images"))
    return a.unionByName(b)


def hamming_ratio(a: Column, b: Column, bits: int) -> Column:
    """Share of different bits of two packed hashes."""
    return F.bit_count(a.bitwiseXOR(b)) / bits


def bit_jaccard_distance(a: Column, b: Column) -> Column:
    union = F.bit_count(a.bitwiseOR(b))
    return F.when(union == 0, 0.0).otherwise(1 - F.bit_count(a.bitwiseAND(b)) / union)


def token_jaccard_distance(a: Column, b: Column, reliable: Column | None = None) -> Column:
    """1 - shared / all of two token arrays; null if unreliable, 0 if both are empty, 1 if one is."""
    shared, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    out = F.when((F.size(a) == 0) & (F.size(b) == 0), 0.0).otherwise(1 - shared / F.greatest(every, F.lit(1)))
    return out if reliable is None else F.when(reliable, out)


def exact_first(rows: DataFrame, identity: list[str], order: list[str], reliable: Column) -> DataFrame:
    """One row of each identity among reliable rows, the first in order; unreliable rows all stay.

    Only 128 bits of the identity and the order are aggregated (large groups are reduced before the shuffle), so long texts
    stay where they are; rows that the order doesn't tell apart all stay.
    """
    place = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)])
    keys = {"key1": F.xxhash64(*identity), "key2": F.xxhash64(F.lit(1), *identity)}
    marked = rows.filter(reliable).withColumns(keys | {"place": place})
    first = marked.groupBy("key1", "key2").agg(F.min("place").alias("place"))
    return marked.join(first, ["key1", "key2", "place"], "left_semi").drop("key1", "key2", "place").unionByName(rows.filter(~reliable))


def nearest_references(candidates: DataFrame, references: DataFrame, group: str, value: str, reference_value: str) -> DataFrame:
    """Per candidate the smallest difference to a reference of its group, and which it is (the smaller id on ties).

    One sort of each group by value: the neighbours below and above decide, so candidates and references are never paired.
    Candidates without a value, a group or references of their group have no row; references without a value are no neighbours.
    Several rows of one candidate_id are one candidate: its closest row counts. Differences of up to the rounding of doubles tie.
    """
    none = F.lit(None).cast("long")
    a = candidates.select(group, F.col(value).cast("double").alias("at"), F.col("candidate_id").cast("long").alias("candidate_id"), none.alias("reference_id"))
    b = references.select(group, F.col(reference_value).cast("double").alias("at"), none.alias("candidate_id"), F.col("reference_id").cast("long").alias("reference_id"))
    # equal values are one reference, the smallest id
    b = b.groupBy(group, "at").agg(F.min("candidate_id").alias("candidate_id"), F.min("reference_id").alias("reference_id"))
    d = a.unionByName(b).filter(F.col("at").isNotNull() & ~F.isnan("at") & F.col(group).isNotNull())
    seen = F.when(F.col("reference_id").isNotNull(), F.struct("at", "reference_id"))

    def last_seen(order: Column) -> Column:
        # rows of one value are all seen before any of its candidates
        return F.last(seen, ignorenulls=True).over(Window.partitionBy(group).orderBy(order, F.col("reference_id").isNull()).rowsBetween(Window.unboundedPreceding, 0))

    d = d.withColumn("below", last_seen(F.asc("at"))).withColumn("above", last_seen(F.desc("at"))).filter("candidate_id IS NOT NULL")
    sides = F.filter(F.array("below", "above"), lambda x: x.isNotNull())
    best = F.array_min(F.transform(sides, lambda x: F.struct(F.abs(F.col("at") - x["at"]).alias("distance"), x["reference_id"].alias("nearest"))))
    found = d.select(group, "candidate_id", best.alias("best")).filter("best IS NOT NULL").groupBy(group, "candidate_id").agg(F.min("best").alias("best"))
    return found.select(group, "candidate_id", "best.distance", "best.nearest")
