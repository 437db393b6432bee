"""Weighted fusion of modalities, diversification, temporal constraints, contest scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weight profiles by task.
PROFILES = {
    "tkis": {"visual": 0.25, "caption": 0.25, "ocr": 0.15, "asr": 0.15, "object": 0.15, "metadata": 0.05},
    "qa": {"visual": 0.15, "caption": 0.25, "ocr": 0.20, "asr": 0.20, "object": 0.15, "metadata": 0.05},
    "trake": {"visual": 0.20, "caption": 0.15, "ocr": 0.10, "asr": 0.10, "object": 0.15, "metadata": 0.30},
    "vkis": {"visual": 0.45, "caption": 0.20, "ocr": 0.05, "asr": 0.05, "object": 0.20, "metadata": 0.05},
}


def normalised(hits: DataFrame) -> DataFrame:
    """hits(modality, vector_id, score) with min-max scores per modality in [0, 1]; equal scores give 1.

    The bounds are aggregated per modality and joined back, so a modality is never one task.
    """
    bounds = hits.groupBy("modality").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    d = hits.join(F.broadcast(bounds), "modality")
    return d.select("modality", "vector_id", F.when(F.col("hi") > F.col("lo"), (F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(1.0).alias("score"))


def fused(hits: DataFrame, weights: dict[str, float]) -> DataFrame:
    """vector_id, fused: the weighted sum of each modality's best score; a modality without a hit counts 0."""
    d = hits.groupBy("vector_id").pivot("modality", sorted(weights)).agg(F.max("score"))
    total: Column = F.lit(0.0)
    for m, w in sorted(weights.items()):
        total = total + F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) * w
    return d.select("vector_id", total.alias("fused"))


def diversified(rows: DataFrame, group: str, score: str, id_column: str, most: int) -> DataFrame:
    """At most so many rows of each group, the best ones."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), id_column))).filter(F.col("place") <= most).drop("place")


def within(left: DataFrame, right: DataFrame, seconds: float) -> DataFrame:
    """Pairs of one video where right follows left by at most so many seconds; buckets of that width keep the join an equality."""
    a = left.select("video_id", F.col("vector_id").alias("a"), F.col("pts_time_sec").alias("t_a"), F.floor(F.col("pts_time_sec") / seconds).alias("b"))
    b = right.select("video_id", F.col("vector_id").alias("b_id"), F.col("pts_time_sec").alias("t_b"), F.explode(F.array(F.floor(F.col("pts_time_sec") / seconds), F.floor(F.col("pts_time_sec") / seconds) - 1)).alias("b"))
    d = a.join(b, ["video_id", "b"]).filter((F.col("t_b") > F.col("t_a")) & (F.col("t_b") - F.col("t_a") <= seconds))
    return d.select("video_id", "a", F.col("b_id").alias("b"))


CUTS = (1, 5, 20, 50, 100)


def recall_score(answers: DataFrame, query: str = "query_id") -> DataFrame:
    """answers(query_id, rank, rscore) -> query_id, score: the mean over k of the best score among the first k."""
    best = [F.coalesce(F.max(F.when(F.col("rank") <= k, F.col("rscore"))), F.lit(0.0)) for k in CUTS]
    return answers.groupBy(query).agg((sum(best[1:], best[0]) / len(CUTS)).alias("score"))


def latest(clues: DataFrame, mode: str, group: str = "session_id", batch: str = "batch") -> DataFrame:
    """current_only: the clues of a session's last batch; accumulated: all."""
    if mode == "accumulated":
        return clues
    if mode != "current_only":
        raise ValueError(f"unknown clue mode {mode!r}")
    last = clues.groupBy(group).agg(F.max(batch).alias(batch))
    return clues.join(last, [group, batch], "left_semi")
