"""Grouped facts of a release: documents, availability, capabilities, partition quality, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.operators import sequences


def first_by(value: str, order: str) -> Column:
    """The first non-blank value in an order."""
    return F.min_by(value, F.when(F.trim(F.coalesce(F.col(value), F.lit(""))) != "", F.col(order)))


def one_or(values: Column, none: str, several: str) -> Column:
    """The only element of a set, or a word for none or several."""
    return F.when(F.size(values) == 0, none).when(F.size(values) == 1, values[0]).otherwise(several)


def text_documents(sources: DataFrame) -> DataFrame:
    """One document per (video_id, entity_type, entity_id), null keys kept: non-empty texts in input order (pos), sorted source types, language (one, mul or und)."""
    texts = F.collect_list(F.when(F.coalesce("text", F.lit("")) != "", F.struct("pos", "text")))
    d = sources.groupBy("video_id", "entity_type", "entity_id").agg(
        F.array_join(F.transform(F.array_sort(texts), lambda x: x["text"]), "\n").alias("text"), F.array_join(F.array_sort(F.collect_set("source_type")), ",").alias("source_types"),
        F.array_sort(F.collect_set(F.nullif(F.col("language"), F.lit("")))).alias("languages"),
    )
    return d.withColumn("language", one_or(F.col("languages"), "und", "mul")).drop("languages")


def availability(entities: DataFrame, features: dict[str, DataFrame], key: str, required: list[str]) -> DataFrame:
    """has_<feature> per entity, and status: pass if the required ones are there. features: tables with the key and a status."""
    d = entities
    for name, table in features.items():
        found = table.filter("coalesce(status, '') <> 'failed'").select(key).distinct().withColumn(f"has_{name}", F.lit(True))
        d = d.join(found, key, "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    passed = F.lit(True)
    for name in required:
        passed = passed & F.col(f"has_{name}")
    return d.withColumn("status", F.when(passed, "pass").otherwise("degraded"))


def capabilities(available: DataFrame, features: list[str]) -> DataFrame:
    """capability, status, covered: pass if all entities have it, degraded if some, failed if none."""
    sums = available.agg(*[F.sum(F.col(f"has_{f}").cast("long")).alias(f) for f in features], F.count(F.lit(1)).alias("entities"))
    rows = F.array(*[F.struct(F.lit(f).alias("capability"), F.col(f).alias("covered")) for f in features])
    d = sums.select("entities", F.inline(rows))
    return d.select("capability", "covered", F.when(F.col("covered") == F.col("entities"), "pass").when(F.col("covered") > 0, "degraded").otherwise("failed").alias("status"))


def provider_status(rows: DataFrame, implemented: list[str]) -> DataFrame:
    """provider, status: pass if it is implemented and none of its rows failed."""
    d = rows.groupBy("provider").agg(F.bool_or(F.col("status") == "failed").alias("failed"), F.count(F.lit(1)).alias("rows"))
    return d.select("provider", "rows", F.when(F.col("provider").isin(implemented) & ~F.col("failed"), "pass").otherwise("degraded").alias("status"))


def stage_status(rows: DataFrame, group: str) -> DataFrame:
    """failed if all rows failed, partial if some, else pass."""
    bad = F.count_if(F.col("status") == "failed")
    return rows.groupBy(group).agg(F.when(bad == F.count(F.lit(1)), "failed").when(bad > 0, "partial").otherwise("pass").alias("status"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; nulls are a key."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def partition_quality(shots: DataFrame, scenes: DataFrame, least_shots: int = 4, density: float = 0.8, one_shot_rate: float = 0.7) -> DataFrame:
    """Per video the densities, means and medians of scenes, longest run of boundaries and whether the partition is suspicious.

    shots(video_id, shot_index, boundary): a boundary after the last shot doesn't count.
    """
    order = Window.partitionBy("video_id").orderBy("shot_index")
    last = F.max("shot_index").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    d = shots.select("video_id", "shot_index", F.coalesce(F.col("boundary") & (F.col("shot_index") < last), F.lit(False)).alias("ends"))
    # an island is a shot and the run of boundaries after it
    d = d.withColumn("island", F.col("shot_index") - F.sum(F.col("ends").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.groupBy("video_id", "island").agg(F.count(F.lit(1)).alias("shots"), F.count_if("ends").alias("length"))
    a = d.groupBy("video_id").agg(F.sum("shots").alias("shot_count"), F.sum("length").alias("boundary_count"), F.max("length").alias("longest"))
    c = scenes.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("scene_count"), F.count_if(F.col("shot_count") == 1).alias("one_shot"), F.median("shot_count").alias("median_shots"),
        F.avg("duration_sec").alias("mean_duration"), F.median("duration_sec").alias("median_duration"),
    )
    d = a.join(c.hint("merge"), "video_id", "left")
    n = F.col("shot_count") - 1
    d = d.withColumn("boundary_density", F.when(n > 0, F.col("boundary_count") / F.greatest(n, F.lit(1))).otherwise(0.0)).withColumn("one_shot_rate", F.col("one_shot") / F.col("scene_count"))
    every, dense, single = (n > 0) & (F.col("boundary_count") == n), F.col("boundary_density") >= density, F.col("one_shot_rate") >= one_shot_rate
    return d.withColumn("suspicious", (F.col("shot_count") >= least_shots) & (every | (dense & single)))


def coverage(words: DataFrame, segments: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row: segments, those with words, words, unassigned and doubly assigned words."""
    s = segments.join(words.select("segment_id").distinct().withColumn("w", F.lit(True)), "segment_id", "left").agg(F.count(F.lit(1)).alias("segments"), F.count("w").alias("with_words"))
    times = assigned.groupBy("word_id").agg(F.count(F.lit(1)).alias("times"))
    w = words.join(times, "word_id", "left").agg(F.count(F.lit(1)).alias("words"), F.count_if(F.col("times").isNull()).alias("unassigned"), F.count_if(F.col("times") > 1).alias("duplicated"))
    return s.join(w, F.lit(True)).withColumn("covered", F.try_divide(F.col("with_words"), F.col("segments")))


def vector_summary(vectors_of: DataFrame, norm: Column) -> DataFrame:
    return vectors_of.agg(F.count(F.lit(1)).alias("rows"), F.min(norm).alias("min_norm"), F.max(norm).alias("max_norm"), F.max(F.abs(norm - 1)).alias("max_error"))


def paired_gate(cosines: DataFrame, median: float = 0.995, least: float = 0.98) -> DataFrame:
    """Median and smallest cosine of paired vectors, and whether both reach their gates."""
    d = cosines.agg(F.median("cosine").alias("median_cosine"), F.min("cosine").alias("min_cosine"))
    return d.withColumn("passed", (F.col("median_cosine") >= median) & (F.col("min_cosine") >= least))


def identity_or_mixed(rows: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """The one (provider, model, ..) of a group, or mixed in every field."""
    d = rows.groupBy(group).agg(F.collect_set(F.struct(*fields)).alias("found"))
    return d.select(group, *[F.when(F.size("found") == 1, F.col("found")[0][f]).otherwise("mixed").alias(f) for f in fields])
