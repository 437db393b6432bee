"""Joins over time-aligned tables: overlaps, best overlaps, as-of and nearest look-ups, ranges by ordinal.

Overlap joins put both sides into time buckets of a video, so a long video is many keys; a pair is kept in the bucket
of its later start only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucketed(d: DataFrame, start: str, end: str, width: float) -> DataFrame:
    return d.withColumn("bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))


def overlapping(entities: DataFrame, segments: DataFrame, width: float = 60.0) -> DataFrame:
    """Pairs of one video with a positive overlap (touching is none), overlap_sec and the shares covered.

    entities(video_id, entity_id, start_sec, end_sec), segments(video_id, segment_id, start_sec, end_sec).
    """
    a = _bucketed(entities.select("video_id", "entity_id", F.col("start_sec").alias("a_start"), F.col("end_sec").alias("a_end")), "a_start", "a_end", width)
    b = _bucketed(segments.select("video_id", "segment_id", F.col("start_sec").alias("b_start"), F.col("end_sec").alias("b_end")), "b_start", "b_end", width)
    d = a.join(b, ["video_id", "bucket"])
    start, end = F.greatest("a_start", "b_start"), F.least("a_end", "b_end")
    d = d.filter((end > start) & (F.col("bucket") == F.floor(start / width)))
    overlap = end - start
    share = lambda whole: F.least(F.lit(1.0), F.greatest(F.lit(0.0), overlap / whole))
    return d.select(
        "video_id", "entity_id", "segment_id", start.alias("overlap_start_sec"), end.alias("overlap_end_sec"), overlap.alias("overlap_sec"),
        share(F.col("b_end") - F.col("b_start")).alias("segment_coverage"), share(F.col("a_end") - F.col("a_start")).alias("entity_coverage"),
    )


def best_interval(words: DataFrame, intervals: DataFrame, width: float = 60.0) -> DataFrame:
    """video_id, segment_id (the word), entity_id: the interval with the largest overlap; ties go to the one that holds the word's midpoint, start included and end not, then to the lower entity_id."""
    d = overlapping(intervals, words, width)
    mid = words.select("video_id", "segment_id", ((F.col("start_sec") + F.col("end_sec")) / 2).alias("mid"))
    spans = intervals.select("video_id", "entity_id", F.col("start_sec").alias("s"), F.col("end_sec").alias("e"))
    d = d.join(mid, ["video_id", "segment_id"]).join(spans, ["video_id", "entity_id"])
    holds = (F.col("mid") >= F.col("s")) & (F.col("mid") < F.col("e"))
    # overlaps that differ by less than 1e-9 of their size tie
    best = d.groupBy("video_id", "segment_id").agg(F.max("overlap_sec").alias("most"))
    d = d.join(best, ["video_id", "segment_id"]).filter(F.abs(F.col("overlap_sec") - F.col("most")) <= F.greatest(F.lit(1e-12), 1e-9 * F.col("most")))
    return d.groupBy("video_id", "segment_id").agg(F.min_by("entity_id", F.struct(F.when(holds, 0).otherwise(1), "entity_id")).alias("entity_id"))


def as_of_frames(ranges: DataFrame, timeline: DataFrame) -> DataFrame:
    """range_id, start_frame, end_frame of time ranges on a sorted timeline(video_id, frame_id, pts_time).

    start: the last frame at or before the range's start, else the first; end, exclusive: the first frame at or after its
    end, one frame after start at least; past the timeline the last frame + 1. One sort per video by time carries the
    look-ups along; no range meets every frame.
    """
    kind = ranges.schema["range_id"].dataType
    frames = timeline.select("video_id", F.col("pts_time").alias("t"), F.col("frame_id").alias("frame"), F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("range_id"))
    starts = ranges.select("video_id", F.col("start_sec").alias("t"), F.lit(None).cast("long").alias("frame"), F.lit(1).alias("kind"), "range_id")
    ends = ranges.select("video_id", F.col("end_sec").alias("t"), F.lit(None).cast("long").alias("frame"), F.lit(-1).alias("kind"), "range_id")
    w = Window.partitionBy("video_id").orderBy("t", "kind")
    d = frames.unionByName(starts).unionByName(ends)
    whole = Window.partitionBy("video_id")
    d = d.withColumn("before", F.last("frame", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # the same order from its end: a frame over all following rows would be computed anew for every row
    back = Window.partitionBy("video_id").orderBy(F.desc("t"), F.desc("kind"))
    d = d.withColumn("after", F.last("frame", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("lowest", F.min("frame").over(whole)).withColumn("highest", F.max("frame").over(whole))
    at = d.filter("kind <> 0").groupBy("video_id", "range_id").agg(
        F.max(F.when(F.col("kind") == 1, F.coalesce("before", "lowest"))).alias("start_frame"), F.max(F.when(F.col("kind") == -1, F.coalesce("after", F.col("highest") + 1))).alias("end_frame")
    )
    return at.withColumn("end_frame", F.greatest("end_frame", F.col("start_frame") + 1))


def nearest(targets: DataFrame, rows: DataFrame, by: str, id_column: str = "frame_id") -> DataFrame:
    """target_id, nearest: the row of the video closest in column by, the smaller id on ties. Looks at the neighbours in order only."""
    w = Window.partitionBy("video_id").orderBy(by, "kind", id_column)
    a = rows.select("video_id", F.col(by), F.col(id_column), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("target_id"))
    b = targets.select("video_id", F.col("target").cast(rows.schema[by].dataType).alias(by), F.lit(None).cast("long").alias(id_column), F.lit(1).alias("kind"), "target_id")
    d = a.unionByName(b)
    row = F.when(F.col("kind") == 0, F.struct(F.col(by).alias("v"), F.col(id_column).alias("id")))
    # among equal values the smallest id is the first of them
    first_of_value = F.min(F.when(F.col("kind") == 0, F.col(id_column))).over(Window.partitionBy("video_id", by))
    d = d.withColumn("row", F.when(row.isNotNull(), F.struct(F.col(by).alias("v"), first_of_value.alias("id"))))
    d = d.withColumn("lo", F.last("row", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    back = Window.partitionBy("video_id").orderBy(F.desc(by), F.desc("kind"), F.desc(id_column))
    d = d.withColumn("hi", F.last("row", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))).filter("kind = 1")
    near = F.array_min(F.filter(F.array("lo", "hi"), lambda x: x.isNotNull()))
    far = F.transform(F.filter(F.array("lo", "hi"), lambda x: x.isNotNull()), lambda x: F.struct(F.abs(x["v"] - F.col(by)).alias("d"), x["id"].alias("id")))
    return d.filter(near.isNotNull()).select("video_id", "target_id", F.array_min(far)["id"].alias("nearest"))


def in_ordinal_range(shots: DataFrame, scenes: DataFrame) -> DataFrame:
    """shots(video_id, shot_index) with the scene whose start..end shots (both included) hold them; scenes don't overlap, so the last start at or before decides."""
    a = shots.select("video_id", F.col("shot_index").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("struct<scene_index: bigint, end_shot: bigint>").alias("scene"))
    b = scenes.select("video_id", F.col("start_shot").alias("at"), F.lit(0).alias("kind"), F.struct(F.col("scene_index").cast("bigint").alias("scene_index"), F.col("end_shot").cast("bigint").alias("end_shot")).alias("scene"))
    w = Window.partitionBy("video_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    d = a.unionByName(b).withColumn("scene", F.last("scene", ignorenulls=True).over(w)).filter("kind = 1")
    return d.select("video_id", F.col("at").alias("shot_index"), F.when(F.col("scene.end_shot") >= F.col("at"), F.col("scene.scene_index")).alias("scene_index"))


def temporal_window(keyframes: DataFrame, hits: DataFrame, before: int, after: int) -> DataFrame:
    """For each hit(video_id, keyframe_no) the frames of its video from before to after it."""
    wanted = hits.select("video_id", F.col("keyframe_no").alias("hit_no"), F.explode(F.sequence(F.col("keyframe_no") - before, F.col("keyframe_no") + after)).alias("keyframe_no"))
    return keyframes.join(wanted, ["video_id", "keyframe_no"]).withColumn("offset", F.col("keyframe_no") - F.col("hit_no"))


def looked_up(ranked: DataFrame, metadata: DataFrame, key: str = "vector_id") -> DataFrame:
    """Ranked ids with their metadata; an id without any is an error when its key is read."""
    d = ranked.join(metadata.withColumn("found", F.lit(True)), key, "left")
    # the check is part of the key, so that pruning can't take it away
    missing = F.raise_error(F.concat(F.lit("no metadata for "), F.col(key).cast("string"))).cast(ranked.schema[key].dataType)
    return d.withColumn(key, F.when(F.col("found"), F.col(key)).otherwise(missing)).drop("found")


def paired(left: DataFrame, right: DataFrame, key: str, policy: str = "strict") -> DataFrame:
    """key, status: matched, left_only or right_only. strict: any orphan is for the caller to reject; tolerant drops right_only rows."""
    a, b = left.select(key).distinct().withColumn("l", F.lit(True)), right.select(key).distinct().withColumn("r", F.lit(True))
    d = a.join(b, key, "full_outer").select(key, F.when(F.col("r").isNull(), "left_only").when(F.col("l").isNull(), "right_only").otherwise("matched").alias("status"))
    return d if policy == "strict" else d.filter("status <> 'right_only'")


def differing(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, fields that differ (null equals null) between the two records of a key."""
    r = right.select(key, *[F.col(f).alias(f"{f}_right") for f in fields])
    unequal: list[Column] = [F.when(~F.col(f).eqNullSafe(F.col(f"{f}_right")), F.lit(f)) for f in fields]
    return left.join(r, key).select(key, F.array_compact(F.array(*unequal)).alias("fields")).filter(F.size("fields") > 0)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def typed_orphans(child: DataFrame, parents: dict[str, tuple[DataFrame, str]], type_column: str, key: str) -> DataFrame:
    """Rows whose key is missing in the parent table that their type names; one anti join against all parents, tagged by type."""
    tagged = None
    for name, (parent, column) in parents.items():
        d = parent.select(F.lit(name).alias(type_column), F.col(column).cast("string").alias(key))
        tagged = d if tagged is None else tagged.unionByName(d)
    return child.withColumn(key, F.col(key).cast("string")).join(tagged, [type_column, key], "left_anti")
