"""Joins over time-aligned tables, and joins by id."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.operators import intervals
from skerry.queries.base import query

_PAIRS_SQL = """
    WITH pairs AS (
      SELECT a.video_id, a.shot_index AS entity_id, segment_id, greatest(a.start_sec, b.start_sec)::DOUBLE AS s, least(a.end_sec, b.end_sec)::DOUBLE AS e,
             a.start_sec::DOUBLE AS a_start, a.end_sec::DOUBLE AS a_end, b.start_sec::DOUBLE AS b_start, b.end_sec::DOUBLE AS b_end
      FROM (SELECT * FROM {shots}) a JOIN (SELECT * FROM {segments}) b ON a.video_id = b.video_id AND a.start_sec < b.end_sec AND b.start_sec < a.end_sec
    )"""


def _double(d, *columns: str):
    return d.withColumns({c: F.col(c).cast("double") for c in columns})


def shots(t):
    return _double(t("shots").withColumnRenamed("shot_index", "entity_id"), "start_sec", "end_sec")


def segments(t):
    return _double(t("segments"), "start_sec", "end_sec")


@query(_PAIRS_SQL + """
    SELECT video_id, entity_id, segment_id, s AS overlap_start_sec, e AS overlap_end_sec, round(e - s, 6) AS overlap_sec, round((e - s) / (b_end - b_start), 6) AS segment_coverage,
           round((e - s) / (a_end - a_start), 6) AS entity_coverage FROM pairs""")
def overlap_links(t):
    d = intervals.overlapping(shots(t), segments(t))
    return d.withColumns({c: F.round(c, 6) for c in ("overlap_sec", "segment_coverage", "entity_coverage")})


@query(_PAIRS_SQL + """
    SELECT video_id, segment_id, entity_id FROM (
      SELECT *, row_number() OVER (PARTITION BY video_id, segment_id ORDER BY e - s DESC, CASE WHEN (b_start + b_end) / 2 >= a_start AND (b_start + b_end) / 2 < a_end THEN 0 ELSE 1 END, entity_id) AS n FROM pairs
    ) WHERE n = 1""")
def best_overlap_words(t):
    return intervals.best_interval(segments(t), shots(t))


def _frames(t):
    return t("timeline").select("video_id", "frame_id", (F.col("frame_id") + (F.col("value_ms") % 7) / 10).alias("pts_time"))


_FRAMES_SQL = "(SELECT video_id, frame_id, frame_id + (value_ms % 7) / 10.0::DOUBLE AS pts_time FROM {timeline})"


@query(f"""
    WITH f AS (SELECT * FROM {_FRAMES_SQL}), r AS (SELECT video_id, segment_id AS range_id, start_sec::DOUBLE AS s, end_sec::DOUBLE AS e FROM {{segments}}),
    x AS (SELECT video_id, range_id, max(frame_id) FILTER (pts_time <= s) AS a, min(frame_id) FILTER (pts_time >= e) AS b, min(frame_id) AS lo, max(frame_id) AS hi FROM r JOIN f USING (video_id) GROUP BY ALL)
    SELECT video_id, range_id, coalesce(a, lo) AS start_frame, greatest(coalesce(b, hi + 1), coalesce(a, lo) + 1) AS end_frame FROM x""")
def asof_frames(t):
    return intervals.as_of_frames(segments(t).withColumnRenamed("segment_id", "range_id"), _frames(t))


@query("""
    SELECT video_id, segment_id AS target_id, frame_id AS nearest FROM (
      SELECT s.video_id, segment_id, f.frame_id, row_number() OVER (PARTITION BY s.video_id, segment_id ORDER BY abs(f.frame_id - t), f.frame_id) AS n
      FROM (SELECT video_id, segment_id, floor(start_sec * 2)::BIGINT AS t FROM {segments}) s JOIN (SELECT video_id, frame_id FROM {timeline}) f ON f.video_id = s.video_id
    ) WHERE n = 1""")
def nearest_frame(t):
    targets = segments(t).select("video_id", F.col("segment_id").alias("target_id"), F.floor(F.col("start_sec") * 2).alias("target"))
    return intervals.nearest(targets, t("timeline").select("video_id", F.col("frame_id").alias("at"), "frame_id"), "at")


@query(f"""
    SELECT video_id, segment_id AS target_id, frame_id AS nearest FROM (
      SELECT s.video_id, segment_id, f.frame_id, row_number() OVER (PARTITION BY s.video_id, segment_id ORDER BY abs(f.pts_time - t), f.frame_id) AS n
      FROM (SELECT video_id, segment_id, end_sec::DOUBLE AS t FROM {{segments}}) s JOIN {_FRAMES_SQL} f ON f.video_id = s.video_id
    ) WHERE n = 1""")
def nearest_time(t):
    targets = segments(t).select("video_id", F.col("segment_id").alias("target_id"), F.col("end_sec").alias("target"))
    return intervals.nearest(targets, _frames(t), "pts_time")


@query("SELECT video_id, shot_index, CASE WHEN shot_index % 3 <> 2 THEN shot_index // 3 END AS scene_index FROM {shots}")
def ordinal_range(t):
    """Scenes of the shots 3k and 3k + 1; every third shot has none."""
    s = t("shots").select("video_id", "shot_index")
    scenes = s.filter("shot_index % 3 = 0").select("video_id", F.col("shot_index").alias("start_shot"), (F.col("shot_index") + 1).alias("end_shot"), (F.col("shot_index") / 3).cast("long").alias("scene_index"))
    return intervals.in_ordinal_range(s, scenes)


@query("""
    SELECT h.video_id, h.keyframe_no::BIGINT AS hit_no, k.vector_id, k.keyframe_no::BIGINT AS keyframe_no, (k.keyframe_no - h.keyframe_no)::BIGINT AS "offset"
    FROM (SELECT * FROM {keyframes} WHERE vector_id % 50 = 0) h JOIN (SELECT * FROM {keyframes}) k ON h.video_id = k.video_id AND k.keyframe_no BETWEEN h.keyframe_no - 2 AND h.keyframe_no + 3""")
def temporal_window(t):
    k = t("keyframes").select("video_id", "keyframe_no", "vector_id")
    return intervals.temporal_window(k, k.filter("vector_id % 50 = 0").select("video_id", "keyframe_no"), 2, 3).select("video_id", "hit_no", "vector_id", "keyframe_no", "offset")


@query("""
    SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' WHEN d.doc_id IS NULL THEN 'right_only' ELSE 'matched' END AS status
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 10 <> 0) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def pairing_strict(t):
    return intervals.paired(t("documents").filter("doc_id % 10 <> 0"), t("labels"), "doc_id")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'matched' END AS status FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 10 <> 0) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def pairing_tolerant(t):
    return intervals.paired(t("documents").filter("doc_id % 10 <> 0"), t("labels"), "doc_id", "tolerant")


@query("""
    SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus <> s THEN 'o_orderstatus' END, CASE WHEN o_orderpriority IS DISTINCT FROM p THEN 'o_orderpriority' END) AS fields
    FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders) WHERE o_orderstatus <> s OR o_orderpriority IS DISTINCT FROM p""")
def record_differences(t):
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    other = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("o_orderstatus"))).withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")))
    return intervals.differing(o, other, "o_orderkey", ["o_orderstatus", "o_orderpriority"]).withColumn("fields", F.array_join("fields", ","))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)")
def lookup_orphans(t):
    return intervals.orphans(t("orders").select("o_orderkey"), t("lineitem").filter("l_quantity > 25"), "o_orderkey", "l_orderkey")


@query("""
    WITH c AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'customer' WHEN 1 THEN 'supplier' ELSE 'other' END AS kind, (event_id % 1700)::VARCHAR AS entity FROM events)
    SELECT event_id, kind, entity FROM c WHERE NOT EXISTS (SELECT 1 FROM customer WHERE kind = 'customer' AND c_custkey::VARCHAR = entity) AND NOT EXISTS (SELECT 1 FROM supplier WHERE kind = 'supplier' AND s_suppkey::VARCHAR = entity)""")
def typed_orphans(t):
    kind = F.when(F.col("event_id") % 3 == 0, "customer").when(F.col("event_id") % 3 == 1, "supplier").otherwise("other")
    child = t("events").select("event_id", kind.alias("kind"), (F.col("event_id") % 1700).alias("entity"))
    return intervals.typed_orphans(child, {"customer": (t("customer"), "c_custkey"), "supplier": (t("supplier"), "s_suppkey")}, "kind", "entity").select("event_id", "kind", "entity")
