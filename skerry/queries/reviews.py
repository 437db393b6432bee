"""The scene review over the driver's timeline: two frames a shot, a judge whose labels follow the frames' values."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.plans import reviews
from skerry.queries.base import query
from skerry.sources.shared import Rounds

_POLICY = reviews.ReviewPolicy(consistency_rounds=3, degenerate_rounds=2)


def _judge(labels):
    """Every fifth video is called a boundary everywhere by all but the last question, every tenth by that too."""
    a, b, v, k = F.col("a"), F.col("b"), F.col("video_id"), F.col("round")
    label = (
        F.when(F.col("kind") == "primary", ((a + F.col("window")) % 3 == 0) | (v % 5 == 0))
        .when(F.col("kind") == "focused_review", a % 3 == 0)
        .when(F.col("kind") == "consistency_review", ((b + k) % 3 == 0) | (v % 5 == 0))
        .otherwise(((b + k) % 4 == 0) | (v % 10 == 0))
    )
    reason = F.concat_ws(":", "kind", "round", "window", "first_shot", "last_shot")
    asked = lambda requests: requests.join(labels.repartition("video_id").hint("merge"), ["video_id", "gap"])
    return lambda requests: asked(requests).select("video_id", "window", "gap", label.alias("boundary"), reason.alias("reason"), ((a % 100) / 100).alias("confidence"))


def _reviewed(t):
    frames = t("timeline").select("video_id", "frame_id", "value_ms", F.floor(F.col("frame_id") / 2).alias("at"))
    found = frames.groupBy("video_id", "at").agg(F.min("frame_id").alias("first"), F.max("frame_id").alias("last"), F.count(F.lit(1)).alias("frames"), F.sum("value_ms").alias("a"), F.max("value_ms").alias("b"))
    # shots and labels are read in every round: the timeline is gone through once
    found = Rounds(t.spark, "shots").put(found)
    shots = found.select("video_id", F.col("at").alias("shot_index"), F.col("first").cast("double").alias("start_sec"), (F.col("last") + 1).cast("double").alias("end_sec"), "frames")
    return reviews.reviewed(shots, _judge(found.select("video_id", F.col("at").alias("gap"), "a", "b")), _POLICY)


def _triggers_sql(k: int) -> str:
    """asked{k}(video_id, gap, reason) of the videos in active{k}."""
    return f"""
    x{k} AS (SELECT *, coalesce(boundary AND (lag(boundary) OVER o OR lead(boundary) OVER o), FALSE) AS next_to, count(*) OVER (PARTITION BY video_id) AS n,
                    sum(boundary::INT) OVER (o ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS found FROM active{k} WINDOW o AS (PARTITION BY video_id ORDER BY gap)),
    y{k} AS (SELECT *, bool_or((gap + 3 <= n OR gap = 0) AND found >= 2) OVER (PARTITION BY video_id ORDER BY gap ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS in_dense FROM x{k}),
    hits{k} AS (SELECT video_id, gap FROM y{k} WHERE next_to OR in_dense UNION SELECT video_id, gap FROM votes WHERE video_id IN (SELECT video_id FROM active{k}) GROUP BY video_id, gap HAVING count(*) >= 2 AND count(DISTINCT boundary) = 2),
    p{k} AS (SELECT h.video_id, greatest(0, gap - 4) AS s, least(shots - 2, gap + 4) AS e, shots FROM hits{k} h JOIN counts USING (video_id)),
    q{k} AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM p{k}),
    r{k} AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM q{k}),
    regions{k} AS (SELECT video_id, shots, min(s) AS s, max(e) AS e FROM r{k} GROUP BY video_id, shots, island),
    pieces{k} AS (SELECT video_id, shots, e, unnest(range(s, e + 1, 8)) AS s FROM regions{k}),
    asked{k} AS MATERIALIZED (SELECT video_id, unnest(range(s, least(e, s + 7) + 1)) AS gap, concat_ws(':', 'consistency_review', {k}, s, greatest(0, s - 4), least(shots - 1, least(e, s + 7) + 5)) AS reason FROM pieces{k}),
    u{k} AS (SELECT s.* REPLACE (CASE WHEN h.gap IS NULL THEN s.boundary ELSE (b + {k}) % 3 = 0 OR s.video_id % 5 = 0 END AS boundary, CASE WHEN h.gap IS NULL THEN s.route ELSE 'consistency_review' END AS route, coalesce(h.reason, s.reason) AS reason,
                      CASE WHEN h.gap IS NULL THEN s.consistency_round ELSE {k} END AS consistency_round),
                    s.boundary AS was, bool_or(h.gap IS NOT NULL) OVER (PARTITION BY s.video_id) AS hit
             FROM active{k} s LEFT JOIN asked{k} h ON h.video_id = s.video_id AND h.gap = s.gap JOIN labels l ON l.video_id = s.video_id AND l.gap = s.gap),
    round{k} AS MATERIALIZED (SELECT * EXCLUDE (was, hit) REPLACE (CASE WHEN hit THEN {k} ELSE consistency_rounds END AS consistency_rounds), bool_or(boundary <> was) OVER (PARTITION BY video_id) AS moved FROM u{k}),
    active{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (moved) FROM round{k} WHERE moved)"""


def _quality_sql(name: str, state: str) -> str:
    return f"""
    {name} AS MATERIALIZED (
      SELECT *, shots >= 4 AND ((gaps > 0 AND boundary_count = gaps) OR (density >= 0.9 AND rate >= 0.8)) AS suspicious FROM (
        SELECT *, CASE WHEN gaps > 0 THEN boundary_count / gaps::DOUBLE ELSE 0 END AS density, one_shot / scene_count::DOUBLE AS rate FROM (
          SELECT c.video_id, c.shots, c.shots - 1 AS gaps, count(*) FILTER (s.boundary) AS boundary_count, count(*) FILTER (s.boundary) + 1 AS scene_count,
                 count(*) FILTER ((shot = 0 OR before) AND (shot = c.shots - 1 OR s.boundary)) AS one_shot
          FROM (SELECT video_id, shots, unnest(range(shots)) AS shot FROM counts) c
          LEFT JOIN (SELECT video_id, gap, boundary FROM {state}) s ON s.video_id = c.video_id AND s.gap = shot
          LEFT JOIN (SELECT video_id, gap, boundary AS before FROM {state}) b ON b.video_id = c.video_id AND b.gap = shot - 1
          GROUP BY c.video_id, c.shots)))"""


def _degenerate_sql(k: int) -> str:
    """again{k}: the videos of odd{k} with a label for every gap."""
    return f"""
    again{k} AS MATERIALIZED (
      SELECT s.* REPLACE ((b + {k}) % 4 = 0 OR s.video_id % 10 = 0 AS boundary, 'degenerate_review' AS route, TRUE AS degenerate_review, {k} AS degenerate_rounds,
               concat_ws(':', 'degenerate_review', {k}, s.gap // 8, greatest(0, s.gap // 8 * 8 - 6), least(shots - 1, least(s.gap // 8 * 8 + 8, shots - 1) + 6)) AS reason), s.boundary AS was
      FROM odd{k} s JOIN labels l ON l.video_id = s.video_id AND l.gap = s.gap JOIN counts c ON c.video_id = s.video_id),
    {_quality_sql(f"quality{k}", f"again{k}")},
    odd{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (was) FROM again{k} WHERE video_id IN (SELECT video_id FROM again{k} GROUP BY video_id HAVING bool_or(boundary <> was)) AND video_id IN (SELECT video_id FROM quality{k} WHERE suspicious))"""


_REVIEW_SQL = f"""
    WITH frames AS (SELECT video_id, frame_id, value_ms, frame_id // 2 AS place FROM {{timeline}}),
    labels AS MATERIALIZED (SELECT video_id, place AS gap, sum(value_ms)::BIGINT AS a, max(value_ms) AS b FROM frames GROUP BY video_id, place),
    counts AS MATERIALIZED (SELECT video_id, count(DISTINCT place) AS shots FROM frames GROUP BY video_id),
    w AS (SELECT video_id, shots, unnest(range(0, shots - 1, 6)) AS s FROM counts),
    windows AS (SELECT video_id, shots, s // 6 AS win, s, least(s + 8, shots - 1) - 1 AS e FROM w WHERE s = 0 OR s - 6 + 8 < shots - 1),
    places AS (SELECT *, unnest(range(s, e + 1)) AS gap FROM windows),
    votes AS MATERIALIZED (
      SELECT video_id, gap, win, (a + win) % 3 = 0 OR video_id % 5 = 0 AS boundary, a, concat_ws(':', 'primary', 0, win, greatest(0, s - 4), least(shots - 1, e + 5)) AS reason,
             1 + least(gap - s, e - gap) / greatest(1, (e - s) // 2)::DOUBLE AS weight
      FROM places JOIN labels USING (video_id, gap)),
    scored AS (
      SELECT video_id, gap, shots, a, count(*) AS votes, sum(CASE WHEN boundary THEN weight ELSE 0 END) AS true_weight, sum(CASE WHEN boundary THEN 0 ELSE weight END) AS false_weight, arg_max(reason, win) AS reason
      FROM votes JOIN counts USING (video_id) GROUP BY ALL),
    s0 AS (SELECT *, true_weight / (true_weight + false_weight) AS score FROM scored),
    active1 AS MATERIALIZED (
      SELECT video_id, gap, votes, true_weight, false_weight, score, CASE WHEN score >= 0.67 THEN TRUE WHEN score <= 0.33 THEN FALSE ELSE a % 3 = 0 END AS boundary,
             CASE WHEN score >= 0.67 OR score <= 0.33 THEN 'primary' ELSE 'focused_review' END AS route,
             CASE WHEN score >= 0.67 OR score <= 0.33 THEN reason ELSE concat_ws(':', 'focused_review', 0, gap, greatest(0, gap - 4), least(shots - 1, gap + 5)) END AS reason,
             (a % 100) / 100.0::DOUBLE AS confidence, NULL::BIGINT AS consistency_round, 0::BIGINT AS consistency_rounds, FALSE AS degenerate_review, 0::BIGINT AS degenerate_rounds
      FROM s0),
    {_triggers_sql(1)}, {_triggers_sql(2)}, {_triggers_sql(3)},
    settled AS MATERIALIZED (SELECT * EXCLUDE (moved) FROM round1 WHERE NOT moved UNION ALL SELECT * EXCLUDE (moved) FROM round2 WHERE NOT moved UNION ALL SELECT * EXCLUDE (moved) FROM round3),
    {_quality_sql("first_quality", "settled")},
    odd1 AS MATERIALIZED (SELECT * FROM settled WHERE video_id IN (SELECT video_id FROM first_quality WHERE suspicious)),
    {_degenerate_sql(1)}, {_degenerate_sql(2)},
    final AS MATERIALIZED (
      SELECT * FROM settled WHERE video_id NOT IN (SELECT video_id FROM odd1)
      UNION ALL SELECT * EXCLUDE (was) FROM again1 WHERE video_id NOT IN (SELECT video_id FROM odd2) UNION ALL SELECT * EXCLUDE (was) FROM again2),
    {_quality_sql("last_quality", "final")}"""


@query(_REVIEW_SQL + " SELECT * EXCLUDE (consistency_rounds, degenerate_rounds) REPLACE (round(score, 6) AS score, round(true_weight, 6) AS true_weight, round(false_weight, 6) AS false_weight) FROM final")
def review_decisions(t):
    """A row per gap: votes, route, round and the last question's reason and confidence."""
    return _reviewed(t).decisions.withColumns({c: F.round(c, 6) for c in ("score", "true_weight", "false_weight")})


@query(_REVIEW_SQL + """
    SELECT l.video_id, l.shots AS shot_count, l.boundary_count, l.scene_count, l.one_shot, round(l.density, 6) AS boundary_density, l.suspicious, f.boundary_count AS first_boundary_count, f.suspicious AS first_suspicious,
           coalesce(r.consistency_rounds, 0)::BIGINT AS consistency_rounds, coalesce(r.degenerate_rounds, 0)::BIGINT AS degenerate_rounds,
           concat_ws(',', CASE WHEN l.shots >= 4 AND l.boundary_count = l.gaps THEN 'all_gaps_are_boundaries' END, CASE WHEN l.shots >= 4 AND l.density >= 0.9 THEN 'extreme_boundary_density' END, CASE WHEN l.shots >= 4 AND l.rate >= 0.8 THEN 'extreme_one_shot_scene_rate' END) AS flags,
           CASE WHEN l.suspicious THEN 'suspicious' WHEN f.suspicious THEN 'mended' ELSE 'pass' END AS status
    FROM last_quality l JOIN first_quality f USING (video_id) LEFT JOIN (SELECT video_id, max(consistency_rounds) AS consistency_rounds, max(degenerate_rounds) AS degenerate_rounds FROM final GROUP BY video_id) r USING (video_id)""")
def review_videos(t):
    """A row per video: its partition before and after the review, and what the review has done."""
    d = _reviewed(t).videos
    return d.select("video_id", "shot_count", "boundary_count", "scene_count", "one_shot", F.round("boundary_density", 6).alias("boundary_density"), "suspicious", "first_boundary_count", "first_suspicious", "consistency_rounds", "degenerate_rounds", F.array_join("flags", ",").alias("flags"), "status")
