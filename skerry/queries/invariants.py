"""Package invariants in one scan, and scores in half precision."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.operators import events
from skerry.plans import checks
from skerry.queries.base import query

# ---- a video's package: four frames a shot, three shots a scene


def _package(t):
    v = F.concat(F.lit("v"), F.col("video_id"))
    f = t("timeline").select(v.alias("video_id"), "frame_id", "value_ms", F.floor(F.col("frame_id") / 4).alias("shot"))
    named = lambda kind, c: F.concat("video_id", F.lit(kind), F.lpad(c.cast("string"), 5, "0"))
    scene = F.floor(F.col("shot") / 3)
    g = f.groupBy("video_id", "shot").agg(F.min("frame_id").alias("start_frame"), (F.max("frame_id") + 1).alias("end_frame"), F.sum("value_ms").alias("v"))
    # every 31st shot starts a frame late, every 37th has another scene's name
    late = F.when(F.col("v") % 31 == 0, 1).otherwise(0)
    shots = g.select("video_id", F.col("shot").alias("shot_index"), named("_SH", F.col("shot")).alias("shot_id"), F.when(F.col("v") % 37 != 0, named("_SC", scene)).alias("scene_id"), (F.col("start_frame") + late).alias("start_frame"), "end_frame", F.col("start_frame").cast("double").alias("start_sec"), F.col("end_frame").cast("double").alias("end_sec"))
    scenes = g.groupBy("video_id", scene.alias("scene_index")).agg(F.count(F.lit(1)).alias("shot_count"), F.min("start_frame").alias("start_frame"), F.max("end_frame").alias("end_frame"))
    scenes = scenes.select("video_id", "scene_index", named("_SC", F.col("scene_index")).alias("scene_id"), "shot_count", "start_frame", "end_frame", F.col("start_frame").cast("double").alias("start_sec"), F.col("end_frame").cast("double").alias("end_sec"))
    first = (F.col("frame_id") % 4 == 0) | (F.col("value_ms") % 41 == 0)
    keyframes = f.select("video_id", F.concat_ws(":", "video_id", F.when(F.col("value_ms") % 43 == 0, F.col("frame_id") + 1).otherwise(F.col("frame_id"))).alias("keyframe_id"), "frame_id", named("_SH", F.col("shot")).alias("shot_id"), named("_SC", scene).alias("scene_id"), F.when(F.col("frame_id") % 4 == 0, "main").otherwise("supplemental").alias("role"), first.alias("is_representative"))
    texts = f.select("video_id", F.concat_ws(":", "video_id", F.col("frame_id") + F.when(F.col("value_ms") % 47 == 0, 100_000).otherwise(0)).alias("keyframe_id"))
    captions = g.filter("v % 53 <> 0").select("video_id", named("_SH", F.col("shot")).alias("shot_id"), F.concat_ws(":", "video_id", F.col("shot") * 4).alias("keyframe_id"))
    summaries = scenes.select("video_id", "scene_id")
    return shots, scenes, keyframes, texts, captions, summaries.unionAll(summaries.filter(F.col("scene_id").endswith("00003")))


@query("""
    WITH f AS (SELECT 'v' || video_id AS video_id, frame_id, value_ms, frame_id // 4 AS shot FROM {timeline}),
    g AS (SELECT video_id, shot, min(frame_id) AS lo, max(frame_id) + 1 AS hi, sum(value_ms)::BIGINT AS v FROM f GROUP BY video_id, shot),
    late AS (SELECT *, lo + (v % 31 = 0)::INT AS lo2, v % 37 = 0 AS lost FROM g),
    chosen AS (SELECT video_id, shot, count(*) FILTER (frame_id % 4 = 0 OR value_ms % 41 = 0) AS n, max(video_id || ':' || CASE WHEN value_ms % 43 = 0 THEN frame_id + 1 ELSE frame_id END) FILTER (frame_id % 4 = 0 OR value_ms % 41 = 0) AS kf FROM f GROUP BY video_id, shot),
    named AS (SELECT video_id, CASE WHEN value_ms % 43 = 0 THEN frame_id + 1 ELSE frame_id END AS frame FROM f),
    bad AS (
      SELECT video_id, 'shot range is empty' AS c FROM late WHERE hi <= lo2
      UNION ALL SELECT video_id, 'shot ranges are not contiguous' FROM late WHERE lo2 <> lo
      UNION ALL SELECT video_id, 'shot without one representative' FROM chosen WHERE n <> 1
      UNION ALL SELECT video_id, 'supplemental representative' FROM f WHERE frame_id % 4 <> 0 AND value_ms % 41 = 0
      UNION ALL SELECT video_id, 'keyframe_id does not name its frame' FROM f WHERE value_ms % 43 = 0
      UNION ALL SELECT video_id, 'keyframe_id repeats' FROM (SELECT video_id, frame FROM named GROUP BY ALL HAVING count(*) > 1)
      UNION ALL SELECT video_id, 'text of an unknown keyframe' FROM (SELECT video_id, frame_id + CASE WHEN value_ms % 47 = 0 THEN 100000 ELSE 0 END AS frame FROM f) x WHERE NOT EXISTS (SELECT 1 FROM named n WHERE n.video_id = x.video_id AND n.frame = x.frame)
      UNION ALL SELECT video_id, 'shot without one caption' FROM g WHERE v % 53 = 0
      UNION ALL SELECT DISTINCT video_id, 'scene without one summary' FROM g WHERE shot // 3 = 3
      UNION ALL SELECT video_id, 'scene mapping is incomplete' FROM late WHERE lost
      UNION ALL SELECT video_id, 'scene does not count its shots' FROM late GROUP BY video_id, shot // 3 HAVING bool_or(lost)
      UNION ALL SELECT video_id, 'scene range differs from its shots' FROM late GROUP BY video_id, shot // 3 HAVING min(lo2) FILTER (NOT lost) <> min(lo) OR max(hi) FILTER (NOT lost) <> max(hi)
      UNION ALL SELECT f.video_id, 'keyframe outside its shot' FROM f JOIN late l ON l.video_id = f.video_id AND l.shot = f.shot WHERE frame_id < lo2
      UNION ALL SELECT c.video_id, 'caption of another representative' FROM chosen c JOIN g ON g.video_id = c.video_id AND g.shot = c.shot WHERE v % 53 <> 0 AND kf <> c.video_id || ':' || (c.shot * 4))
    SELECT video_id, c AS "check", count(*) AS violations FROM bad GROUP BY video_id, c""")
def package_invariants(t):
    """Every invariant of the packages in one scan, a row per video and failed check."""
    return checks.package_invariants(*_package(t))


# ---- scores of vectors stored in half precision

_HALF = "CASE WHEN {x} = 0 THEN 0 ELSE round_even({x} / pow(2, greatest(floor(log2(abs({x}))), -14) - 10), 0) * pow(2, greatest(floor(log2(abs({x}))), -14) - 10) END"


def _half_sql(x: str) -> str:
    return _HALF.replace("{x}", x)


def _scores_sql(q: str) -> str:
    products = f"list_transform(range(1, len(h) + 1), lambda i: CAST(h[i] AS FLOAT) * CAST({q}[i] AS FLOAT))"
    return f"list_reduce(list_prepend(0::FLOAT, {products}), lambda s, x: CAST(s + x AS FLOAT))::DOUBLE"


_HALF_SQL = f"""
    WITH k AS (SELECT video_id, vector_id, list_transform(embedding, lambda x: {_half_sql('x::DOUBLE')}) AS h FROM {{keyframes}}),
    q AS (SELECT any_value(h) FILTER (vector_id = 7) AS qa, any_value(h) FILTER (vector_id = 11) AS qb FROM k),
    s AS (SELECT video_id, vector_id, row_number() OVER (PARTITION BY video_id ORDER BY vector_id) - 1 AS i, {_scores_sql('qa')} AS a, {_scores_sql('qb')} AS b FROM k, q),
    r AS (SELECT video_id, vector_id, i, {_half_sql('a')} AS a, {_half_sql('b')} AS b FROM s)"""


def _half_scores(t):
    return events.scored(t("keyframes"), [t.vector(7), t.vector(11)], half=True)


@query(_HALF_SQL + " SELECT video_id, vector_id, a AS first_score, b AS second_score, dense_rank() OVER (ORDER BY a DESC) AS first_rank FROM r QUALIFY first_rank <= 100")
def event_half_scores(t):
    """Scores of two events as half-precision vectors give them, ties and all: the hundred best different scores of the first."""
    d = _half_scores(t).select("video_id", "vector_id", F.col("s")[0].alias("first_score"), F.col("s")[1].alias("second_score"))
    # ranks of different scores: the distinct ones are few, as half precision has few numbers
    best = d.select("first_score").distinct().orderBy(F.desc("first_score")).limit(100)
    ranks = best.agg(F.sort_array(F.collect_list("first_score"), asc=False).alias("all")).select(F.posexplode("all").alias("k", "first_score"))
    return d.join(F.broadcast(ranks), "first_score").select("video_id", "vector_id", "first_score", "second_score", (F.col("k") + 1).alias("first_rank"))


@query(_HALF_SQL + """
    , p AS (SELECT x.video_id, x.i AS i, y.i AS j, x.a + y.b AS score FROM r x JOIN r y ON x.video_id = y.video_id AND y.i > x.i)
    SELECT video_id, score, i::VARCHAR || ',' || j::VARCHAR AS path FROM p QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY score DESC, j, i) = 1""")
def event_half_paths(t):
    """The best chain of two events per video on half-precision scores."""
    d = events.best_paths(_half_scores(t), 2, "sum")
    return d.select("video_id", "score", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))
