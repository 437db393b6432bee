"""Evidence per shot and scene over the events: every twenty events of a user are a shot, each event a frame of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.operators import evidence
from skerry.queries.base import query

_EVALUATED_SQL = """
    (SELECT video_id::VARCHAR || ':' || (frame_id // 20)::VARCHAR AS shot_id, ['early', 'middle', 'late'][value_ms // 10 % 3 + 1] AS role, value_ms // 10 % 2 AS round, frame_id, (frame_id // 20) * 20 + [3, 10, 17][value_ms // 10 % 3 + 1] AS target_frame,
            (frame_id // 20) * 20 + 9.5::DOUBLE AS center, (value_ms // 10 % 20) / 20.0::DOUBLE AS quality, value_ms // 10 % 5 <> 0 AS valid FROM {timeline}) e"""


def evaluated(t):
    v = F.floor(F.col("value_ms") / 10)
    k, shot = (v % 3).cast("int"), F.floor(F.col("frame_id") / 20)
    return t("timeline").select(
        F.concat_ws(":", "video_id", shot).alias("shot_id"), F.get(F.array(*[F.lit(r) for r in ("early", "middle", "late")]), k).alias("role"), (v % 2).alias("round"), "frame_id",
        (shot * 20 + F.get(F.array(F.lit(3), F.lit(10), F.lit(17)), k)).alias("target_frame"), (shot * 20 + 9.5).alias("center"), ((v % 20) / 20).alias("quality"), (v % 5 != 0).alias("valid"),
    )


@query(f"""
    WITH b AS (SELECT *, row_number() OVER (PARTITION BY shot_id, role ORDER BY round, quality DESC, abs(frame_id - target_frame), frame_id) AS n FROM {_EVALUATED_SQL} WHERE valid),
    d AS (SELECT shot_id, role, frame_id, quality, center, max(quality) FILTER (role = 'middle') OVER (PARTITION BY shot_id) AS middle, max(quality) OVER (PARTITION BY shot_id) AS top FROM b WHERE n = 1),
    e AS (SELECT *, coalesce(middle >= 0.9::DOUBLE * top, FALSE) AS by_middle, row_number() OVER (PARTITION BY shot_id ORDER BY quality DESC, abs(frame_id - center), frame_id) = 1 AS best FROM d),
    f AS (SELECT *, CASE WHEN by_middle THEN role = 'middle' ELSE best END AS is_representative FROM e)
    SELECT shot_id, role, frame_id, round(quality, 6) AS quality, is_representative, CASE WHEN NOT is_representative THEN 'best_valid_candidate_in_search_band' WHEN by_middle THEN 'middle_within_quality_ratio' ELSE 'highest_quality_fallback' END AS reason FROM f""")
def role_keyframes(t):
    return evidence.role_keyframes(evaluated(t)).withColumn("quality", F.round("quality", 6))


@query(f"SELECT count(DISTINCT shot_id || '/' || frame_id) AS candidates, count(DISTINCT shot_id || '/' || frame_id) FILTER (valid) AS valid_candidates, count(*) AS evaluations, count(*) FILTER (valid) AS valid_evaluations FROM {_EVALUATED_SQL}")
def keyframe_diagnostics(t):
    return evidence.diagnostic_counts(evaluated(t))


ROLE_BANDS = {r: evidence.role_bands(a, b, 0.1, 0.05, 0.95) for r, (a, b) in {"early": (0.1, 0.3), "middle": (0.4, 0.6), "late": (0.7, 0.9)}.items()}
_BANDS_SQL = ", ".join(f"('{r}', {k}, {low!r}::DOUBLE, {high!r}::DOUBLE)" for r, bands in ROLE_BANDS.items() for k, (low, high) in enumerate(bands))


@query(f"""
    WITH v(role, round, low, high) AS (VALUES {_BANDS_SQL}),
    s AS (SELECT video_id::VARCHAR || ':' || shot_index::VARCHAR AS shot_id, shot_index * 250 AS first, shot_index * 250 + frames * 25 - 1 AS last FROM {{shots}}),
    b AS (SELECT shot_id, role, round, first + (last - first) * low AS lo, first + (last - first) * high AS hi FROM s, v),
    n AS (SELECT *, least(5, greatest(1, floor(hi) - ceil(lo) + 1))::BIGINT AS n FROM b),
    p AS (SELECT shot_id, role, round, CASE WHEN n = 1 THEN round_even((lo + hi) / 2, 0) ELSE round_even(lo + (hi - lo) * i / greatest(n - 1, 1), 0) END::BIGINT AS frame_id FROM n, range(5) r(i) WHERE i < n)
    SELECT shot_id, role, frame_id, min(round)::BIGINT AS round FROM p GROUP BY shot_id, role, frame_id""")
def role_candidates(t):
    shots = t("shots").select(F.concat_ws(":", "video_id", "shot_index").alias("shot_id"), (F.col("shot_index") * 250).alias("start_frame"), (F.col("shot_index") * 250 + F.col("frames") * 25).alias("end_frame"))
    return evidence.role_candidates(shots, ROLE_BANDS, 5)


_FRAMES_SQL = """
    (SELECT video_id::VARCHAR || ':' || (frame_id // 20)::VARCHAR AS shot_id, 'k' || event_id::VARCHAR AS keyframe_id, frame_id * 0.5::DOUBLE AS time, frame_id, frame_id % 20 = 7 AS is_representative, value_ms // 10 % 6 = 0 AS is_supplemental,
            value_ms // 10 % 16 * 1000003 AS image, ['pass', 'empty', 'pass', 'failed'][value_ms // 10 % 4 + 1] AS status, CASE WHEN value_ms // 10 % 4 = 1 THEN '' ELSE event_type || ' sign ' || (value_ms // 10 % 3)::VARCHAR END AS words FROM {timeline}) f"""


def frames(t):
    k = F.floor(F.col("value_ms") / 10)
    return t("timeline").select(
        F.concat_ws(":", "video_id", F.floor(F.col("frame_id") / 20)).alias("shot_id"), F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("keyframe_id"), (F.col("frame_id") * 0.5).alias("time"), "frame_id",
        (F.col("frame_id") % 20 == 7).alias("is_representative"), (k % 6 == 0).alias("is_supplemental"), (k % 16 * 1000003).alias("image"), F.get(F.array(*[F.lit(s) for s in ("pass", "empty", "pass", "failed")]), (k % 4).cast("int")).alias("status"),
        F.when(k % 4 == 1, "").otherwise(F.concat_ws(" ", "event_type", F.lit("sign"), (k % 3).cast("string"))).alias("words"),
    )


@query(f"""
    SELECT keyframe_id FROM (SELECT *, row_number() OVER (PARTITION BY shot_id, image, status, words ORDER BY NOT is_representative, time, frame_id) AS n FROM {_FRAMES_SQL}) WHERE n = 1 OR status = 'failed'""")
def distinct_frames(t):
    return evidence.distinct_frames(frames(t)).select("keyframe_id")


@query(f"""
    WITH p AS (SELECT *, lead(keyframe_id) OVER w AS right_id, lead(image) OVER w AS i2, lead(status) OVER w AS s2, lead(words) OVER w AS w2 FROM {_FRAMES_SQL} WINDOW w AS (PARTITION BY shot_id ORDER BY time, frame_id)),
    q AS (SELECT keyframe_id AS left_id, right_id, bit_count(xor(image, i2)) / 64.0::DOUBLE AS visual, list_filter(string_split(lower(words), ' '), lambda x: x <> '') AS a, list_filter(string_split(lower(w2), ' '), lambda x: x <> '') AS b, status <> 'failed' AND s2 <> 'failed' AS ok FROM p WHERE right_id IS NOT NULL),
    r AS (SELECT left_id, right_id, visual, CASE WHEN ok THEN CASE WHEN len(a) = 0 AND len(b) = 0 THEN 0 ELSE 1 - len(list_intersect(a, b)) / greatest(1, len(list_distinct(list_concat(a, b))))::DOUBLE END END AS changed FROM q)
    SELECT left_id, right_id, round(visual, 6) AS visual, round(changed, 6) AS changed, visual >= 0.1 AS crossed_visual, coalesce(changed >= 0.6, FALSE) AS crossed_text, round(greatest(visual, coalesce(changed, 0)), 6) AS strength FROM r""")
def change_signals(t):
    d = evidence.pair_signals(frames(t), 0.1, 0.6).drop("shot_id", "time", "frame_id")
    return d.withColumns({c: F.round(c, 6) for c in ("visual", "changed", "strength")})


@query(f"""
    WITH f AS (SELECT * FROM {_FRAMES_SQL}),
    d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shot_id, image, status, words ORDER BY NOT is_representative, time, frame_id) AS n FROM f) WHERE n = 1 OR status = 'failed'),
    p AS (SELECT *, lead(keyframe_id) OVER w AS right_id, lead(image) OVER w AS i2, lead(status) OVER w AS s2, lead(words) OVER w AS w2 FROM d WINDOW w AS (PARTITION BY shot_id ORDER BY time, frame_id)),
    q AS (SELECT *, bit_count(xor(image, i2)) / 64.0::DOUBLE AS visual, list_filter(string_split(lower(words), ' '), lambda x: x <> '') AS a, list_filter(string_split(lower(w2), ' '), lambda x: x <> '') AS b FROM p WHERE right_id IS NOT NULL),
    r AS (SELECT *, CASE WHEN status = 'failed' OR s2 = 'failed' THEN NULL WHEN len(a) = 0 AND len(b) = 0 THEN 0 ELSE 1 - len(list_intersect(a, b)) / greatest(1, len(list_distinct(list_concat(a, b))))::DOUBLE END AS changed FROM q),
    g AS (SELECT shot_id, keyframe_id AS left_id, right_id, time, frame_id, visual >= 0.1 AS v, coalesce(changed >= 0.6, FALSE) AS t, greatest(visual, coalesce(changed, 0)) AS strength FROM r),
    ends AS (SELECT shot_id, left_id AS keyframe_id, strength, time, frame_id, 0 AS side FROM g WHERE v OR t UNION ALL SELECT shot_id, right_id, strength, time, frame_id, 1 FROM g WHERE v OR t),
    power AS (SELECT shot_id, keyframe_id, max(strength) AS power FROM ends GROUP BY 1, 2),
    places AS (
      SELECT d.shot_id, d.keyframe_id, CASE WHEN is_representative THEN 0 ELSE 1 END AS tier, CASE WHEN is_representative THEN 0 ELSE coalesce(power, 0) END AS power, time, frame_id, 0 AS side
      FROM d LEFT JOIN power USING (shot_id, keyframe_id) WHERE is_representative OR is_supplemental
      UNION ALL SELECT shot_id, keyframe_id, 2, strength, time, frame_id, side FROM ends
    ),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shot_id, keyframe_id ORDER BY tier, power DESC, time, frame_id, side) AS n FROM places) WHERE n = 1),
    turns AS (SELECT shot_id, keyframe_id, row_number() OVER (PARTITION BY shot_id ORDER BY tier, power DESC, time, frame_id, side, keyframe_id) AS turn FROM firsts),
    several AS (SELECT shot_id, count(*) AS n, string_agg(keyframe_id, ',' ORDER BY time, frame_id, keyframe_id) AS ids FROM turns JOIN d USING (shot_id, keyframe_id) WHERE turn <= 4 GROUP BY shot_id),
    kinds AS (SELECT shot_id, count(*) AS n, bool_or(is_supplemental) AS s FROM d GROUP BY shot_id), crossed AS (SELECT shot_id, bool_or(v) AS v, bool_or(t) AS t FROM g GROUP BY shot_id),
    h AS (SELECT shot_id, max(time) - min(time) >= 3 AS long_, min(keyframe_id) FILTER (is_representative) AS one FROM f GROUP BY shot_id),
    m AS (
      SELECT shot_id, one, several.n AS taken, ids, CASE WHEN kinds.n >= 2 THEN concat_ws(',', CASE WHEN s THEN 'meaningful_supplemental' END, CASE WHEN long_ AND v THEN 'visual_change' END, CASE WHEN long_ AND t THEN 'ocr_change' END) ELSE '' END AS reasons
      FROM h JOIN kinds USING (shot_id) LEFT JOIN crossed USING (shot_id) LEFT JOIN several USING (shot_id) WHERE one IS NOT NULL
    ), z AS (SELECT *, reasons <> '' AND coalesce(taken, 0) >= 2 AS dynamic FROM m)
    SELECT shot_id, CASE WHEN dynamic THEN 'temporal_storyboard' ELSE 'representative_only' END AS mode, CASE WHEN dynamic THEN reasons ELSE '' END AS reasons, CASE WHEN dynamic THEN ids ELSE one END AS sources FROM z""")
def caption_modes(t):
    f = frames(t)
    shots = f.groupBy("shot_id").agg(F.min("time").alias("start_sec"), F.max("time").alias("end_sec"))
    d = evidence.caption_modes(shots, f, 0.1, 0.6, 3.0, 4)
    return d.withColumn("reasons", F.array_join("reasons", ",")).withColumn("sources", F.array_join("sources", ","))


@query(f"""
    WITH f AS (SELECT shot_id, min(time) AS s, max(time) + 0.5 AS e, list({{'k': keyframe_id, 't': time, 's': status, 'w': words}} ORDER BY time, frame_id) AS x FROM {_FRAMES_SQL} GROUP BY shot_id),
    p AS (SELECT shot_id, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM f)
    SELECT f.shot_id, any_value('CAPTION_MODE: storyboard' || chr(10) || 'SHOT_ID: ' || f.shot_id || chr(10) || 'SHOT_TIME: ' || printf('%.6f-%.6f', s, e) || chr(10) || 'SOURCE_FRAME_COUNT: ' || len(x) || chr(10) || chr(10) || 'ORDERED_SOURCE_FRAMES:')
           || string_agg(chr(10) || chr(10) || printf('FRAME_%02d', i) || chr(10) || 'KEYFRAME_ID: ' || y.k || chr(10) || printf('TIMESTAMP_SEC: %.6f', y.t) || chr(10) || 'OCR_STATUS: ' || y.s || chr(10) || 'OCR_TEXT: ' || CASE WHEN y.s = 'failed' THEN '<UNAVAILABLE>' WHEN y.w <> '' THEN y.w ELSE '<NONE>' END, '' ORDER BY i) AS body
    FROM f JOIN p USING (shot_id) GROUP BY f.shot_id""")
def evidence_bodies(t):
    f = frames(t).groupBy("shot_id").agg(F.min("time").alias("s"), (F.max("time") + 0.5).alias("e"), F.array_sort(F.collect_list(F.struct("time", "frame_id", "keyframe_id", "status", "words"))).alias("frames"))
    return f.select("shot_id", evidence.evidence_body(F.col("shot_id"), F.col("s"), F.col("e"), F.lit("storyboard"), F.col("frames")).alias("body"))


@query("""
    SELECT vector_id, video_id, author, (SELECT string_agg(entity || ':' || printf('%.4f', score) || ':' || rank, ',' ORDER BY score DESC, rank, entity) FROM {detections} WHERE detections.vector_id = keyframes.vector_id) AS detections
    FROM {keyframes} JOIN (SELECT video_id AS v, author FROM {videos}) a ON v = video_id""")
def keyframe_details(t):
    d = evidence.details(t("keyframes").select("vector_id", "video_id"), t("videos").select("video_id", "author"), t("detections"))
    shown = F.array_join(F.transform("detections", lambda x: F.format_string("%s:%.4f:%d", x["entity"], x["score"], x["rank"])), ",")
    return d.select("vector_id", "video_id", "author", F.nullif(shown, F.lit("")).alias("detections"))


@query(f"""
    SELECT s.shot_id, coalesce(string_agg(f.keyframe_id, ',' ORDER BY f.time, f.frame_id), '') AS frames, coalesce(string_agg(f.words, ' ' ORDER BY f.time, f.keyframe_id) FILTER (f.status <> 'failed'), '') AS transcript
    FROM (SELECT DISTINCT shot_id FROM {_FRAMES_SQL}) s LEFT JOIN (SELECT * FROM {_FRAMES_SQL} WHERE words <> '') f ON f.shot_id = s.shot_id GROUP BY s.shot_id""")
def shot_records(t):
    f = frames(t)
    some = f.filter("words <> ''")
    words = some.filter("status <> 'failed'").select("shot_id", F.col("time").alias("start_sec"), F.col("keyframe_id").alias("word_id"), F.col("words").alias("text"))
    d = evidence.shot_records(f.select("shot_id").distinct(), some, words)
    return d.select("shot_id", F.array_join(F.transform("frames", lambda x: x["keyframe_id"]), ",").alias("frames"), "transcript")


@query(f"""
    WITH w AS (SELECT shot_id, time, keyframe_id, trim(words) AS w FROM {_FRAMES_SQL} WHERE words <> ''), k AS (SELECT *, sum(length(w) + 1) OVER (PARTITION BY shot_id ORDER BY time, keyframe_id) - 1 AS used FROM w),
    x AS (SELECT shot_id, string_agg(w, ' ' ORDER BY time, keyframe_id) AS transcript FROM k WHERE used <= 60 GROUP BY shot_id), s AS (SELECT shot_id, min(time) AS a, max(time) AS b FROM {_FRAMES_SQL} GROUP BY shot_id),
    y AS (SELECT s.*, CASE WHEN length(s.shot_id) % 2 = 0 THEN coalesce(transcript, '') ELSE '' END AS transcript, CASE WHEN length(s.shot_id) % 2 = 1 THEN 'no_speech' WHEN s.shot_id IN (SELECT shot_id FROM w) THEN 'available' ELSE 'unavailable' END AS status FROM s LEFT JOIN x USING (shot_id))
    SELECT shot_id AS scene_id, status, transcript, 'SCENE_ID: ' || shot_id || chr(10) || 'TIME: ' || printf('%.3f-%.3f', a, b) || chr(10) || 'CANONICAL_TRANSCRIPT:' || chr(10) || CASE WHEN transcript = '' THEN '<UNAVAILABLE>' ELSE transcript END AS body FROM y""")
def speech_summaries(t):
    f = frames(t)
    s = f.groupBy(F.col("shot_id").alias("scene_id")).agg(F.min("time").alias("start_sec"), F.max("time").alias("end_sec")).withColumn("asr_status", F.when(F.length("scene_id") % 2 == 1, "no_audio").otherwise("pass"))
    w = f.filter("words <> ''").select(F.col("shot_id").alias("scene_id"), F.col("keyframe_id").alias("word_id"), F.col("time").alias("start_sec"), F.col("words").alias("text"))
    return evidence.speech_summaries(s, w, 60).drop("fingerprint")


@query("""
    WITH x AS (SELECT user_id, event_id, CASE WHEN event_id % 7 = 0 THEN 'failed' ELSE 'pass' END AS status, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS a, CASE WHEN event_id % 2 = 0 THEN ' raw ' END AS b FROM events)
    SELECT user_id AS keyframe_id, arg_max(trim(coalesce(nullif(a, ''), b)), event_id) AS text FROM x WHERE status <> 'failed' AND trim(coalesce(nullif(a, ''), b, '')) <> '' GROUP BY 1""")
def texts_by_keyframe(t):
    n = F.col("event_id")
    d = t("events").select(F.col("user_id").alias("keyframe_id"), n.alias("pos"), F.when(n % 7 == 0, "failed").otherwise("pass").alias("status"), F.when(n % 3 == 0, "").otherwise(F.col("event_type")).alias("text"), F.when(n % 2 == 0, " raw ").alias("raw_text"))
    return evidence.texts_by_keyframe(d)


@query("SELECT video_id, video_id::VARCHAR || '_SH00000' AS shot_id, 0::BIGINT AS start_frame, count(*) AS end_frame, 0.0::DOUBLE AS start_sec, max(frame_id) * 0.5::DOUBLE + 0.5 AS end_sec FROM {timeline} GROUP BY video_id")
def whole_video_shots(t):
    return evidence.whole_video(t("timeline").select("video_id", "frame_id", (F.col("frame_id") * 0.5).alias("pts_time"), F.lit(0.5).alias("duration_time")))


@query("""
    SELECT video_id, frame_id AS pos, event_type AS text, printf('%d_A%05d', video_id, frame_id) AS segment_id, coalesce(s < before, FALSE) AS backwards
    FROM (SELECT *, value_ms % 9 + frame_id AS s, lag(value_ms % 9 + frame_id) OVER (PARTITION BY video_id ORDER BY frame_id) AS before FROM {timeline}) WHERE value_ms % 4 <> 0""")
def numbered_segments(t):
    d = t("timeline").select("video_id", F.col("frame_id").alias("pos"), (F.col("value_ms") % 9 + F.col("frame_id")).alias("start_sec"), F.lit(0).alias("end_sec"), F.when(F.col("value_ms") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "event_type")).alias("text"))
    return evidence.numbered_segments(d).select("video_id", "pos", "text", "segment_id", "backwards")
