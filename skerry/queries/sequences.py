"""Runs, packed intervals, windows of gaps, folds, and statistics of partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.operators import aggregates, sequences
from skerry.queries.base import query

#: Events as frames: pts two fifths of a second apart and more, in tenths by the value.
_FRAMES_SQL = "(SELECT video_id, frame_id, frame_id * 0.4::DOUBLE + (value_ms % 3) / 10.0::DOUBLE AS pts_time, CASE WHEN value_ms % 11 = 0 THEN -0.1::DOUBLE ELSE 0.4::DOUBLE END AS duration_time, value FROM {timeline}) f"


def _frames(t):
    return t("timeline").select(
        "video_id", "frame_id", (F.col("frame_id") * 0.4 + (F.col("value_ms") % 3) / 10).alias("pts_time"), F.when(F.col("value_ms") % 11 == 0, -0.1).otherwise(0.4).alias("duration_time"), "value"
    )


@query(f"SELECT video_id, frame_id, round(coalesce(lead(pts_time) OVER (PARTITION BY video_id ORDER BY frame_id), pts_time + duration_time), 6) AS end_sec FROM {_FRAMES_SQL}")
def lead_end_times(t):
    return sequences.end_times(_frames(t)).select("video_id", "frame_id", F.round("end_sec", 6).alias("end_sec"))


_RUNS_SQL = """
    WITH x AS (SELECT video_id, frame_id, frame_id - row_number() OVER (PARTITION BY video_id ORDER BY frame_id) AS island FROM {timeline} WHERE value > 60),
    runs AS (SELECT video_id, min(frame_id) AS first, max(frame_id) AS last, count(*) AS length FROM x GROUP BY video_id, island),
    ends AS (SELECT video_id, min(frame_id) AS lo, max(frame_id) AS hi FROM {timeline} GROUP BY video_id)"""


@query(_RUNS_SQL + " SELECT * FROM runs")
def value_runs(t):
    return sequences.runs(t("timeline"), "video_id", "frame_id", F.col("value") > 60)


@query(_RUNS_SQL + " SELECT video_id, coalesce(max(length), 0)::BIGINT AS longest FROM ends LEFT JOIN runs USING (video_id) GROUP BY video_id")
def longest_run(t):
    return sequences.longest_run(t("timeline"), "video_id", "frame_id", F.col("value") > 60)


@query(_RUNS_SQL + """
    , marks AS (SELECT video_id, (first + last) // 2 AS end_frame FROM runs JOIN ends USING (video_id) WHERE first > lo AND last < hi UNION ALL SELECT video_id, hi FROM ends)
    SELECT m.video_id, coalesce(lag(end_frame) OVER (PARTITION BY m.video_id ORDER BY end_frame) + 1, lo) AS start_frame, end_frame FROM marks m JOIN ends ON ends.video_id = m.video_id""")
def cut_islands(t):
    return sequences.cuts(t("timeline").select("video_id", "frame_id", "value"), 60)


def _marked(t):
    """Shots with a boundary after each whose number of frames and index say so."""
    return t("shots").withColumns({"start_sec": F.col("start_sec").cast("double"), "end_sec": F.col("end_sec").cast("double"), "boundary": (F.col("shot_index") + F.col("video_id")) % 3 != 0})


_MARKED_SQL = "(SELECT video_id, shot_index, start_sec::DOUBLE AS start_sec, end_sec::DOUBLE AS end_sec, frames, (shot_index + video_id) % 3 <> 0 AS boundary FROM {shots}) shots"
_SCENES_SQL = f"""
    SELECT video_id, scene_index, min(shot_index) AS start_shot, max(shot_index) AS end_shot, min(start_sec) AS start_sec, max(end_sec) AS end_sec, sum(frames)::BIGINT AS frames, count(*) AS shot_count,
           max(end_sec) - min(start_sec) AS duration_sec
    FROM (SELECT *, coalesce(sum(boundary::INT) OVER (PARTITION BY video_id ORDER BY shot_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS scene_index FROM {_MARKED_SQL}) GROUP BY video_id, scene_index"""


@query(_SCENES_SQL)
def partition_scenes(t):
    return sequences.partitioned(_marked(t))


@query(f"""
    WITH shots AS (SELECT * FROM {_MARKED_SQL}), scenes AS ({_SCENES_SQL}),
    gaps AS (SELECT * FROM (SELECT *, max(shot_index) OVER (PARTITION BY video_id) AS last FROM shots) WHERE shot_index < last),
    runs AS (SELECT video_id, count(*) AS length FROM (SELECT video_id, shot_index - row_number() OVER (PARTITION BY video_id ORDER BY shot_index) AS island FROM gaps WHERE boundary) GROUP BY video_id, island),
    longest AS (SELECT video_id, max(length) AS longest FROM runs GROUP BY video_id),
    a AS (SELECT video_id, count(*) AS shot_count FROM shots GROUP BY video_id), b AS (SELECT video_id, count(*) FILTER (boundary) AS boundary_count FROM gaps GROUP BY video_id),
    c AS (SELECT video_id, count(*) AS scene_count, count(*) FILTER (shot_count = 1) AS one_shot, median(shot_count)::DOUBLE AS median_shots, round(avg(duration_sec), 6) AS mean_duration, median(duration_sec) AS median_duration FROM scenes GROUP BY video_id),
    d AS (SELECT video_id, shot_count, coalesce(boundary_count, 0)::BIGINT AS boundary_count, scene_count, one_shot, median_shots, mean_duration, median_duration, coalesce(longest, 0)::BIGINT AS longest,
                 CASE WHEN shot_count > 1 THEN coalesce(boundary_count, 0) / (shot_count - 1)::DOUBLE ELSE 0 END AS density, one_shot / scene_count::DOUBLE AS rate
          FROM a LEFT JOIN b USING (video_id) LEFT JOIN c USING (video_id) LEFT JOIN longest USING (video_id))
    SELECT * EXCLUDE (density, rate), round(density, 6) AS boundary_density, round(rate, 6) AS one_shot_rate,
           shot_count >= 4 AND ((shot_count > 1 AND boundary_count = shot_count - 1) OR (density >= 0.8 AND rate >= 0.7)) AS suspicious FROM d""")
def partition_quality(t):
    d = aggregates.partition_quality(_marked(t), sequences.partitioned(_marked(t)))
    return d.withColumns({c: F.round(c, 6) for c in ("mean_duration", "boundary_density", "one_shot_rate")})


@query("""
    WITH c AS (SELECT video_id, count(*) - 1 AS gaps FROM {shots} GROUP BY video_id HAVING count(*) > 1),
    w AS (SELECT *, unnest(range(0, gaps, 6)) AS first_gap FROM c)
    SELECT video_id, first_gap // 6 AS "window", first_gap, least(first_gap + 8, gaps) - 1 AS last_gap, greatest(0, first_gap - 4) AS first_shot, least(gaps, least(first_gap + 8, gaps) + 4) AS last_shot
    FROM w WHERE first_gap = 0 OR first_gap - 6 + 8 < gaps""")
def focus_windows(t):
    return sequences.focus_windows(t("shots").groupBy("video_id").agg(F.count(F.lit(1)).alias("shots")))


def _votes(t):
    """Three votes for each gap, by the digits of the events of a user."""
    d = t("timeline").select("video_id", F.floor(F.col("frame_id") / 3).alias("gap"), (F.col("frame_id") % 3).alias("place"), (F.col("value_ms") % 2 == 0).alias("boundary"))
    return d.withColumn("weight", sequences.vote_weight(F.col("place"), F.lit(3)))


_VOTES_SQL = "(SELECT video_id, frame_id // 3 AS gap, frame_id % 3 AS place, value_ms % 2 = 0 AS boundary, 1 + least(frame_id % 3, 2 - frame_id % 3) / 1.0::DOUBLE AS weight FROM {timeline}) votes"
_SCORES_SQL = f"""
    SELECT video_id, gap, count(*) AS votes, coalesce(sum(weight) FILTER (boundary), 0) AS true_weight, coalesce(sum(weight) FILTER (NOT boundary), 0) AS false_weight,
           round(coalesce(sum(weight) FILTER (boundary), 0) / sum(weight), 6) AS score,
           CASE WHEN coalesce(sum(weight) FILTER (boundary), 0) / sum(weight) >= 0.67 THEN 'boundary' WHEN coalesce(sum(weight) FILTER (boundary), 0) / sum(weight) <= 0.33 THEN 'same' ELSE 'review' END AS route
    FROM {_VOTES_SQL} GROUP BY video_id, gap"""


@query(_SCORES_SQL)
def vote_scores(t):
    return sequences.voted(_votes(t)).withColumn("score", F.round("score", 6))


_TRIGGER_SQL = f"""
    WITH g AS (SELECT video_id, gap, score >= 0.5 AS boundary FROM ({_SCORES_SQL})),
    x AS (SELECT *, coalesce(boundary AND (lag(boundary) OVER o OR lead(boundary) OVER o), FALSE) AS next_to, count(*) OVER (PARTITION BY video_id) AS n,
                 sum(boundary::INT) OVER (o ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS found FROM g WINDOW o AS (PARTITION BY video_id ORDER BY gap)),
    y AS (SELECT *, (gap + 3 <= n OR gap = 0) AND found >= 2 AS dense FROM x),
    z AS (SELECT *, bool_or(dense) OVER (PARTITION BY video_id ORDER BY gap ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS in_dense FROM y),
    hits AS (SELECT video_id, gap FROM z WHERE next_to OR in_dense UNION SELECT video_id, gap FROM {_VOTES_SQL} GROUP BY video_id, gap HAVING count(*) >= 2 AND count(DISTINCT boundary) = 2)"""


def _triggered(t):
    gaps = sequences.voted(_votes(t)).select("video_id", "gap", (F.round("score", 6) >= 0.5).alias("boundary"))
    return sequences.triggered(gaps, _votes(t))


@query(_TRIGGER_SQL + " SELECT * FROM hits")
def dense_triggers(t):
    return _triggered(t)


def _counts(t):
    return t("timeline").groupBy("video_id").agg((F.floor(F.max("frame_id") / 3) + 2).alias("shots"))


_REGIONS_SQL = _TRIGGER_SQL + """
    , p AS (SELECT h.video_id, greatest(0, gap - 1) AS s, least(top, gap + 1) AS e FROM (SELECT video_id, gap FROM hits) h JOIN (SELECT video_id, max(frame_id) // 3 AS top FROM {timeline} GROUP BY video_id) c USING (video_id)),
    q AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM p),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM q),
    regions AS (SELECT video_id, min(s) AS s, max(e) AS e, count(*) AS parts FROM r GROUP BY video_id, island)"""


def _regions(t):
    return sequences.review_regions(_triggered(t), _counts(t), 1)


@query(_REGIONS_SQL + ' SELECT video_id, s AS "start", e AS "end", parts FROM regions')
def review_regions(t):
    return _regions(t)


@query(_REGIONS_SQL + """ SELECT video_id, s AS "start", e AS "end", parts, unnest(range(s, e + 1, 2)) AS piece_start, least(e, unnest(range(s, e + 1, 2)) + 1) AS piece_end FROM regions""")
def region_pieces(t):
    return sequences.chunks_of(_regions(t), 2)


@query("""
    WITH e AS (SELECT user_id, ts, ts + to_milliseconds(CAST(floor(value * 60000) AS BIGINT)) AS till FROM events),
    q AS (SELECT *, CASE WHEN ts <= max(till) OVER (PARTITION BY user_id ORDER BY ts, till ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM e),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, till ROWS UNBOUNDED PRECEDING) AS island FROM q)
    SELECT user_id, epoch_us(min(ts)) // 1000 AS ts, epoch_us(max(till)) // 1000 AS till, count(*) AS parts FROM r GROUP BY user_id, island""")
def merge_intervals(t):
    """Unions of the spans of a user's events, each as many minutes long as its value."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    d = t("events").select("user_id", ms.alias("ts"), (ms + F.floor(F.col("value") * 60000)).alias("till"))
    return sequences.merged(d, "user_id", "ts", "till", 0)


@query("""
    WITH r AS (SELECT event_id, (frame_id * 0.5)::DOUBLE AS s, frame_id * 0.5::DOUBLE + (value_ms % 100) / 4.0::DOUBLE AS e FROM {timeline}),
    n AS (SELECT *, CASE WHEN e - s <= 10 THEN 1 ELSE greatest(ceil((e - s - 10) / 8.0::DOUBLE), 0) + 1 END::BIGINT AS pieces FROM r),
    p AS (SELECT *, unnest(range(0, pieces)) AS k FROM n)
    SELECT event_id, k, s + k * 8 AS "start", least(e, s + k * 8 + 10) AS "end", pieces > 1 AS forced, CASE WHEN k > 0 THEN 2.0 ELSE 0.0 END::DOUBLE AS overlap FROM p""")
def split_ranges(t):
    start = F.col("frame_id") * 0.5
    d = t("timeline").select("event_id", start.alias("s"), (start + (F.col("value_ms") % 100) / 4).alias("e"))
    return d.select("event_id", F.posexplode(sequences.split_long(F.col("s"), F.col("e"), 10.0, 2.0)).alias("k", "p")).select("event_id", "k", "p.*")


@query("""
    WITH RECURSIVE o AS (
      SELECT video_id, start_sec::DOUBLE AS s, end_sec::DOUBLE AS e, row_number() OVER (PARTITION BY video_id ORDER BY start_sec, end_sec) AS k FROM {segments} WHERE end_sec - start_sec >= 0.6
    ), r AS (
      SELECT video_id, k, s, e, 0 AS piece FROM o WHERE k = 1
      UNION ALL
      SELECT o.video_id, o.k, CASE WHEN o.s - r.e <= 0.5 AND o.e - r.s <= 12 THEN r.s ELSE o.s END, o.e, r.piece + CASE WHEN o.s - r.e <= 0.5 AND o.e - r.s <= 12 THEN 0 ELSE 1 END
      FROM r JOIN o ON o.video_id = r.video_id AND o.k = r.k + 1
    ), p AS (SELECT video_id, min(s) AS s, arg_max(e, k) AS e FROM r GROUP BY video_id, piece),
    q AS (SELECT *, e - s > 12 AS forced, unnest(range(0, CASE WHEN e - s > 12 THEN greatest(ceil((e - s - 12) / 11.0), 0)::BIGINT + 1 ELSE 1 END)) AS k FROM p),
    c AS (SELECT video_id, k, s + k * 11.0::DOUBLE AS start_sec, CASE WHEN forced THEN least(e, s + k * 11.0::DOUBLE + 12.0::DOUBLE) ELSE e END AS end_sec, forced, CASE WHEN forced AND k > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS overlap FROM q),
    n AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_sec) - 1 AS segment_index FROM c)
    SELECT video_id, start_sec, end_sec, forced, overlap, segment_index FROM n WHERE end_sec - start_sec >= 0.6""")
def packed_ranges(t):
    d = t("segments").select("video_id", F.col("start_sec").cast("double").alias("start_sec"), F.col("end_sec").cast("double").alias("end_sec"))
    return sequences.packed(d, 12.0, 0.5, 1.0, 0.6)


@query("""
    WITH g AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t, lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS next_time FROM events)
    SELECT user_id, event_id, next_time - t AS gap, row_number() OVER (PARTITION BY user_id ORDER BY next_time - t DESC, t, event_id) AS position FROM g WHERE next_time IS NOT NULL""")
def gap_order(t):
    d = t("events").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    return sequences.gaps_by_size(d, "user_id", "at", "event_id").select("user_id", "event_id", "gap", "position")


@query()
def probe_plan(t):
    d = t("timeline").withColumn("shot_id", F.concat_ws(":", "video_id", F.floor(F.col("frame_id") / 20)))
    d = d.groupBy("shot_id").agg(F.array_sort(F.collect_list(F.col("frame_id") + (F.col("value_ms") % 7) / 10)).alias("times"))
    return sequences.bisection(d, 4.0, 6).withColumn("probes", F.array_join(F.transform("probes", lambda x: F.format_string("%.1f", x)), ","))


@query()
def novelty_picks(t):
    d = t("timeline").select(F.concat_ws(":", "video_id", F.floor(F.col("frame_id") / 20)).alias("shot_id"), F.col("frame_id").cast("double").alias("time"), F.xxhash64("value").alias("signature"))
    return sequences.novel(d, 2.0, 0.45, 4)


@query(f"""
    WITH s AS (SELECT video_id, pts_time - lag(pts_time) OVER (PARTITION BY video_id ORDER BY frame_id) AS step FROM {_FRAMES_SQL} WHERE video_id % 2 = 0 OR frame_id % 2 >= 0),
    a AS (SELECT video_id, count(*) AS n, list_sort(list(step) FILTER (step > 0)) AS steps FROM s GROUP BY video_id), m AS (SELECT *, steps[len(steps) // 2 + 1] AS middle FROM a)
    SELECT video_id, CASE WHEN n >= 3 AND len(steps) >= 2 THEN list_bool_or(list_transform(steps, lambda x: abs(x - middle) > greatest(0.01::DOUBLE * greatest(abs(x), abs(middle)), 0.0001::DOUBLE))) END AS variable FROM m""")
def vfr_flag(t):
    return sequences.variable_rate(_frames(t))


@query(f"""
    SELECT video_id, count(*) FILTER (frame_id <> expected) AS misnumbered, count(*) FILTER (pts_time < before) AS backwards, count(*) FILTER (duration_time < 0) AS negative
    FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_id) - 1 AS expected, lag(pts_time) OVER (PARTITION BY video_id ORDER BY frame_id) AS before FROM (SELECT * FROM {_FRAMES_SQL} WHERE frame_id % 10 <> 9)) GROUP BY video_id""")
def timeline_faults(t):
    return sequences.timeline_faults(_frames(t).filter("frame_id % 10 <> 9"))


@query("""
    SELECT video_id, shot_index FROM (SELECT *, lag(end_sec) OVER (PARTITION BY video_id ORDER BY start_sec, end_sec) AS before FROM (SELECT * FROM {shots} WHERE shot_index % 4 <> 2))
    WHERE abs(start_sec - before) > 0 OR end_sec <= start_sec""")
def chain_faults(t):
    return sequences.chain_faults(t("shots").filter("shot_index % 4 <> 2"), "video_id", "start_sec", "end_sec").select("video_id", "shot_index")


@query("""
    WITH f AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY video_id ORDER BY frame_id) THEN 0 ELSE 1 END AS fresh FROM {timeline}),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id ORDER BY frame_id ROWS UNBOUNDED PRECEDING) AS run FROM f)
    SELECT event_id, count(*) OVER (PARTITION BY video_id, run) AS run_length, count(*) OVER (PARTITION BY video_id, run) > 1 AND event_type <> '' AS rejected FROM r""")
def repetition_gate(t):
    return sequences.repeated_runs(t("timeline"), "video_id", ["frame_id"], F.col("event_type"), 1).select("event_id", "run_length", "rejected")


@query(r"""
    WITH s AS (SELECT conv_id AS video_id, turn AS shot_index, len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '')) % 9 AS words, turn * 10.0::DOUBLE + 1 AS f, turn * 10.0::DOUBLE + 9 AS l, [turn // 2, (turn + 1) // 2] AS segments
               FROM (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn)),
    p AS (SELECT *, lead(words) OVER o AS w2, lead(f) OVER o AS f2, lead(segments) OVER o AS g2, lead(shot_index) OVER o AS n FROM s WINDOW o AS (PARTITION BY video_id ORDER BY shot_index))
    SELECT video_id, shot_index AS gap, words AS left_words, w2 AS right_words, f2 - l AS silence_sec, array_to_string(list_sort(list_intersect(segments, g2)), ',') AS shared_segments, len(list_intersect(segments, g2)) > 0 AS continues,
           CASE WHEN words = 0 AND w2 = 0 THEN 'missing_both_aligned_words' WHEN words = 0 THEN 'missing_left_aligned_words' WHEN w2 = 0 THEN 'missing_right_aligned_words' ELSE 'reliable_words_both_sides' END AS reliability
    FROM p WHERE n IS NOT NULL""")
def speech_gap(t):
    d = t("conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")) % 9
    half = lambda c: F.floor(c / 2)
    d = d.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("shot_index"), words.alias("words"), (F.col("turn") * 10.0 + 1).alias("first_word_sec"), (F.col("turn") * 10.0 + 9).alias("last_word_sec"), F.array(half(F.col("turn")), half(F.col("turn") + 1)).alias("segments"))
    return sequences.speech_gaps(d).withColumn("shared_segments", F.array_join(F.col("shared_segments").cast("array<string>"), ","))


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1 ORDER BY event_id DESC, event_type LIMIT 10")
def history(t):
    return sequences.history(t("events").select("event_type", "event_id"), "event_type", "event_id")


@query(r"""
    WITH t AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn),
    w AS (SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') AS w FROM t),
    l AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM w),
    a AS (SELECT conv_id, turn, turn % 4 <> 3 AS ok, concat_ws(' ', CASE WHEN b IS NOT NULL THEN coalesce(array_to_string(b[greatest(len(b) - 2, 1):], ' '), '') END, text) AS text FROM l),
    p AS (SELECT *, lag(CASE WHEN ok THEN text END) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM a),
    c AS (SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS c, list_filter(regexp_split_to_array(coalesce(before, ''), '\s+'), lambda x: x <> '') AS p FROM p),
    n AS (SELECT *, list_transform(c, lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}_]+', '', 'g')) AS cb, list_transform(p, lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}_]+', '', 'g')) AS pb FROM c),
    o AS (
      SELECT *, CASE WHEN ok THEN coalesce(list_max(list_filter(range(1, least(12, len(p), len(c)) + 1), lambda k:
        list_filter(pb[len(pb) - k + 1:], lambda x: x <> '') = list_filter(cb[1:k], lambda x: x <> '') AND len(list_filter(cb[1:k], lambda x: x <> '')) > 0)), 0) ELSE 0 END AS overlap FROM n
    ) SELECT conv_id AS video_id, turn AS chunk, overlap, coalesce(array_to_string(c[overlap + 1:], ' '), '') AS kept FROM o""")
def trimmed_overlaps(t):
    """Turns as chunks; each but the first is led by the last words of the one before."""
    from pyspark.sql import Window

    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")
    d = t("conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text")).withColumn("w", words)
    before = F.lag("w").over(Window.partitionBy("conv_id").orderBy("turn"))
    d = d.withColumn("text", F.concat_ws(" ", F.array_join(F.slice(before, F.greatest(F.size(before) - 2, F.lit(1)), F.lit(3)), " "), "text"))
    return sequences.trimmed_overlaps(d.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("chunk"), "text", (F.col("turn") % 4 != 3).alias("accepted")))
