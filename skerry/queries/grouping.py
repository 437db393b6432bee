"""Near-duplicate grouping, event sequences, answer rows, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skerry.functions import text as texts
from skerry.operators import dedup, events, ranking, setops
from skerry.queries.base import query
from skerry.queries.ranking import dot_sql

#: No pair of the driver's vectors reaches the production threshold of 0.94, so the queries use a lower one.
THRESHOLD = 0.30


def _text(c) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def _grouped(t):
    pool = ranking.search(t("keyframes").select("vector_id", "embedding"), t.vector(7), 100)
    return dedup.anchored(pool, THRESHOLD)


_POOL_SQL = f"""
    WITH pool AS (
      SELECT vec_id AS vector_id, embedding, {dot_sql(7)} AS score, row_number() OVER (ORDER BY {dot_sql(7)} DESC, vec_id) AS rank FROM embeddings
    ), top AS (SELECT * FROM pool WHERE rank <= 200),
    found AS (
      SELECT a.vector_id, count(*) AS duplicates, arg_min(b.vector_id, b.rank) AS similar_to FROM top a JOIN top b
      ON b.rank < a.rank AND list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= {THRESHOLD}::DOUBLE GROUP BY a.vector_id
    ), grouped AS (
      SELECT vector_id, rank, coalesce(duplicates, 0)::BIGINT AS duplicates, similar_to, score * pow(0.4::DOUBLE, coalesce(duplicates, 0)) AS adjusted FROM top LEFT JOIN found USING (vector_id)
    ), adjusted AS (SELECT *, row_number() OVER (ORDER BY adjusted DESC, rank) AS adjusted_rank FROM grouped),
    trimmed AS (SELECT * FROM adjusted WHERE adjusted_rank <= 100),
    clusters AS (
      SELECT m.similar_to AS anchor, string_agg(m.vector_id::VARCHAR, ',' ORDER BY m.rank) AS members, count(*) AS size
      FROM trimmed m WHERE m.similar_to IN (SELECT vector_id FROM trimmed) GROUP BY m.similar_to
    )"""


@query(_POOL_SQL + " SELECT vector_id, rank, duplicates, similar_to, round(adjusted, 6) AS adjusted, adjusted_rank FROM trimmed")
def anchor_grouping(t):
    return dedup.trimmed(_grouped(t), 100).select("vector_id", "rank", "duplicates", "similar_to", F.round("adjusted", 6).alias("adjusted"), "adjusted_rank")


@query(_POOL_SQL + " SELECT anchor, members, size FROM clusters")
def cluster_view(t):
    return dedup.clusters(dedup.trimmed(_grouped(t), 100)).withColumn("members", _text("members")).orderBy(F.desc("size"), "anchor")


@query(_POOL_SQL + " SELECT vector_id, rank, duplicates FROM trimmed WHERE duplicates > 0")
def demoted_frames(t):
    return dedup.trimmed(_grouped(t), 100).filter("duplicates > 0").select("vector_id", "rank", "duplicates")


@query()
def linkage_clusters(t):
    pool = ranking.search(t("keyframes").select("vector_id", "embedding"), t.vector(7), 100)
    return dedup.linkage_clusters(dedup.linked(pool, THRESHOLD)).withColumn("members", _text("members"))


@query()
def mode_compare(t):
    pool = ranking.search(t("keyframes").select("vector_id", "embedding"), t.vector(7), 100)
    return dedup.mode_counts(dedup.trimmed(dedup.anchored(pool, THRESHOLD), 100), dedup.linked(pool, THRESHOLD))


@query("SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS n FROM documents) WHERE n = 1 OR n_chars < 200")
def exact_dedup(t):
    d = t("documents").select("doc_id", "text", "lang", "n_chars")
    return dedup.exact_first(d, ["text", "lang"], ["doc_id"], F.col("n_chars") >= 200).select("doc_id")


@query(r"""
    WITH d AS (SELECT doc_id, source, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
    p AS (SELECT doc_id, w, lag(doc_id) OVER x AS previous, lag(w) OVER x AS v FROM d WINDOW x AS (PARTITION BY source ORDER BY doc_id))
    SELECT doc_id, previous, round(CASE WHEN len(w) = 0 AND len(v) = 0 THEN 0.0 ELSE 1 - len(list_intersect(w, v)) / greatest(len(list_distinct(list_concat(w, v))), 1)::DOUBLE END, 6) AS distance
    FROM p WHERE previous IS NOT NULL""")
def token_jaccard(t):
    """Distance of the token sets of neighbouring documents of a source."""
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy("doc_id")
    # only ids go through the window; the token sets, as hashes, join by id
    pairs = t("documents").select("doc_id", F.lag("doc_id").over(w).alias("previous")).filter("previous IS NOT NULL")
    sets = t("documents").select("doc_id", F.transform(F.array_distinct(texts.tokens(F.col("text"))), lambda x: F.xxhash64(x)).alias("w"))
    d = pairs.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("previous"), F.col("w").alias("v")), "previous")
    return d.select("doc_id", "previous", F.round(dedup.token_jaccard_distance(F.col("w"), F.col("v")), 6).alias("distance"))


@query("""
    SELECT event_id, round(bit_count(xor(event_id, user_id)) / 64.0::DOUBLE, 6) AS hamming,
           round(CASE WHEN event_id | user_id = 0 THEN 0 ELSE 1 - bit_count(event_id & user_id) / bit_count(event_id | user_id)::DOUBLE END, 6) AS jaccard FROM events""")
def hash_distances(t):
    a, b = F.col("event_id"), F.col("user_id")
    return t("events").select("event_id", F.round(dedup.hamming_ratio(a, b, 64), 6).alias("hamming"), F.round(dedup.bit_jaccard_distance(a, b), 6).alias("jaccard"))


@query("""
    WITH d AS (
      SELECT a.video_id, a.event_id AS candidate_id, b.event_id AS reference_id, abs(a.value - b.value) AS distance
      FROM (SELECT * FROM {timeline}) a JOIN (SELECT * FROM {timeline}) b ON a.video_id = b.video_id WHERE a.event_type = 'view' AND b.event_type <> 'view'
    ) SELECT video_id, candidate_id, round(min(distance), 6) AS distance, arg_min(reference_id, {'d': distance, 'r': reference_id}) AS nearest FROM d GROUP BY video_id, candidate_id""")
def nearest_references(t):
    d = t("timeline")
    a = d.filter("event_type = 'view'").select("video_id", F.col("event_id").alias("candidate_id"), F.col("value").alias("x"))
    b = d.filter("event_type <> 'view'").select("video_id", F.col("event_id").alias("reference_id"), F.col("value").alias("y"))
    return dedup.nearest_references(a, b, "video_id", "x", "y").withColumn("distance", F.round("distance", 6))


# ---- event sequences

EVENT_IDS = (3, 11, 19)


def path_sql(objective: str, penalty: float = 0.005) -> str:
    """Chained running maxima of structs: the oracle of skerry.operators.events.best_paths for the three events."""
    by_min, penalised = events.OBJECTIVES[objective]
    p = f"{penalty if penalised else 0.0}::DOUBLE"
    base = "SELECT video_id, vector_id, row_number() OVER (PARTITION BY video_id ORDER BY vector_id) - 1 AS i, " + ", ".join(f"{dot_sql(v)} AS s{j}" for j, v in enumerate(EVENT_IDS)) + " FROM {keyframes}"
    steps = [f"b0 AS (SELECT *, {{'m': {'s0' if by_min else '0::DOUBLE'}, 's': s0, 'e': -i, 'path': [i]}} AS b FROM base)"]
    for j in range(1, len(EVENT_IDS)):
        lifted = f"{{'m': {f'b.m + {p} * i' if by_min else '0::DOUBLE'}, 's': b.s + {p} * i, 'e': -i, 'path': b.path}}"
        m = f"least(best.m - {p} * i, s{j})" if by_min else "0::DOUBLE"
        steps.append(
            f"m{j} AS (SELECT * EXCLUDE (b), max({lifted}) FILTER (b IS NOT NULL) OVER (PARTITION BY video_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM b{j - 1}), "
            f"b{j} AS (SELECT * EXCLUDE (best), CASE WHEN best IS NOT NULL THEN {{'m': {m}, 's': best.s - {p} * i + s{j}, 'e': -i, 'path': list_append(best.path, i)}} END AS b FROM m{j})"
        )
    final = f"best AS (SELECT video_id, max(b) AS b FROM b{len(EVENT_IDS) - 1} WHERE b IS NOT NULL GROUP BY video_id)"
    return f"WITH base AS ({base}), {', '.join(steps)}, {final}, paths AS (SELECT video_id, {'b.m' if by_min else 'b.s'} AS score, b.s AS total, b.path AS path FROM best)"


def _scores(t):
    return events.scored(t("keyframes"), [t.vector(i) for i in EVENT_IDS])


def _paths(t, objective: str):
    return events.best_paths(_scores(t), len(EVENT_IDS), objective)


def _register_objective(objective: str) -> None:
    def run(t):
        d = events.top_videos(_paths(t, objective), 20)
        return d.select("video_id", F.round("score", 6).alias("score"), F.round("total", 6).alias("total"), _text("path").alias("path"))

    run.__name__ = f"event_{objective}"
    query(path_sql(objective) + " SELECT video_id, round(score, 6) AS score, round(total, 6) AS total, array_to_string(path, ',') AS path FROM paths ORDER BY score DESC, video_id LIMIT 20")(run)


for _objective in events.OBJECTIVES:
    _register_objective(_objective)


@query(f"SELECT event, round(max(s), 6) AS best FROM (SELECT 0::BIGINT AS event, {dot_sql(3)} AS s FROM embeddings UNION ALL SELECT 1, {dot_sql(11)} FROM embeddings UNION ALL SELECT 2, {dot_sql(19)} FROM embeddings) GROUP BY event")
def event_best_single(t):
    return events.best_singles(_scores(t)).withColumn("best", F.round("best", 6))


@query(path_sql("min") + """
    , steps AS (SELECT video_id, unnest(path) AS i, generate_subscripts(path, 1) - 1 AS event FROM paths)
    SELECT video_id, event, i, vector_id, round(CASE event WHEN 0 THEN s0 WHEN 1 THEN s1 ELSE s2 END, 6) AS score FROM steps JOIN base USING (video_id, i)""")
def event_path_scores(t):
    return events.path_scores(_paths(t, "min"), _scores(t)).withColumn("score", F.round("score", 6))


@query(path_sql("sum") + """
    , steps AS (SELECT video_id, unnest(path) AS i, generate_subscripts(path, 1) - 1 AS event FROM paths),
    each AS (SELECT video_id, list(CASE event WHEN 0 THEN s0 WHEN 1 THEN s1 ELSE s2 END ORDER BY event) AS s FROM steps JOIN base USING (video_id, i) GROUP BY video_id)
    SELECT video_id, round(list_sum(s) - 2 * (list_max(s) - list_min(s)), 6) AS spread FROM each""")
def event_spread(t):
    d = events.path_scores(_paths(t, "sum"), _scores(t)).groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event", "score"))), lambda x: x["score"]).alias("s"))
    return d.select("video_id", F.round(events.spread_objective(F.col("s")), 6).alias("spread"))


@query("SELECT video_id, min(vector_id) AS first_id, max(vector_id) AS last_id, count(*) AS frames, max(frame_idx) AS max_frame_idx, max(vector_id) - min(vector_id) + 1 = count(*) AS contiguous FROM {keyframes} GROUP BY video_id")
def slices_contiguity(t):
    return events.slices(t("keyframes"))


def _matches(t):
    """video_id, rank, frames, max_frame_idx of the best paths."""
    from pyspark.sql import Window

    top = events.top_videos(_paths(t, "dante_min"), 20).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "video_id")))
    frames = events.path_scores(top, _scores(t)).join(t("keyframes").select("vector_id", "frame_idx"), "vector_id")
    frames = frames.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event", "frame_idx"))), lambda x: x["frame_idx"]).alias("frames"))
    return top.select("video_id", "rank").join(frames, "video_id").join(events.slices(t("keyframes")).select("video_id", "max_frame_idx"), "video_id")


PINS = [("V003|1", 4000), ("V005|0", 10), ("broken", 5), ("V003|x", 6)]


@query(path_sql("dante_min") + """
    , top AS (SELECT *, row_number() OVER (ORDER BY score DESC, video_id) AS rank FROM paths ORDER BY score DESC, video_id LIMIT 20),
    steps AS (SELECT video_id, unnest(path) AS i, generate_subscripts(path, 1) - 1 AS event FROM top),
    pins(video_id, event, frame) AS (VALUES ('V003', 1, 4000), ('V005', 0, 10)),
    frames AS (SELECT s.video_id, s.event, coalesce(p.frame, k.frame_idx) AS frame FROM steps s JOIN base USING (video_id, i) JOIN (SELECT vector_id, frame_idx FROM {keyframes}) k USING (vector_id)
               LEFT JOIN pins p ON p.video_id = s.video_id AND p.event = s.event)
    SELECT row_number() OVER (ORDER BY top.video_id IN (SELECT video_id FROM pins) DESC, rank) AS position, top.video_id || ',' || string_agg((frame + 1)::VARCHAR, ',' ORDER BY event) AS line
    FROM frames JOIN top USING (video_id) GROUP BY top.video_id, rank""")
def answer_lines(t):
    d = events.pinned(_matches(t), t.rows(PINS, "key string, frame bigint"))
    return events.formatted(d, base=1).select("position", "line")


@query()
def jitter_rows(t):
    return events.spread(_matches(t), 5, 12).withColumn("frames", _text("frames"))


@query("""
    WITH pins AS (SELECT user_id::VARCHAR AS video_id, event_id AS frame, 0 AS source, event_id AS pos FROM events WHERE event_id % 97 = 0),
    both_ AS (SELECT * FROM pins UNION ALL SELECT user_id::VARCHAR, event_id % 500, 1, event_id FROM events),
    firsts AS (SELECT video_id, frame, min({'source': source, 'pos': pos}) AS x FROM both_ GROUP BY video_id, frame)
    SELECT video_id, frame, x.source::BIGINT AS source, x.pos AS pos FROM firsts ORDER BY x.source, x.pos, video_id, frame LIMIT 100""")
def kis_answer_rows(t):
    e = t("events").select(F.col("user_id").cast("string").alias("video_id"), F.col("event_id").alias("frame"), F.col("event_id").alias("pos"))
    return events.answers(e.filter("frame % 97 = 0"), e.withColumn("frame", F.col("frame") % 500))


@query("""
    WITH x AS (SELECT video_id, frame_id // 5 AS piece, frame_id % 5 AS i, count(*) OVER (PARTITION BY video_id, frame_id // 5) AS n, max(greatest(value_ms // 40 - frame_id % 5, 0)) OVER (PARTITION BY video_id, frame_id // 5 ORDER BY frame_id) AS up FROM {timeline})
    SELECT video_id, piece, string_agg(greatest(0, least(up + i, 9000 - (n - 1 - i)))::BIGINT::VARCHAR, ',' ORDER BY i) AS frames FROM x GROUP BY video_id, piece""")
def clamped_frames(t):
    """Pieces of five frames; the SQL says what the two passes come to."""
    d = t("timeline").groupBy("video_id", F.floor(F.col("frame_id") / 5).alias("piece")).agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_id", "value_ms"))), lambda x: F.floor(x["value_ms"] / 40)).alias("frames"))
    return d.select("video_id", "piece", _text(events.clamp_increasing(F.col("frames"), F.lit(9000))).alias("frames"))


@query("""
    SELECT conv_id, n AS events, CASE WHEN n <= 1 THEN 10 WHEN n = 2 THEN 4 WHEN n <= 4 THEN 2 ELSE 1 END::BIGINT AS videos
    FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)""")
def page_sizes(t):
    """Every turn of a conversation as an event of a search."""
    return t("conversations").groupBy("conv_id").agg(F.count("*").alias("events")).withColumn("videos", events.videos_per_page(F.col("events")))


#: Alignment in SQL: pieces of 40 steps of a video, states blank, 1, blank, 2, blank, 2, blank, 3, blank; the first of equal choices wins.
_PATHS_SQL = """
    RECURSIVE e AS (
      SELECT video_id, video_id::VARCHAR || ':' || (frame_id // 40)::VARCHAR AS id, frame_id % 40 AS t, count(*) OVER (PARTITION BY video_id, frame_id // 40) AS n,
             list_transform([0, 1, 0, 2, 0, 2, 0, 3, 0], lambda k: -(value_ms * (k + 3) % 97)::DOUBLE) AS lp FROM {timeline}
    ), v AS (
      SELECT id, t, list_transform(range(1, 10), lambda s: CASE WHEN s <= 2 THEN lp[s] ELSE '-inf'::DOUBLE END) AS best, NULL::BIGINT[] AS back FROM e WHERE n >= 8 AND t = 0
      UNION ALL
      SELECT id, t, list_transform(range(1, 10), lambda s: list_extract(o[s], c[s] + 1) + lp[s]), c
      FROM (SELECT *, list_transform(o, lambda x: list_position(x, list_max(x))::BIGINT - 1) AS c FROM (
        SELECT e.id, e.t, e.lp, list_transform(range(1, 10), lambda s: [v.best[s], CASE WHEN s > 1 THEN v.best[s - 1] ELSE '-inf'::DOUBLE END, CASE WHEN s IN (4, 8) THEN v.best[s - 2] ELSE '-inf'::DOUBLE END]) AS o
        FROM v JOIN e ON e.id = v.id AND e.t = v.t + 1))
    ), p AS (
      SELECT id, t, CASE WHEN best[9] >= best[8] THEN 8 ELSE 7 END::BIGINT AS k FROM v WHERE (id, t) IN (SELECT (id, max(t)) FROM v GROUP BY id)
      UNION ALL
      SELECT v.id, v.t, p.k - w.back[p.k + 1] FROM p JOIN v w ON w.id = p.id AND w.t = p.t JOIN v ON v.id = p.id AND v.t = p.t - 1
    ), aligned AS (SELECT id, (k - 1) // 2 AS "index", [1, 2, 2, 3][(k - 1) // 2 + 1] AS token, min(t) AS start, max(t) + 1 AS "end" FROM p WHERE k % 2 = 1 GROUP BY id, (k - 1) // 2)"""


def _aligned(t):
    """Alignment of the events' values as log-probabilities of four tokens, over pieces of 40 steps; pieces of under 8 steps have no words."""
    d = t("timeline").withColumn("id", F.concat_ws(":", "video_id", F.floor(F.col("frame_id") / 40)))
    row = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: -(F.pmod(F.col("value_ms") * (k + 3), F.lit(97)).cast("double")))
    d = d.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_id", row.alias("row")))), lambda x: x["row"]).alias("log_probs"))
    d = d.filter(F.size("log_probs") >= 8).withColumn("targets", F.array(*[F.lit(x) for x in (1, 2, 2, 3)]).cast(T.ArrayType(T.IntegerType())))
    return events.aligned(d)


@query(f'WITH {_PATHS_SQL} SELECT id, "index", token, start, "end" FROM aligned')
def ctc_alignment(t):
    return _aligned(t)


@query(f"""
    WITH {_PATHS_SQL}, s AS (SELECT id, any_value(video_id) AS video_id, any_value(t * 0 + split_part(id, ':', 2)::BIGINT) * 20.0::DOUBLE AS a, max(n) * 0.25::DOUBLE AS len FROM e GROUP BY id),
    w AS (
      SELECT id, "index" // 2 AS word_index, s.video_id, s.a, s.a + s.len AS z, greatest(s.a, s.a + min(start) * 0.4::DOUBLE) AS raw, least(s.a + s.len, s.a + max("end") * 0.4::DOUBLE) AS end_sec
      FROM aligned JOIN s USING (id) GROUP BY id, "index" // 2, s.video_id, s.a, s.len
    ), c AS (SELECT *, max(raw) OVER (PARTITION BY id ORDER BY word_index) AS start_sec FROM w),
    x AS (SELECT *, bool_and(start_sec < end_sec) OVER (PARTITION BY id) AS fine FROM c),
    f AS (SELECT video_id, frame_id, frame_id * 0.5::DOUBLE AS pts FROM {{timeline}}),
    g AS (
      SELECT id, word_index, coalesce(max(frame_id) FILTER (pts <= start_sec), min(frame_id)) AS start_frame, coalesce(min(frame_id) FILTER (pts >= end_sec), max(frame_id) + 1) AS end_frame
      FROM x JOIN f USING (video_id) WHERE fine GROUP BY id, word_index
    )
    SELECT id AS segment_id, video_id, word_index, ['hello', 'there'][word_index + 1] AS text, start_sec, end_sec, start_frame, greatest(end_frame, start_frame + 1) AS end_frame,
           CASE WHEN fine THEN 'pass' ELSE 'bad range' END AS status
    FROM x LEFT JOIN g USING (id, word_index)""")
def word_spans(t):
    """Two words of two tokens each; steps last longer than a segment has room for, so some segments fail."""
    tokens = _aligned(t).withColumnRenamed("id", "segment_id")
    pieces = t("timeline").groupBy("video_id", F.floor(F.col("frame_id") / 40).alias("piece")).agg(F.count("*").alias("n"))
    start = F.col("piece") * F.lit(20.0)
    segments = pieces.filter("n >= 8").select(F.concat_ws(":", "video_id", "piece").alias("segment_id"), "video_id", start.alias("start_sec"), (start + F.col("n") * F.lit(0.25)).alias("end_sec"))
    word = lambda i, text: F.struct(F.lit(i).alias("word_index"), F.lit(text).alias("text"), F.lit(2 * i).alias("first_token"), F.lit(2 * i + 1).alias("last_token"))
    words = segments.select("segment_id", F.inline(F.array(word(0, "hello"), word(1, "there"))))
    return events.word_spans(tokens, words, segments, t("timeline").withColumn("pts_time", F.col("frame_id") * F.lit(0.5)), 0.4)


# ---- set operations


@query("SELECT doc_id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def set_difference(t):
    return setops.difference(t("documents"), t("labels"), "doc_id")


@query("SELECT count(DISTINCT doc_id) AS shared FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def set_intersection(t):
    return setops.intersection_size(t("documents"), t("labels"), "doc_id")


@query("""
    WITH x AS (SELECT vec_id AS vector_id, 0 AS source, vec_id AS pos FROM embeddings WHERE label = 3 UNION ALL SELECT vec_id, 1, vec_id FROM embeddings WHERE label % 2 = 1),
    m AS (SELECT vector_id, min({'source': source, 'pos': pos}) AS y FROM x GROUP BY vector_id)
    SELECT vector_id, y.source::BIGINT AS source, y.pos AS pos FROM m""")
def ordered_union(t):
    k = t("keyframes").withColumn("pos", F.col("vector_id"))
    return setops.ordered_union("vector_id", "pos", k.filter("video_id = 'V003'"), k.filter("collection_id = 'L01'"))


@query("""
    WITH k AS (SELECT video_id, vector_id, row_number() OVER (PARTITION BY video_id ORDER BY keyframe_no, vector_id) - 1 AS pos, count(*) OVER (PARTITION BY video_id) AS n FROM {keyframes}),
    d AS (
      SELECT c AS case_id, video_id, n, row_number() OVER (PARTITION BY c ORDER BY sha256('42:pick:' || c || ':' || video_id), video_id) AS turn
      FROM (SELECT DISTINCT video_id, n FROM k WHERE n >= 10) v, range(60) r(c)
    ), p AS (SELECT *, ('0x' || substr(sha256('42:place:' || case_id || ':' || video_id), 1, 8))::BIGINT AS h FROM d WHERE turn = 1 OR turn = 2 AND case_id >= 30),
    w AS (
      SELECT case_id, video_id, slot, CASE WHEN case_id < 30 THEN h % (n - 2) + slot WHEN turn = 1 THEN h % (n - 1) + slot ELSE h % n END AS pos
      FROM p, range(3) r(slot) WHERE case_id < 30 OR (turn = 1) = (slot < 2)
    ) SELECT case_id, CASE WHEN case_id < 30 THEN 'positive' ELSE 'distractor' END AS category, arg_min(video_id, slot) AS expected_video_id,
             string_agg(vector_id::VARCHAR, ',' ORDER BY slot) AS query_vector_ids
      FROM w JOIN k USING (video_id, pos) GROUP BY case_id HAVING count(*) = 3""")
def benchmark_cases(t):
    return events.benchmark_cases(t("keyframes")).withColumn("query_vector_ids", _text("query_vector_ids"))
