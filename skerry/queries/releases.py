"""Sources, availability, batches, stages, fusion and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.functions import vectors
from skerry.operators import aggregates
from skerry.plans import fusion, packing
from skerry.queries.base import query
from skerry.queries.ranking import dot_sql
from skerry.sources import release

# ---- sources


@query("SELECT label AS video_id, count(*) AS rows, min(n) AS lo, max(n) AS hi FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings) WHERE label % 2 = 0 OR n <> 3 GROUP BY label HAVING NOT (min(n) = 1 AND max(n) = count(*))")
def map_faults(t):
    k = t("keyframes").select(F.regexp_extract("video_id", r"(\d+)$", 1).cast("bigint").alias("video_id"), F.col("keyframe_no").alias("n"))
    return release.map_faults(k.filter("video_id % 2 = 0 OR n <> 3"))


@query("""
    SELECT 'V' || c_custkey::VARCHAR || '_a' AS video_id, 'V' || c_custkey::VARCHAR AS collection_id, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS author,
           CASE WHEN c_custkey % 2 = 0 THEN '["' || c_mktsegment || '"]' ELSE '[]' END AS keywords_json, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS duration_sec, CASE WHEN c_custkey % 2 = 0 THEN '2024-02-01' ELSE '' END AS publish_date_iso
    FROM customer""")
def video_rows(t):
    n, none = F.col("c_custkey"), F.lit(None).cast("string")
    raw = t("customer").select(
        F.concat(F.lit("V"), n.cast("string"), F.lit("_a")).alias("video_id"), F.col("c_name").alias("title"), F.when(n % 3 != 0, F.col("c_mktsegment")).alias("author"), *[none.alias(c) for c in ("channel_id", "channel_url", "description", "thumbnail_url", "watch_url")],
        F.when(n % 2 == 0, F.array("c_mktsegment")).alias("keywords"), F.when(n % 5 != 0, n).alias("length"), F.when(n % 2 == 0, "1/2/2024").otherwise("unknown").alias("publish_date"),
    )
    return release.video_rows(raw).select("video_id", "collection_id", "title", "author", "keywords_json", "duration_sec", "publish_date_iso")


def _raw_detections(t):
    """Line items as parallel arrays per order; boxes are turned around for every seventh part, labels broken for every eleventh."""
    d = t("lineitem").filter("l_linenumber <= 4").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"), F.min("l_discount").alias("score"))
    box = F.when(F.col("part") % 7 == 0, F.array(F.lit("0.9"), F.lit("0.1"), F.lit("0.2"), F.lit("0.4"))).otherwise(F.array(F.lit("0.1"), F.lit("0.1"), F.lit("0.2"), F.lit("0.4")))
    x = F.struct("l_linenumber", F.col("part").cast("string").alias("p"), F.when(F.col("part") % 11 == 0, "x").otherwise(F.col("l_linenumber").cast("string")).alias("l"), F.when(F.col("part") % 13 == 0, "NaN").otherwise((F.col("score") * 10).cast("string")).alias("s"), box.alias("b"))
    d = d.groupBy(F.col("l_orderkey").cast("string").alias("keyframe_id")).agg(F.array_sort(F.collect_list(x)).alias("x"))
    return d.select("keyframe_id", F.col("x.p").alias("detection_class_entities"), F.col("x.p").alias("detection_class_names"), F.col("x.l").alias("detection_class_labels"), F.col("x.s").alias("detection_scores"), F.col("x.b").alias("detection_boxes"))


_DETECTIONS_SQL = """
    WITH d AS (SELECT l_orderkey::VARCHAR AS keyframe_id, l_linenumber, min(l_partkey) AS part, min(l_discount) * 10 AS score FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY keyframe_id ORDER BY l_linenumber) AS rank FROM d), k AS (SELECT * FROM r WHERE part % 13 = 0 OR score >= 0.5)"""


@query(_DETECTIONS_SQL + " SELECT keyframe_id, rank, part::VARCHAR AS entity, l_linenumber::BIGINT AS class_label, round(score, 6) AS score FROM k WHERE part % 13 <> 0 AND part % 7 <> 0 AND part % 11 <> 0")
def detection_rows(t):
    return release.detections(_raw_detections(t), 0.5).rows.select("keyframe_id", "rank", "entity", "class_label", F.round("score", 6).alias("score"))


@query(_DETECTIONS_SQL + " SELECT keyframe_id, count(*) AS malformed FROM k WHERE part % 13 = 0 OR part % 7 = 0 OR part % 11 = 0 GROUP BY keyframe_id")
def detection_faults(t):
    return release.detections(_raw_detections(t), 0.5).malformed


@query("SELECT event_id, row_number() OVER (ORDER BY video_id, frame_id) - 1 AS vector_id FROM {timeline}")
def dense_ids(t):
    return release.numbered(t("timeline").withColumnRenamed("frame_id", "keyframe_no")).select("event_id", "vector_id")


@query("SELECT vec_id, label, row_number() OVER (ORDER BY label, vec_id) - 1 AS vector_id FROM embeddings")
def vector_map(t):
    k = t("keyframes").select("video_id", (F.col("keyframe_no") - 1).alias("ordinal"), F.col("vector_id").alias("vec_id"))
    v = t("keyframes").select("video_id", (F.col("keyframe_no") - 1).alias("ordinal"), "embedding")
    d = release.vector_map(k, v)
    return d.select("vec_id", F.regexp_extract("video_id", r"(\d+)$", 1).cast("int").alias("label"), "vector_id")


@query("SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def shard_fallback(t):
    return release.with_fallback(t("labels").select("doc_id", "quality"), t("documents").select("doc_id", F.lit(-1).alias("quality")), "doc_id")


@query("""SELECT vec_id, label, '{"label":' || label::VARCHAR || ',"odd":' || (label % 2 = 1)::VARCHAR || '}' AS meta FROM embeddings""")
def nested_json(t):
    return release.nested_as_json(t("embeddings").select("vec_id", "label", F.struct("label", (F.col("label") % 2 == 1).alias("odd")).alias("meta")))


@query("SELECT lang, source, count(*) AS artifacts FROM documents GROUP BY ALL HAVING count(*) > 1")
def artifact_faults(t):
    return release.single_artifacts(t("documents"), ["lang", "source"])


@query("SELECT 'x/' || (vec_id % 2)::VARCHAR || '/c' || vec_id::VARCHAR || '/frame.mp4' AS path, 'c' || vec_id::VARCHAR || '__frame' AS stem FROM embeddings UNION ALL SELECT 'x/solo ' || vec_id::VARCHAR || '.mp4', 'solo_' || vec_id::VARCHAR FROM embeddings")
def canonical_stems(t):
    n = F.col("vec_id").cast("string")
    e = t("embeddings")
    a = e.select(F.concat(F.lit("x/"), (F.col("vec_id") % 2).cast("string"), F.lit("/c"), n, F.lit("/frame.mp4")).alias("path"))
    return release.canonical_stems(a.unionByName(e.select(F.concat(F.lit("x/solo "), n, F.lit(".mp4")).alias("path"))))


@query("SELECT event_id, user_id FROM events WHERE event_id = (SELECT max(event_id) FROM events)")
def latest_release(t):
    return release.latest_release(t("events").select("event_id", "user_id", F.col("event_id").alias("created"))).select("event_id", "user_id")


@query("SELECT 'orders' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages")
def release_counts(t):
    one = lambda n: t(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
    return one("orders").unionByName(one("documents")).unionByName(one("pages"))


# ---- availability


_AVAILABLE_SQL = """
    WITH a AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS has_embedding, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) AS has_caption, lang = 'en' AS has_asr FROM documents),
    b AS (SELECT *, CASE WHEN has_embedding AND has_caption THEN 'pass' ELSE 'degraded' END AS status FROM a)"""


def _available(t):
    labels = t("labels")
    features = {
        "embedding": labels.select("doc_id", F.when(F.col("quality") == 1, "ok").otherwise("failed").alias("status")),
        "caption": labels.select("doc_id", F.when(F.col("toxic") == 0, "ok").otherwise("failed").alias("status")),
        "asr": t("documents").filter("lang = 'en'").select("doc_id", F.lit(None).cast("string").alias("status")),
    }
    return aggregates.availability(t("documents").select("doc_id"), features, "doc_id", ["embedding", "caption"])


@query(_AVAILABLE_SQL + " SELECT * FROM b")
def availability(t):
    return _available(t)


@query(_AVAILABLE_SQL + """
    , c AS (SELECT count(*) AS n, count(*) FILTER (has_embedding) AS e, count(*) FILTER (has_caption) AS c, count(*) FILTER (has_asr) AS a FROM b), u AS (SELECT 'embedding' AS capability, e AS covered, n FROM c UNION ALL SELECT 'caption', c, n FROM c UNION ALL SELECT 'asr', a, n FROM c)
    SELECT capability, covered, CASE WHEN covered = n THEN 'pass' WHEN covered > 0 THEN 'degraded' ELSE 'failed' END AS status FROM u""")
def capabilities(t):
    return aggregates.capabilities(_available(t), ["embedding", "caption", "asr"])


def _status(t):
    return t("events").select("user_id", "event_type", F.when(F.col("event_id") % 50 == 0, "failed").otherwise("ok").alias("status"), "event_id")


@query("SELECT event_type AS provider, count(*) AS rows, CASE WHEN event_type IN ('view', 'click') AND NOT bool_or(event_id % 50 = 0 AND event_id > 40) THEN 'pass' ELSE 'degraded' END AS status FROM events WHERE event_type <> 'view' OR event_id % 50 <> 0 GROUP BY 1")
def provider_status(t):
    return aggregates.provider_status(_status(t).filter("event_type <> 'view' OR event_id % 50 <> 0").withColumnRenamed("event_type", "provider"), ["view", "click"])


@query("SELECT user_id, CASE WHEN count(*) FILTER (event_id % 50 = 0) = count(*) THEN 'failed' WHEN count(*) FILTER (event_id % 50 = 0) > 0 THEN 'partial' ELSE 'pass' END AS status FROM events GROUP BY 1")
def stage_status(t):
    return aggregates.stage_status(_status(t), "user_id")


@query("SELECT user_id, arg_min(event_type, event_id) FILTER (event_id % 4 <> 0) AS provider FROM events GROUP BY 1")
def first_provider(t):
    d = t("events").select("user_id", "event_id", F.when(F.col("event_id") % 4 == 0, F.when(F.col("event_id") % 8 == 0, " ")).otherwise(F.col("event_type")).alias("provider"))
    return d.groupBy("user_id").agg(aggregates.first_by("provider", "event_id").alias("provider"))


@query("SELECT event_type, count(*) AS rows FROM events GROUP BY 1")
def status_histogram(t):
    return aggregates.histogram(t("events"), "event_type")


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(t):
    return aggregates.repeated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT (SELECT count(*) FROM orders) AS segments, (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS with_words, (SELECT count(*) FROM lineitem) AS words,
           (SELECT count(*) FROM lineitem WHERE l_partkey % 10 = 0) AS unassigned, (SELECT count(*) FROM lineitem WHERE l_partkey % 10 <> 0 AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1 HAVING count(*) > 1)) AS duplicated,
           round((SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS covered""")
def word_coverage(t):
    w = t("lineitem").select(F.col("l_orderkey").alias("segment_id"), F.col("l_partkey").alias("word_id"))
    return aggregates.coverage(w, t("orders").select(F.col("o_orderkey").alias("segment_id")), w.filter("word_id % 10 <> 0").select("word_id")).withColumn("covered", F.round("covered", 6))


_NORM_SQL = "sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))"


@query(f"SELECT count(*) AS rows, round(min({_NORM_SQL}), 6) AS min_norm, round(max({_NORM_SQL}), 6) AS max_norm, max(abs({_NORM_SQL} - 1)) < 0.002 AS unit FROM embeddings")
def vector_summary(t):
    d = aggregates.vector_summary(t("embeddings"), vectors.norm(F.col("embedding")))
    return d.select("rows", F.round("min_norm", 6).alias("min_norm"), F.round("max_norm", 6).alias("max_norm"), (F.col("max_error") < 0.002).alias("unit"))


@query("""
    WITH p AS (SELECT list_dot_product(CAST(a.embedding[1:32] AS DOUBLE[]), CAST(a.embedding[1:32] AS DOUBLE[])) / sqrt(list_dot_product(CAST(a.embedding[1:32] AS DOUBLE[]), CAST(a.embedding[1:32] AS DOUBLE[]))) AS cosine FROM embeddings a)
    SELECT round(median(cosine), 6) AS median_cosine, round(min(cosine), 6) AS min_cosine, median(cosine) >= 0.995 AND min(cosine) >= 0.98 AS passed FROM p""")
def paired_gate(t):
    """Each vector against its first half."""
    half = F.slice("embedding", 1, 32)
    d = aggregates.paired_gate(t("embeddings").select((vectors.dot(half, half) / vectors.norm(half)).alias("cosine")))
    return d.withColumn("median_cosine", F.round("median_cosine", 6)).withColumn("min_cosine", F.round("min_cosine", 6))


@query("SELECT user_id, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) ELSE 'mixed' END AS event_type FROM events GROUP BY 1")
def model_identity(t):
    return aggregates.identity_or_mixed(t("events"), "user_id", ["event_type"])


# ---- batches and stages


@query("""
    WITH RECURSIVE o AS (SELECT video_id, cost, row_number() OVER (ORDER BY cost DESC, video_id) AS k FROM (SELECT video_id, sum(25 + vector_id % 13)::DOUBLE AS cost FROM {keyframes} GROUP BY video_id)),
    r AS (
      SELECT 0::BIGINT AS k, list_transform(range(7), lambda i: 0.0::DOUBLE) AS loads, NULL::BIGINT AS batch, NULL::VARCHAR AS video_id, NULL::DOUBLE AS cost
      UNION ALL
      SELECT x.k, list_transform(range(1, 8), lambda i: x.loads[i] + CASE WHEN i = x.b THEN x.cost ELSE 0 END), x.b - 1, x.video_id, x.cost
      FROM (SELECT o.*, r.loads, list_position(r.loads, list_min(r.loads))::BIGINT AS b FROM r JOIN o ON o.k = r.k + 1) x
    ) SELECT video_id, cost, batch FROM r WHERE k > 0""")
def lpt_batches(t):
    """The manifest of videos: what their keyframes cost."""
    manifest = t("keyframes").groupBy("video_id").agg(F.sum(25 + F.col("vector_id") % 13).alias("cost"))
    return packing.least_loaded(manifest, 7)


@query("""
    WITH RECURSIVE o AS (SELECT source, doc_id AS pos, doc_id AS video_id, CASE WHEN doc_id % 50 <> 0 THEN n_chars END AS bytes, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
    r AS (
      SELECT source, pos, video_id, bytes, k, 0 AS chunk, 1 AS n, coalesce(bytes, 60000)::BIGINT AS used FROM o WHERE k = 1
      UNION ALL
      SELECT o.source, o.pos, o.video_id, o.bytes, o.k, r.chunk + CASE WHEN full_ THEN 1 ELSE 0 END, CASE WHEN full_ THEN 1 ELSE r.n + 1 END, (CASE WHEN full_ THEN 0 ELSE r.used END + coalesce(o.bytes, 60000))::BIGINT
      FROM r JOIN o ON o.source = r.source AND o.k = r.k + 1, LATERAL (SELECT r.n >= 12 OR r.used + coalesce(o.bytes, 60000) > 60000 AS full_) f
    ) SELECT source, pos, video_id, bytes::BIGINT AS bytes, chunk::BIGINT AS chunk FROM r""")
def greedy_chunks(t):
    d = t("documents").select("source", F.col("doc_id").alias("pos"), F.col("doc_id").alias("video_id"), F.when(F.col("doc_id") % 50 != 0, F.col("n_chars")).alias("bytes"))
    return packing.greedy_chunks(d, "source", 12, 60_000)


@query("SELECT lang, doc_id, floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) / 25)::BIGINT AS batch FROM documents")
def split_batches(t):
    return packing.split_batches(t("documents").select("lang", "doc_id"), "lang", ["doc_id"], 25)


#: The stages of a graph: regions, their nations, the nations' suppliers.
_EDGES_SQL = "edges(a, b) AS (SELECT r_name, n_name FROM region JOIN nation ON n_regionkey = r_regionkey UNION ALL SELECT n_name, s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey)"


def _stages(t):
    """stage, downstream; the balances of all stages: a nation's is its number, a supplier's its account."""
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    edges = nations.select(F.col("r_name").alias("stage"), F.col("n_name").alias("downstream")).unionByName(suppliers.select(F.col("n_name").alias("stage"), F.col("s_name").alias("downstream")))
    facts = t("region").select(F.col("r_name").alias("stage"), F.lit(0.0).alias("balance")).unionByName(t("nation").select(F.col("n_name").alias("stage"), F.col("n_nationkey").cast("double").alias("balance")))
    return edges, facts.unionByName(t("supplier").select(F.col("s_name").alias("stage"), F.col("s_acctbal").alias("balance")))


@query(f"WITH RECURSIVE {_EDGES_SQL}, reach(stage) AS (SELECT r_name FROM region WHERE r_regionkey = 2 UNION SELECT b FROM reach JOIN edges ON a = stage) SELECT stage FROM reach")
def dag_closure(t):
    return packing.closure(_stages(t)[0], t("region").filter("r_regionkey = 2").select(F.col("r_name").alias("stage")))


@query(f"""
    WITH RECURSIVE {_EDGES_SQL}, stages AS (SELECT r_name AS stage, false AS changed FROM region UNION ALL SELECT n_name, n_nationkey = 7 FROM nation UNION ALL SELECT s_name, s_acctbal < 0 FROM supplier),
    stale(stage) AS (SELECT stage FROM stages WHERE changed UNION SELECT b FROM stale JOIN edges ON a = stage)
    SELECT stage, stage NOT IN (SELECT stage FROM stale) AS reuse FROM stages""")
def stage_reuse(t):
    """Fingerprints of balances against those of an earlier run, in which no supplier owed anything and one nation's number was another."""
    edges, facts = _stages(t)
    printed = lambda c: F.sha2(F.concat_ws(":", "stage", c.cast("string")), 256).alias("fingerprint")
    before = F.when(F.col("stage") == "NATION_7", F.col("balance") + 1).otherwise(F.abs("balance"))
    return packing.reuse(facts.select("stage", printed(F.col("balance"))), facts.select("stage", printed(before)), edges)


# ---- fusion and scoring

_HITS_SQL = f"""
    WITH hits AS (SELECT 'visual' AS modality, vec_id AS vector_id, {dot_sql(7)} AS score FROM embeddings UNION ALL SELECT 'caption', vec_id, {dot_sql(11)} FROM embeddings
                  UNION ALL SELECT 'ocr', vec_id, (vec_id % 10)::DOUBLE FROM embeddings),
    b AS (SELECT modality, min(score) AS lo, max(score) AS hi FROM hits GROUP BY 1),
    n AS (SELECT modality, vector_id, CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 1.0 END AS score FROM hits JOIN b USING (modality)),
    w(modality, weight) AS (VALUES ('visual', 0.25::DOUBLE), ('caption', 0.25::DOUBLE), ('ocr', 0.15::DOUBLE)),
    f AS (SELECT vector_id, sum(score * weight) AS fused FROM n JOIN w USING (modality) GROUP BY 1)"""


def _fused(t):
    k = t("keyframes")
    hit = lambda name, d, score: d.select(F.lit(name).alias("modality"), "vector_id", score.alias("score"))
    d = hit("visual", k, vectors.dot(F.col("embedding"), t.vector(7)))
    d = d.unionByName(hit("caption", k, vectors.dot(F.col("embedding"), t.vector(11)))).unionByName(hit("ocr", k, (F.col("vector_id") % 10).cast("double")))
    return fusion.fused(fusion.normalised(d), fusion.PROFILES["tkis"])


@query(_HITS_SQL + " SELECT vector_id, round(fused, 6) AS fused FROM f ORDER BY fused DESC, vector_id LIMIT 50")
def fusion_weighted(t):
    return _fused(t).orderBy(F.desc("fused"), "vector_id").limit(50).withColumn("fused", F.round("fused", 6))


@query(_HITS_SQL + ", p AS (SELECT vector_id, video_id, fused, row_number() OVER (PARTITION BY video_id ORDER BY fused DESC, vector_id) AS n FROM f JOIN (SELECT vector_id, video_id FROM {keyframes}) k USING (vector_id)) SELECT vector_id, video_id, round(fused, 6) AS fused FROM p WHERE n <= 3")
def fusion_diversified(t):
    d = fusion.diversified(_fused(t).join(t("keyframes").select("vector_id", "video_id"), "vector_id"), "video_id", "fused", "vector_id", 3)
    return d.select("vector_id", "video_id", F.round("fused", 6).alias("fused"))


@query("""
    SELECT a.video_id, a.vector_id AS a, b.vector_id AS b FROM (SELECT * FROM {keyframes}) a JOIN (SELECT * FROM {keyframes}) b
    ON a.video_id = b.video_id AND b.pts_time_sec > a.pts_time_sec AND b.pts_time_sec - a.pts_time_sec <= 90""")
def temporal_within(t):
    k = t("keyframes")
    return fusion.within(k, k, 90.0)


@query("""
    WITH a AS (SELECT user_id AS query_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rank, (event_id % 101) / 100.0::DOUBLE AS r FROM events)
    SELECT query_id, round((coalesce(max(r) FILTER (rank <= 1), 0) + coalesce(max(r) FILTER (rank <= 5), 0) + coalesce(max(r) FILTER (rank <= 20), 0) + coalesce(max(r) FILTER (rank <= 50), 0) + coalesce(max(r) FILTER (rank <= 100), 0)) / 5, 6) AS score FROM a GROUP BY 1""")
def rscore_at_k(t):
    from pyspark.sql import Window

    a = t("events").select(F.col("user_id").alias("query_id"), F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).alias("rank"), ((F.col("event_id") % 101) / 100).alias("rscore"))
    return fusion.recall_score(a).withColumn("score", F.round("score", 6))


@query("SELECT user_id AS session_id, event_id FROM (SELECT *, event_id // 100 AS batch, max(event_id // 100) OVER (PARTITION BY user_id) AS last FROM events) WHERE batch = last")
def latest_clues(t):
    d = t("events").select(F.col("user_id").alias("session_id"), "event_id", F.floor(F.col("event_id") / 100).alias("batch"))
    return fusion.latest(d, "current_only").select("session_id", "event_id")


@query(f"SELECT vec_id AS vector_id, round({dot_sql(7)}, 6) AS score FROM embeddings WHERE vec_id IN (7, 11, 3)")
def stored_similarity(t):
    k = t("keyframes").filter(F.col("vector_id").isin(3, 7, 11))
    q = [F.lit(x) for x in t.vector(7)]
    return k.select("vector_id", F.round(vectors.dot(vectors.unit(F.col("embedding")), F.array(*q)), 6).alias("score"))


