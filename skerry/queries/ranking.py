"""Vector ranking, filters, paging, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.functions import vectors
from skerry.operators import filters, ranking
from skerry.operators import intervals as joins
from skerry.queries.base import query

DIMENSION = 64


def dot_sql(vector_id: int, column: str = "embedding") -> str:
    return f"list_dot_product(CAST({column} AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = {vector_id}))"


def ranked_sql(source: str, k: int, where: str = "TRUE") -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY s DESC, vector_id) AS rank, vector_id, video_id, round(s, 6) AS score
    FROM (SELECT vector_id, video_id, {dot_sql(7)} AS s FROM {source} WHERE {where}) ORDER BY s DESC, vector_id LIMIT {k}"""


def _shown(d):
    return d.select("rank", "vector_id", "video_id", F.round("score", 6).alias("score"))


@query(ranked_sql("{keyframes}", 20))
def vec_topk(t):
    return _shown(ranking.ranked(ranking.cosine_top_k(t("keyframes"), vectors.unit_list(t.vector(7), DIMENSION), 20)))


FILTERS = filters.SearchFilters(collections=("L00",), date_to="2024-12-31", entities=("RF", "AF"), minimum_score=0.5)


@query(
    ranked_sql(
        "{keyframes} JOIN (SELECT video_id, publish_date_iso FROM {videos}) AS v USING (video_id)",
        15,
        """collection_id = 'L00' AND publish_date_iso <= '2024-12-31'
           AND EXISTS (SELECT 1 FROM {detections} WHERE detections.vector_id = keyframes.vector_id AND entity IN ('RF', 'AF') AND score >= 0.5)""",
    )
)
def vec_topk_filtered(t):
    rows = filters.eligible(t("keyframes"), t("videos"), t("detections"), FILTERS)
    return _shown(ranking.ranked(ranking.cosine_top_k(rows, t.vector(7), 15)))


@query(f"SELECT * FROM ({ranked_sql('{keyframes}', 20)}) WHERE vector_id <> 7")
def vec_more_like_this(t):
    return _shown(ranking.more_like_this(t("keyframes"), 7, t.vector(7), 20))


@query("""
    SELECT row_number() OVER (ORDER BY d, vector_id) AS rank, vector_id, round(d, 6) AS distance
    FROM (SELECT vec_id AS vector_id, list_distance(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7)) AS d FROM embeddings)
    ORDER BY d, vector_id LIMIT 20""")
def vec_l2_topk(t):
    top = ranking.l2_top_k(t("keyframes"), t.vector(7), 20)
    return ranking.ranked(top, "distance", ascending=True).select("rank", "vector_id", F.round("distance", 6).alias("distance"))


@query("SELECT vector_id, video_id, 1.0::DOUBLE AS score FROM {keyframes} WHERE collection_id = 'L01'")
def canonical_listing(t):
    return t("keyframes").filter(filters.SearchFilters(collections=("L01",)).predicate()).select("vector_id", "video_id", F.lit(1.0).alias("score")).orderBy("vector_id")


@query(f"""
    SELECT rank, vector_id, k.video_id, collection_id, keyframe_no::BIGINT AS keyframe_no, author, watch_url, score
    FROM ({ranked_sql("{keyframes}", 20)}) r JOIN (SELECT vector_id, collection_id, keyframe_no, video_id FROM {{keyframes}}) k USING (vector_id) JOIN (SELECT video_id, author, watch_url FROM {{videos}}) v ON v.video_id = k.video_id""")
def lookup_join(t):
    top = _shown(ranking.ranked(ranking.cosine_top_k(t("keyframes"), t.vector(7), 20))).drop("video_id")
    meta = t("keyframes").join(t("videos").drop("collection_id"), "video_id").select("vector_id", "video_id", "collection_id", "keyframe_no", "author", "watch_url")
    return joins.looked_up(top, meta)


RECALL_IDS = (1, 5, 9, 13)


def _halves(t):
    """For each query vector the exact top 10, and the top 10 by the first half of the dimensions."""
    exact, half = None, None
    for i in RECALL_IDS:
        q = t.vector(i)
        a = ranking.ranked(ranking.cosine_top_k(t("keyframes"), q, 10)).select(F.lit(i).alias("query_id"), "vector_id", "rank")
        b = ranking.ranked(ranking.cosine_top_k(t("keyframes").withColumn("embedding", F.slice("embedding", 1, 32)), q[:32], 10)).select(F.lit(i).alias("query_id"), "vector_id", "rank")
        exact, half = (a, b) if exact is None else (exact.unionByName(a), half.unionByName(b))
    return exact, half


_RECALL_SQL = """
    WITH scored AS (
      SELECT q.vec_id AS query_id, e.vec_id AS vector_id, list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS a,
             list_dot_product(CAST(e.embedding[1:32] AS DOUBLE[]), CAST(q.embedding[1:32] AS DOUBLE[])) AS b
      FROM embeddings e, embeddings q WHERE q.vec_id IN (1, 5, 9, 13)
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY a DESC, vector_id) AS ra, row_number() OVER (PARTITION BY query_id ORDER BY b DESC, vector_id) AS rb FROM scored
    ), found AS (
      SELECT query_id, count(*) FILTER (ra <= 10 AND rb <= 10) / 10.0::DOUBLE AS recall, bool_or(ra = 1 AND rb = 1) AS same_top FROM placed GROUP BY query_id
    )"""


@query(_RECALL_SQL + " SELECT query_id, recall, same_top FROM found")
def recall_at_k(t):
    return ranking.recall(*_halves(t), 10)


@query(_RECALL_SQL + " SELECT round(avg(recall), 6) AS mean_recall, min(recall) AS min_recall, round(avg(same_top::INT), 6) AS top1, avg(recall) >= 0.98 AND avg(same_top::INT) >= 0.99 AS passed FROM found")
def recall_gate(t):
    d = ranking.recall_gate(ranking.recall(*_halves(t), 10))
    return d.withColumn("mean_recall", F.round("mean_recall", 6)).withColumn("top1", F.round("top1", 6))


@query()
def ivf_topk(t):
    """Inverted lists by k-means: 8 lists, 4 probed; tests measure the recall."""
    indexed, centroids = ranking.ivf(t("keyframes"), 8)
    return _shown(ranking.ivf_top_k(indexed, centroids, t.vector(7), 20, 4))


@query("""
    SELECT vector_id, video_id FROM {keyframes}
    WHERE EXISTS (SELECT 1 FROM {detections} WHERE detections.vector_id = keyframes.vector_id AND entity IN ('NF', 'RF') AND score >= 0.8)""")
def object_any(t):
    return filters.having_any(t("keyframes").select("vector_id", "video_id"), t("detections"), "vector_id", ["NF", "RF"], 0.8)


@query("""
    SELECT vector_id, video_id FROM {keyframes}
    WHERE (SELECT count(DISTINCT entity) FROM {detections} WHERE detections.vector_id = keyframes.vector_id AND entity IN ('NF', 'RF') AND score >= 0.8) = 2""")
def object_all(t):
    return filters.having_all(t("keyframes").select("vector_id", "video_id"), t("detections"), "vector_id", ["NF", "RF", "NF"], 0.8)


@query("SELECT video_id, publish_date_iso FROM {videos} WHERE publish_date_iso <= '2024-05-31'")
def date_range_string(t):
    return t("videos").filter(filters.SearchFilters(date_to="2024-05-31").predicate()).select("video_id", "publish_date_iso")


@query("SELECT video_id, author, publish_date_iso FROM {videos} WHERE video_id IN ('V001', 'V004') AND author = 'ARGENTINA' AND publish_date_iso >= '2024-01-01'")
def author_video_filter(t):
    chosen = filters.SearchFilters(video_ids=("V001", "V004"), video_id="V001", author="ARGENTINA", date_from="2024-01-01")
    return t("videos").filter(chosen.predicate()).select("video_id", "author", "publish_date_iso")


def _catalogue(t):
    return t("keyframes").join(t("videos").drop("collection_id"), "video_id").select("vector_id", "video_id", "collection_id", "author", "publish_date_iso", "keyframe_no", "frame_idx", "pts_time_sec")


_CATALOGUE_SQL = """(
      SELECT vector_id, keyframes.video_id, collection_id, author, publish_date_iso, keyframe_no, frame_idx
      FROM {keyframes} JOIN (SELECT video_id, author, publish_date_iso FROM {videos}) v ON v.video_id = keyframes.video_id) c"""


@query(f"""
    SELECT vector_id, video_id, author FROM {_CATALOGUE_SQL}
    WHERE contains(lower(video_id), '02') OR contains(lower(author), '02') OR contains(lower(collection_id), '02')
          OR contains(CASE WHEN keyframe_no = 0 THEN '' ELSE keyframe_no::VARCHAR END, '02') OR contains(CASE WHEN frame_idx = 0 THEN '' ELSE frame_idx::VARCHAR END, '02')""")
def refine_contains(t):
    return filters.refine(_catalogue(t), " 02 ").select("vector_id", "video_id", "author")


@query(f"SELECT vector_id, video_id, keyframe_no::BIGINT AS keyframe_no FROM {_CATALOGUE_SQL} WHERE keyframe_no = 5 AND collection_id = 'L01'")
def refine_exact(t):
    return filters.refine(_catalogue(t), "5", "keyframe_no", collections=("L01",)).select("vector_id", "video_id", "keyframe_no")


@query("""
    SELECT 'collection_id' AS facet, collection_id AS value FROM {videos} UNION SELECT 'author', author FROM {videos} WHERE author <> ''
    UNION SELECT 'publish_date_iso', publish_date_iso FROM {videos} WHERE publish_date_iso <> ''""")
def facets(t):
    return filters.facets(t("videos"), ["collection_id", "author", "publish_date_iso"])


@query("SELECT vec_id AS vector_id, vec_id % 7 = 0 AS excluded FROM embeddings")
def exclusion_marks(t):
    k = t("keyframes").select("vector_id")
    return filters.excluded(k, k.filter("vector_id % 7 = 0"), "vector_id", hide=False)


@query("SELECT vec_id AS vector_id FROM embeddings WHERE vec_id % 7 <> 0")
def exclusion_hidden(t):
    k = t("keyframes").select("vector_id")
    return filters.excluded(k, k.filter("vector_id % 7 = 0"), "vector_id", hide=True)


@query("SELECT vec_id AS vector_id FROM embeddings WHERE (vec_id % 2 = 0) <> (vec_id % 3 = 0)")
def exclusion_toggle(t):
    k = t("keyframes").select("vector_id")
    return filters.toggled(k.filter("vector_id % 2 = 0"), k.filter("vector_id % 3 = 0"), "vector_id")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def first_pairs(t):
    return filters.first_pairs(t("events"), ["user_id", "event_type"], "event_id")


@query(f"SELECT rank, vector_id FROM ({ranked_sql('{keyframes}', 95)}) WHERE rank BETWEEN 91 AND 100")
def page_slice(t):
    """Page 99 of 95 rows by 10: clamped to the last."""
    return ranking.page(ranking.ranked(ranking.cosine_top_k(t("keyframes"), t.vector(7), 95)), 99, 10, 95).select("rank", "vector_id")


@query("""
    WITH k AS (SELECT video_id, vector_id, row_number() OVER (PARTITION BY video_id ORDER BY vector_id) - 1 AS place, count(*) OVER (PARTITION BY video_id) AS n FROM {keyframes})
    SELECT video_id, vector_id, place FROM k
    WHERE n <= 7 OR place IN (SELECT round_even(i * (n - 1) / 6.0::DOUBLE, 0)::BIGINT FROM range(0, 7) AS r(i))""")
def even_sample(t):
    return ranking.evenly_sampled(t("keyframes").select("video_id", "vector_id"), "video_id", ["vector_id"], 7)


@query("""
    SELECT doc_id, lang, turn FROM (
      SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS turn FROM documents
    ) ORDER BY turn, lang LIMIT 50""")
def stratified_sample(t):
    return ranking.stratified(t("documents").select("doc_id", "lang"), "lang", "doc_id", 50)


@query("""
    SELECT doc_id, used FROM (
      SELECT doc_id, (sum(n_chars + 1) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS used FROM documents
    ) WHERE used <= 20000""")
def prefix_budget(t):
    return ranking.first_that_fit(t("documents").select("source", "doc_id", "n_chars"), "source", ["doc_id"], F.col("n_chars"), 20000).select("doc_id", "used")


@query("""
    WITH k AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total FROM documents),
    tries AS (SELECT lang, n, sum(n_chars + 1) - 1 AS used FROM k, range(1, 11) AS r(n)
      WHERE total <= n OR CASE WHEN n = 1 THEN place = floor(total / 2) ELSE place IN (SELECT round_even(i * (total - 1) / greatest(n - 1, 1)::DOUBLE, 0)::BIGINT FROM range(0, 10) AS q(i) WHERE i < n) END GROUP BY lang, n)
    SELECT lang, coalesce(max(n) FILTER (used <= 9000), 0)::BIGINT AS n FROM tries GROUP BY lang""")
def even_budget(t):
    return ranking.largest_even_fit(t("documents"), "lang", ["doc_id"], F.col("n_chars"), 9000, 10)
