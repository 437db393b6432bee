"""Data contracts and cross-table invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.operators import intervals, sequences
from skerry.plans import checks
from skerry.queries.base import query
from skerry.queries.intervals import segments, shots
from skerry.queries.sequences import _MARKED_SQL, _SCENES_SQL, _marked

SPECS = [
    checks.TableSpec(
        "orders", required=("o_orderkey", ("o_comment", "o_orderstatus"), ("o_clerk", "o_note")), non_null=("o_orderkey", "o_custkey"), unique=(("o_orderkey",),), non_empty=("o_orderpriority",),
        domains={"o_orderstatus": ("F", "O")}, integer=("o_orderkey", "o_totalprice"), numeric=("o_totalprice",), text=("o_orderstatus",), rules={"positive price": "o_totalprice > 1000"},
    ),
    checks.TableSpec("lineitem", required=("l_orderkey",), non_null=("l_orderkey", "l_shipdate"), unique=(("l_orderkey", "l_linenumber"),), domains={"l_returnflag": ("R", "A", "N")}, rules={"discount": "l_discount BETWEEN 0 AND 0.09D"}),
    checks.TableSpec("nation", required=("n_nationkey",), unique=(("n_nationkey",), ("n_name",)), non_empty=("n_name",)),
    checks.TableSpec("shipments", required=("s_key",)),
]

_CHECKS_SQL = """
    WITH checks(t, c, v) AS (
      SELECT 'orders', 'null:o_orderkey', (SELECT count(*) FILTER (o_orderkey IS NULL) FROM orders) UNION ALL SELECT 'orders', 'null:o_custkey', (SELECT count(*) FILTER (o_custkey IS NULL) FROM orders)
      UNION ALL SELECT 'orders', 'blank:o_orderpriority', (SELECT count(*) FILTER (trim(coalesce(o_orderpriority, '')) = '') FROM orders)
      UNION ALL SELECT 'orders', 'domain:o_orderstatus', (SELECT count(*) FILTER (coalesce(o_orderstatus, '') NOT IN ('F', 'O')) FROM orders)
      UNION ALL SELECT 'orders', 'rule:positive price', (SELECT count(*) FILTER (NOT coalesce(o_totalprice > 1000, FALSE)) FROM orders)
      UNION ALL SELECT 'orders', 'unique:o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'orders', 'missing:o_clerk|o_note', 1 UNION ALL SELECT 'orders', 'type:o_totalprice', 1
      UNION ALL SELECT 'lineitem', 'null:l_orderkey', (SELECT count(*) FILTER (l_orderkey IS NULL) FROM lineitem) UNION ALL SELECT 'lineitem', 'null:l_shipdate', (SELECT count(*) FILTER (l_shipdate IS NULL) FROM lineitem)
      UNION ALL SELECT 'lineitem', 'domain:l_returnflag', (SELECT count(*) FILTER (coalesce(l_returnflag, '') NOT IN ('R', 'A', 'N')) FROM lineitem)
      UNION ALL SELECT 'lineitem', 'rule:discount', (SELECT count(*) FILTER (NOT coalesce(l_discount BETWEEN 0 AND 0.09::DOUBLE, FALSE)) FROM lineitem)
      UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))
      UNION ALL SELECT 'nation', 'blank:n_name', (SELECT count(*) FILTER (trim(coalesce(n_name, '')) = '') FROM nation)
      UNION ALL SELECT 'nation', 'unique:n_nationkey', (SELECT count(*) FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'nation', 'unique:n_name', (SELECT count(*) FROM (SELECT n_name FROM nation GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'shipments', 'missing table', 1
    )"""


def _release(t) -> DataFrame:
    return checks.check_release({n: t(n) for n in ("orders", "lineitem", "nation")}, SPECS)


@query(_CHECKS_SQL + ' SELECT t AS "table", c AS "check", v::BIGINT AS violations FROM checks')
def checks_tables(t):
    return _release(t)


@query(_CHECKS_SQL + """ SELECT coalesce(t, 'release') AS "table", count(*) FILTER (v > 0) AS failed, CASE WHEN count(*) FILTER (v > 0) = 0 THEN 'pass' ELSE 'failed' END AS status FROM checks GROUP BY ROLLUP (t)""")
def checks_verdicts(t):
    return checks.verdicts(_release(t))


@query("""
    SELECT 'nation of customer' AS "check", count(*) AS violations FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)
    UNION ALL SELECT 'order of line', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def checks_fk(t):
    a = checks.orphan_count(t("customer"), t("nation").filter("n_nationkey < 20"), "c_nationkey", "n_nationkey", "nation of customer")
    return a.unionByName(checks.orphan_count(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey", "order of line"))


@query("SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR o_orderpriority IS NULL")
def checks_domain(t):
    return checks.invalid_values(t("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("""
    SELECT video_id, count(*) FILTER (shot_index <> place) AS misnumbered, count(*) FILTER (start_sec > before + 1e-9::DOUBLE) AS gaps, count(*) FILTER (start_sec < before - 1e-9::DOUBLE) AS overlaps, count(*) FILTER (end_sec <= start_sec) AS empty
    FROM (SELECT *, row_number() OVER w - 1 AS place, lag(end_sec) OVER w AS before FROM (SELECT video_id, shot_index, start_sec::DOUBLE AS start_sec, end_sec::DOUBLE + (shot_index % 2) AS end_sec FROM {shots} WHERE shot_index % 5 <> 3) WINDOW w AS (PARTITION BY video_id ORDER BY shot_index))
    GROUP BY video_id""")
def checks_ranges(t):
    d = shots(t).filter("entity_id % 5 <> 3").withColumn("end_sec", F.col("end_sec") + F.col("entity_id") % 2)
    return checks.ordered_faults(d, "video_id", "entity_id", "start_sec", "end_sec")


@query(f"""
    WITH scenes AS ({_SCENES_SQL})
    SELECT video_id, scene_index FROM scenes WHERE (video_id + scene_index) % 7 = 0""")
def checks_membership(t):
    """Scenes as derived, but every seventh claims one shot more."""
    from pyspark.sql import Window

    d = _marked(t)
    scenes = sequences.partitioned(d).withColumn("shot_count", F.col("shot_count") + F.when((F.col("video_id") + F.col("scene_index")) % 7 == 0, 1).otherwise(0))
    before = Window.partitionBy("video_id").orderBy("shot_index").rowsBetween(Window.unboundedPreceding, -1)
    members = d.withColumn("scene_index", F.coalesce(F.sum(F.col("boundary").cast("int")).over(before), F.lit(0)))
    return checks.membership_faults(members, scenes)


@query("""
    WITH p AS (SELECT a.video_id, a.shot_index AS entity_id, segment_id FROM (SELECT * FROM {shots}) a JOIN (SELECT * FROM {segments}) b ON a.video_id = b.video_id AND a.start_sec < b.end_sec AND b.start_sec < a.end_sec)
    SELECT video_id, entity_id, segment_id, CASE WHEN segment_id % 10 = 0 THEN 'missing' ELSE 'different' END AS fault FROM p WHERE segment_id % 10 IN (0, 1)""")
def checks_links(t):
    """Stored links lack every tenth segment and have another overlap for the next."""
    found = intervals.overlapping(shots(t), segments(t)).select("video_id", "entity_id", "segment_id", "overlap_sec")
    stored = found.filter("segment_id % 10 <> 0").withColumn("overlap_sec", F.col("overlap_sec") + F.when(F.col("segment_id") % 10 == 1, 0.1).otherwise(0.0))
    return checks.link_faults(stored, found, ["video_id", "entity_id", "segment_id"], ["overlap_sec"])


@query(r"""
    WITH w AS (SELECT conv_id AS segment_id, turn AS word_index, role AS text, turn::DOUBLE AS s, turn + CASE WHEN turn % 3 = 0 THEN 1.5 ELSE 1.0 END::DOUBLE AS e FROM (SELECT conv_id, turn, min(role) AS role FROM conversations GROUP BY ALL)),
    x AS (SELECT *, row_number() OVER o - 1 AS place, lag(e) OVER o AS before, max(word_index) OVER (PARTITION BY segment_id) AS last FROM w WINDOW o AS (PARTITION BY segment_id ORDER BY word_index))
    SELECT segment_id, count(*) FILTER (s < -1e-9::DOUBLE OR e > last + 1 + 1e-9::DOUBLE) AS outside, count(*) FILTER (word_index <> place) AS misnumbered, count(*) FILTER (s < before - 1e-9::DOUBLE) AS overlapping,
           segment_id % 2 = 0 AS text_differs FROM x GROUP BY segment_id""")
def checks_words(t):
    w = t("conversations").groupBy(F.col("conv_id").alias("segment_id"), F.col("turn").alias("word_index")).agg(F.min("role").alias("text"))
    w = w.withColumn("start_sec", F.col("word_index").cast("double")).withColumn("end_sec", F.col("word_index") + F.when(F.col("word_index") % 3 == 0, 1.5).otherwise(1.0))
    s = w.groupBy("segment_id").agg((F.max("word_index") + 1.0).alias("end_sec"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_index", "text"))), lambda x: x["text"]), " ").alias("text"))
    s = s.withColumn("start_sec", F.lit(0.0)).withColumn("text", F.when(F.col("segment_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return checks.word_faults(s, w)


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0 ELSE 2 END::BIGINT AS times FROM events WHERE event_id % 10 IN (0, 5)")
def checks_attribution(t):
    e = t("events").select("event_id")
    assigned = e.filter("event_id % 10 <> 0").unionByName(e.filter("event_id % 10 = 5"))
    return checks.attribution_faults(e, assigned, "event_id")


@query("""
    WITH g AS (SELECT user_id, list_sort(list_filter(['click', 'purchase', 'refund', 'view'], lambda x: NOT list_contains(list(event_type), x))) AS missing FROM events GROUP BY user_id)
    SELECT user_id, array_to_string(missing, ',') AS missing FROM g WHERE len(missing) > 0""")
def checks_provenance(t):
    d = checks.incomplete_provenance(t("events"), "user_id", "event_type", ["view", "click", "refund", "purchase"])
    return d.withColumn("missing", F.array_join("missing", ","))


@query("SELECT o_orderkey, o_custkey AS a, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS b FROM orders WHERE o_orderkey % 9 = 0")
def checks_representatives(t):
    left = t("orders").select("o_orderkey", F.col("o_custkey").alias("a"))
    right = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("b"))
    return checks.mismatched(left, right, "o_orderkey", "a", "b")


@query("SELECT doc_id, doc_id % 4 = 0 AS valid FROM documents")
def checks_fingerprints(t):
    h = F.sha2(F.coalesce("text", F.lit("")), 256)
    shown = F.when(F.col("doc_id") % 4 == 0, h).when(F.col("doc_id") % 4 == 1, F.upper(F.concat(F.lit("a"), F.substring(h, 2, 63)))).when(F.col("doc_id") % 4 == 2, F.substring(h, 1, 63))
    return t("documents").select("doc_id", checks.hex_fingerprint(shown).alias("valid"))


@query("""
    SELECT 'doc' || doc_id::VARCHAR AS path, CASE doc_id % 20 WHEN 0 THEN 'missing' WHEN 1 THEN 'unlisted' WHEN 2 THEN 'size' ELSE 'sha256' END AS fault FROM documents WHERE doc_id % 20 < 4""")
def checks_files(t):
    path, n = F.concat(F.lit("doc"), F.col("doc_id").cast("string")), F.col("doc_id") % 20
    d = t("documents").select(path.alias("path"), F.coalesce("n_chars", F.lit(0)).alias("size"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), n.alias("n"))
    there = d.filter("n <> 0").withColumn("size", F.when(F.col("n") == 2, F.col("size") + 1).otherwise(F.col("size"))).withColumn("sha256", F.when(F.col("n") == 3, "0").otherwise(F.col("sha256")))
    return checks.files_differ(d.filter("n <> 1"), there)


@query("SELECT count(*) AS videos, count(*) FILTER (fine) AS whole FROM (SELECT video_id, bool_and(coalesce(start_sec = before, TRUE)) AS fine FROM (SELECT video_id, start_sec, lag(end_sec) OVER (PARTITION BY video_id ORDER BY shot_index) AS before FROM " + _MARKED_SQL + ") GROUP BY video_id)")
def partition_coverage(t):
    faults = checks.ordered_faults(shots(t), "video_id", "entity_id", "start_sec", "end_sec")
    sums = [F.col(c) == 0 for c in ("gaps", "overlaps", "empty")]
    return faults.agg(F.count(F.lit(1)).alias("videos"), F.count_if(reduce(lambda a, b: a & b, sums)).alias("whole"))
