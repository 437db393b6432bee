"""Metadata records, strict JSON rows, query plans, speech evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.functions import text
from skerry.operators import sequences
from skerry.queries.base import query
from skerry.sources import records


def _records(t):
    n, none = F.col("c_custkey"), F.lit(None)
    raw = t("customer").filter(n % 4 != 0).select(
        n.alias("video_id"), F.concat(F.lit(" "), "c_name").alias("title"), F.when(n % 3 == 0, "  ").otherwise(F.col("c_mktsegment")).alias("author"), F.array(F.lit(" a "), F.lit(""), F.col("c_mktsegment")).alias("keywords"), (n * 2).alias("length"),
        F.when(n % 2 == 0, "5/1/2024").alias("publish_date"),
    )
    probes = t("customer").select(
        n.alias("video_id"), F.concat(n.cast("string"), F.lit(".mp4")).alias("filename"), (n * 1000).alias("file_size_bytes"), *[F.when(n % 5 != 0, v).alias(c) for c, v in {"duration_sec": n * 0.5, "fps": n % 7 - 0.5, "frame_count": n}.items()],
        *[F.when(n % 10 != 0, n).alias(c) for c in ("width", "height")], F.when(n % 10 != 0, n % 2 == 0).otherwise(none.cast("boolean")).alias("is_vfr"),
    )
    return records.records(probes, records.organiser_fields(raw))


@query("""
    SELECT c_custkey AS video_id, '1' AS metadata_schema_version, c_custkey % 4 <> 0 AS organizer_metadata_present, c_custkey % 4 = 0 AS metadata_generated, c_custkey * 1000 AS file_size_bytes,
           CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 0.5::DOUBLE END AS duration_sec, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 7 - 0.5::DOUBLE END AS fps, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS frame_count,
           CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS width, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS height, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 2 = 0 END AS is_vfr,
           CASE WHEN c_custkey % 10 = 0 THEN 'failed' WHEN c_custkey % 5 = 0 THEN 'partial' ELSE 'pass' END AS probe_status FROM customer""")
def record_inventory(t):
    return records.inventory(_records(t))


@query("""
    SELECT 'records' AS "table", c AS "check", v::BIGINT AS violations FROM (
      SELECT 'null:schema_version' AS c, 0 AS v UNION ALL SELECT 'null:video_id', 0 UNION ALL SELECT 'blank:video_id', 0 UNION ALL SELECT 'rule:status', 0 UNION ALL SELECT 'rule:size', 0
      UNION ALL SELECT 'rule:rate', (SELECT count(*) FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0) UNION ALL SELECT 'rule:duration', 0 UNION ALL SELECT 'rule:generated', 0 UNION ALL SELECT 'unique:video_id', 0)""")
def record_faults(t):
    return records.record_faults(_records(t).withColumn("video_id", F.col("video_id").cast("string")))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'malformed' WHEN 1 THEN 'unexpected' END AS fault FROM events")
def strict_json(t):
    raw = F.when(F.col("event_id") % 4 == 0, "{broken").when(F.col("event_id") % 4 == 1, '{"k": 1, "x": 2}').otherwise(F.col("props"))
    return records.strict_rows(t("events").select("event_id", raw.alias("raw")), "raw", "k bigint").select("event_id", "fault")


@query("""
    WITH x AS (SELECT event_id, ['auto', 'English ', 'vietnamese'][event_id % 3 + 1] AS l, CASE event_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS c, CASE WHEN event_id % 5 = 0 THEN 'english' ELSE 'vietnamese' END AS d FROM events),
    y AS (SELECT *, lower(trim(l)) AS language, coalesce(c, lower(trim(l)) <> 'english') AS wanted FROM x),
    z AS (SELECT *, CASE WHEN NOT wanted THEN 'not_checked' WHEN c IS NOT NULL THEN 'vietnamese' WHEN language = 'auto' THEN d ELSE language END AS detected FROM y)
    SELECT event_id, 'con chim' AS text, language, detected, wanted AND detected <> 'english' AS translate FROM z""")
def query_plans(t):
    n = F.col("event_id")
    plan = text.query_plan(F.lit(" con  chim\n"), F.get(F.array(F.lit("auto"), F.lit("English "), F.lit("vietnamese")), (n % 3).cast("int")), F.when(n % 5 == 0, "english").otherwise("vietnamese"), F.when(n % 4 == 0, True).when(n % 4 == 1, False))
    return t("events").select("event_id", plan.alias("p")).select("event_id", "p.*")


@query("""
    WITH s AS (SELECT video_id, shot_index, shot_index % 3 AS words FROM {shots}), p AS (SELECT *, lead(words) OVER (PARTITION BY video_id ORDER BY shot_index) AS w2 FROM s)
    SELECT video_id, shot_index AS gap, 'SPEECH_GAP_EVIDENCE:' || chr(10) || 'LEFT_WORDS: ' || words || chr(10) || 'RIGHT_WORDS: ' || w2 || chr(10) || 'SILENCE_SEC: 2.000' || chr(10) || 'SHARED_SEGMENTS: <NONE>' || chr(10) || 'CONTINUES: NO' AS body FROM p WHERE w2 IS NOT NULL""")
def speech_gap_bodies(t):
    i = F.col("shot_index")
    d = t("shots").select("video_id", "shot_index", (i % 3).alias("words"), (i * 10.0 + 1).alias("first_word_sec"), (i * 10.0 + 9).alias("last_word_sec"), F.array(i).alias("segments"))
    g = sequences.speech_gaps(d)
    lines = {"left_words": F.col("left_words").cast("string"), "right_words": F.col("right_words").cast("string"), "silence_sec": F.format_string("%.3f", "silence_sec"), "shared_segments": F.array_join(F.col("shared_segments").cast("array<string>"), ", "), "continues": text.yes_no(F.col("continues"))}
    return g.select("video_id", "gap", text.labelled_lines("SPEECH_GAP_EVIDENCE:", lines).alias("body"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'a b' ELSE '' END AS text, '/data/images/' || event_id || '.jpg' AS path FROM events")
def recognised_texts(t):
    n = F.col("event_id")
    blocks = F.when(n % 3 == 1, F.array(F.lit(" a"), F.lit(" "), F.lit("b ")))
    return t("events").select("event_id", text.recognised_text(F.when(n % 3 == 0, F.concat(F.lit(" "), "event_type")).otherwise(" "), blocks).alias("text"), records.image_path("/data/", F.concat(F.lit("images/"), n.cast("string"), F.lit(".jpg"))).alias("path"))


@query("SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN 'three four' WHEN 1 THEN 'One, two three four' END AS words FROM embeddings")
def trimmed_prefixes(t):
    n = F.col("vec_id")
    d = t("embeddings").select("vec_id", text.without_prefix(F.split(F.lit("One, two three four"), " "), F.when(n % 3 == 0, "one TWO").when(n % 3 == 1, "").otherwise("no such")).alias("w"))
    return d.select("vec_id", F.array_join("w", " ").alias("words"))
