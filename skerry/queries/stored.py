"""Feature rows, sinks that are written and read again, unions of shards, reviews, and records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skerry.functions import text, vectors
from skerry.operators import events, evidence, features, setops
from skerry.plans import packing
from skerry.queries.base import query
from skerry.queries.evidences import _FRAMES_SQL, frames
from skerry.sources import clustered, records, release
from skerry.sources.shared import new_path


def _path(t, name: str) -> str:
    """A new folder below the one that driver and executors share."""
    return new_path(t.spark, name)


# ---- clustered tables


@query("SELECT vector_id, rank, entity, score FROM {detections} WHERE entity IN ('NF', 'RF') AND score >= 0.9")
def clustered_ranges(t):
    """Detections laid out by entity, score and vector; a look-up by two of the keys, with column filters that reach the scan."""
    path = _path(t, "clustered")
    clustered.write(t("detections"), path, ["entity", "score", "vector_id"], ["vector_id"], files=16)
    return t.spark.read.parquet(path).filter("entity IN ('NF', 'RF') AND score >= 0.9")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50 AND l_discount >= 0.1)")
def clustered_points(t):
    """Orders laid out by date and price, with a Bloom filter of their keys; look-ups by key from another table."""
    path = _path(t, "clustered")
    clustered.write(t("orders"), path, ["o_orderdate", "o_totalprice"], ["o_orderkey"], files=16)
    wanted = t("lineitem").filter("l_quantity >= 50 AND l_discount >= 0.1").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.spark.read.parquet(path).join(wanted, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most FROM lineitem" for c in ("l_orderkey", "l_quantity", "l_discount", "l_tax")))
def column_statistics(t):
    return clustered.statistics(t("lineitem"), ["l_orderkey", "l_quantity", "l_discount", "l_tax"]).drop("distinct")


# ---- feature rows

_FOUND_SQL = """(SELECT 'k' || vector_id AS keyframe_id, video_id, frame_idx AS frame_id, embedding, vector_id % 11 = 0 OR vector_id % 13 = 0 AS failed, vector_id FROM {keyframes}) x"""


def _features(t):
    k = t("keyframes").withColumn("keyframe_id", F.concat(F.lit("k"), "vector_id"))
    # every eleventh keyframe has an error, every thirteenth was not found at all
    found = k.filter("vector_id % 13 <> 0").select(
        "keyframe_id", F.col("embedding").alias("vector"), F.concat(F.lit("sign "), F.col("vector_id") % 5).alias("text"), F.lit(None).cast("string").alias("language"), ((F.col("vector_id") % 10) / 10).alias("text_confidence"),
        F.when(F.col("vector_id") % 3 != 0, "car").alias("label"), F.lit(0.5).alias("confidence"), F.when(F.col("vector_id") % 11 == 0, "unreadable").alias("error"),
    )
    return features.feature_rows(k.select("keyframe_id", "video_id", F.lit(None).cast("string").alias("shot_id"), F.col("frame_idx").alias("frame_id")), found, 64, "clip")


@query(f"""
    SELECT keyframe_id, video_id, frame_id, CASE WHEN failed THEN 'failed' ELSE 'pass' END AS status, keyframe_id || CASE WHEN failed THEN '_failed' ELSE '_clip' END AS embedding_id, 64::BIGINT AS size,
           CASE WHEN failed THEN 0.0::DOUBLE ELSE round(list_sum(CAST(embedding AS DOUBLE[])), 4) END AS total, CASE WHEN failed THEN '' ELSE 'sign ' || (vector_id % 5) END AS text, 'vi' AS language,
           CASE WHEN NOT failed THEN vector_id % 10 / 10.0::DOUBLE END AS text_confidence, CASE WHEN failed OR vector_id % 3 = 0 THEN '' ELSE 'car' END AS label, CASE WHEN failed THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS confidence
    FROM {_FOUND_SQL}""")
def feature_rows(t):
    total = F.round(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double")), 4)
    return _features(t).select("keyframe_id", "video_id", "frame_id", "status", "embedding_id", F.size("vector").alias("size"), total.alias("total"), "text", "language", "text_confidence", "label", "confidence")


@query(f"SELECT video_id, count(*) AS rows, count(*) FILTER (failed) AS failed, CASE WHEN count(*) FILTER (failed) > 0 THEN 'partial' ELSE 'pass' END AS status FROM {_FOUND_SQL} GROUP BY video_id")
def feature_status(t):
    return features.video_status(_features(t))


@query(f"""
    SELECT video_id, 'keyframe' AS entity_type, keyframe_id AS entity_id, 'ocr' AS source_type, CASE WHEN failed THEN '' ELSE 'sign ' || (vector_id % 5) END AS text, CASE WHEN failed THEN 'failed' ELSE 'pass' END AS status FROM {_FOUND_SQL}
    UNION ALL SELECT video_id, 'keyframe', keyframe_id, 'object_labels', CASE WHEN failed OR vector_id % 3 = 0 THEN '' ELSE 'car' END, CASE WHEN failed THEN 'failed' ELSE 'pass' END FROM {_FOUND_SQL}
    UNION ALL SELECT video_id, 'video', video_id, 'video_title', author, 'pass' FROM {{videos}} UNION ALL SELECT video_id, 'video', video_id, 'video_description', '', 'pass' FROM {{videos}}
    UNION ALL SELECT video_id, 'video', video_id, 'video_keywords', collection_id, 'pass' FROM {{videos}}""")
def feature_texts(t):
    metadata = t("videos").select("video_id", F.col("author").alias("title"), F.lit(None).cast("string").alias("description"), F.col("collection_id").alias("keywords"))
    return features.text_sources(_features(t), metadata)


@query(f"""
    WITH p AS (SELECT *, lead(keyframe_id) OVER w AS right_id, lead(image) OVER w AS i2, lead(status) OVER w AS s2, lead(words) OVER w AS w2 FROM {_FRAMES_SQL} WINDOW w AS (PARTITION BY shot_id ORDER BY time, frame_id)),
    q AS (SELECT *, bit_count(xor(image, i2)) / 64.0::DOUBLE AS visual, list_filter(string_split(lower(words), ' '), lambda x: x <> '') AS a, list_filter(string_split(lower(w2), ' '), lambda x: x <> '') AS b, status <> 'failed' AND s2 <> 'failed' AS ok FROM p WHERE right_id IS NOT NULL),
    r AS (SELECT shot_id, keyframe_id AS left_id, right_id, time, frame_id, visual, CASE WHEN ok THEN CASE WHEN len(a) = 0 AND len(b) = 0 THEN 0 ELSE 1 - len(list_intersect(a, b)) / greatest(1, len(list_distinct(list_concat(a, b))))::DOUBLE END END AS changed FROM q),
    c AS (SELECT *, greatest(visual, coalesce(changed, 0)) AS strength FROM r WHERE visual >= 0.1 OR coalesce(changed >= 0.6, FALSE)),
    ends AS (SELECT shot_id, left_id AS keyframe_id, strength, time, frame_id, 0 AS side FROM c UNION ALL SELECT shot_id, right_id, strength, time, frame_id, 1 FROM c),
    power AS (SELECT shot_id, keyframe_id, max(strength) AS power FROM ends GROUP BY ALL),
    places AS (
      SELECT f.shot_id, f.keyframe_id, CASE WHEN is_representative THEN 0 ELSE 1 END AS tier, CASE WHEN is_representative THEN 0 ELSE coalesce(power, 0) END AS strength, f.time, f.frame_id, 0 AS side
      FROM {_FRAMES_SQL} LEFT JOIN power p ON p.shot_id = f.shot_id AND p.keyframe_id = f.keyframe_id WHERE is_representative OR is_supplemental
      UNION ALL SELECT shot_id, keyframe_id, 2, strength, time, frame_id, side FROM ends),
    first AS (SELECT * FROM places QUALIFY row_number() OVER (PARTITION BY shot_id, keyframe_id ORDER BY tier, strength DESC, time, frame_id, side) = 1),
    turns AS (SELECT *, row_number() OVER (PARTITION BY shot_id ORDER BY tier, strength DESC, time, frame_id, side, keyframe_id) AS turn FROM first)
    SELECT shot_id, keyframe_id FROM turns WHERE turn <= 4""")
def source_frames(t):
    f = frames(t)
    return evidence.source_frames(f, evidence.pair_signals(f, 0.1, 0.6), 4).select("shot_id", "keyframe_id")


# ---- sinks and readers


@query("SELECT vector_id, video_id, keyframe_no::BIGINT AS keyframe_no, frame_idx FROM {keyframes}")
def stored_table(t):
    """zstd Parquet, files of a bounded number of rows, partitioned by collection."""
    path = _path(t, "table")
    release.write_table(t("keyframes").drop("embedding"), path, rows_per_file=8192, partition_by=("collection_id",))
    return t.spark.read.parquet(path).select("vector_id", "video_id", "keyframe_no", "frame_idx")


@query("SELECT video_id, keyframe_no::BIGINT AS n, pts_time_sec AS pts_time, fps, frame_idx FROM {keyframes}")
def stored_maps(t):
    """Frame maps: one CSV folder per video, its name taken from the path."""
    path = _path(t, "maps")
    d = t("keyframes").select("video_id", F.col("keyframe_no").alias("n"), F.col("pts_time_sec").alias("pts_time"), "fps", "frame_idx")
    d.repartition("video_id").write.partitionBy("video_id").option("header", True).csv(path)
    back = t.spark.read.schema(release.MAP_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(f"{path}/*")
    return back.select(F.regexp_extract(F.col("_metadata.file_path"), "video_id=([^/]+)/", 1).alias("video_id"), "n", "pts_time", "fps", "frame_idx")


@query("SELECT video_id, author FROM {videos}")
def stored_json(t):
    path = _path(t, "json")
    t("videos").select("video_id", "author").write.json(path)
    return release.read_json_rows(t.spark, path, "video_id string, author string")


@query("SELECT video_id || ',' || frame_idx AS line FROM {keyframes} WHERE keyframe_no = 1")
def stored_answers(t):
    path = _path(t, "answers")
    d = t("keyframes").filter("keyframe_no = 1").select(F.concat_ws(",", "video_id", "frame_idx").alias("line"))
    release.write_lines(d, path)
    return t.spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT vector_id, collection_id FROM {keyframes}")
def stored_shards(t):
    """Shards of a table written apart and read as one."""
    paths = []
    for c in ("L00", "L01"):
        paths.append(_path(t, "shard"))
        release.write_table(t("keyframes").filter(F.col("collection_id") == c).select("vector_id", "collection_id"), paths[-1])
    return release.shards(t.spark, "vector_id long, collection_id string", *paths)


@query("SELECT count(*) AS files, sum(n)::BIGINT AS size FROM (SELECT length(lower(author)) + 1 AS n FROM {videos})")
def stored_files(t):
    """A listing of written files, and their checksums against those of their content."""
    path = _path(t, "files")
    t("videos").select("video_id", F.lower("author").alias("value")).repartition("video_id").write.partitionBy("video_id").text(path)
    listed, summed = release.listed(t.spark, path, "*.txt"), release.files(t.spark, path, "*.txt")
    return listed.join(summed.select("path", "sha256"), "path").filter(F.length("sha256") == 64).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size"))


# ---- unions, vectors, records, reviews


@query("SELECT doc_id AS id, left(lang, 2) AS kind, 0::BIGINT AS source FROM documents UNION ALL SELECT page_id, 'pg', 1 FROM pages")
def stacked_tables(t):
    a = t("documents").select(F.col("doc_id").alias("id"), F.substring("lang", 1, 2).alias("kind"))
    return setops.stacked(a, t("pages").select(F.col("page_id").alias("id"), F.lit("pg").alias("kind")))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 6) AS norm, 1.0::DOUBLE AS after FROM embeddings")
def unit_vectors(t):
    d = t("embeddings").select("vec_id", "embedding", vectors.unit(F.col("embedding")).alias("u"))
    return d.select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"), F.round(vectors.norm(F.col("u")), 6).alias("after"))


@query("SELECT vector_id, '/data/frames/' || video_id || '/' || printf('%03d', keyframe_no) || '.jpg' AS path FROM {keyframes}")
def image_paths(t):
    relative = F.concat(F.lit("/"), "video_id", F.lit("/"), F.format_string("%03d", "keyframe_no"), F.lit(".jpg"))
    return t("keyframes").select("vector_id", records.image_path("/data/frames/", relative).alias("path"))


@query("SELECT video_id, 'VIDEO' || chr(10) || 'AUTHOR: ' || CASE WHEN author = '' THEN '<NONE>' ELSE author END || chr(10) || 'DATED: ' || CASE WHEN publish_date_iso <> '' THEN 'YES' ELSE 'NO' END AS body FROM {videos}")
def labelled_evidence(t):
    return t("videos").select("video_id", text.labelled_lines("VIDEO", {"author": F.col("author"), "dated": text.yes_no(F.col("publish_date_iso") != "")}).alias("body"))


@query(r"""
    WITH k AS (SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS e FROM conversations),
    l AS (SELECT conv_id, coalesce(list(e ORDER BY turn, e) FILTER (e <> ''), []) AS x FROM k GROUP BY conv_id)
    SELECT conv_id, len(x) AS found, CASE WHEN len(x) BETWEEN 1 AND 6 THEN sha256(array_to_string(x, chr(30))) END AS events FROM l""")
def event_texts(t):
    """A conversation's turns as the events of a search: blank ones go, the rest is trimmed; more than six are no search."""
    d = t("conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("texts"))
    d = d.select("conv_id", events.event_lists(F.col("texts")).alias("e"))
    return d.select("conv_id", F.col("e.found").alias("found"), F.sha2(F.array_join("e.events", "\x1e"), 256).alias("events"))


@query("SELECT video_id, frame_id AS gap, CASE WHEN video_id % 3 = 0 THEN frame_id % 4 = 0 ELSE value_ms % 2 = 0 END AS boundary FROM {timeline}")
def degenerate_reviews(t):
    """Videos with a suspicious partition are judged anew."""
    gaps = t("timeline").select("video_id", F.col("frame_id").alias("gap"), (F.col("value_ms") % 2 == 0).alias("boundary"))
    quality = t("timeline").select("video_id").distinct().withColumn("suspicious", F.col("video_id") % 3 == 0)
    return packing.degenerate_reviews(gaps, quality, lambda g: g.withColumn("boundary", F.col("gap") % 4 == 0))


@query("""
    SELECT event_id, attempt, CASE WHEN value < 1 THEN value WHEN attempt > 7 THEN 60 ELSE least(60, 2 ** (attempt - 1)) END::DOUBLE AS delay
    FROM (SELECT event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events WHERE event_type = 'error')""")
def retry_delays(t):
    """Every error of a user is an attempt more; a value below one is a wait that the other side asked for."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    d = t("events").filter("event_type = 'error'").withColumn("attempt", F.row_number().over(order))
    return d.select("event_id", "attempt", packing.retry_delays(F.col("attempt"), F.when(F.col("value") < 1, F.col("value"))).alias("delay"))
