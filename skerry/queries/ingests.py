"""Ingest from a manifest, opened releases, probe rows and packages: each is written, read again and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.queries.base import query
from skerry.queries.records import _records
from skerry.sources import ingest, opening, packages, probes, records
from skerry.sources.shared import new_path

# ---- a canonical manifest


def _ingested(t):
    """Customers as videos: the manifest lacks every 19th and repeats every 23rd, the inventory lacks every 13th and has a few other facts, paths and timelines."""
    n = F.col("video_id")
    path = new_path(t.spark, "canonical")
    found = _records(t)
    flat = records.inventory(found)
    lines = flat.filter(n % 19 != 0).select(
        n.cast("string").alias("video_id"), F.concat(F.lit("/store/videos/"), n, F.lit(".mp4")).alias("video_path"), F.concat(F.lit("store/meta/"), n, F.lit(".json")).alias("metadata_path"),
        F.when(n % 17 == 0, "failed").when(n % 3 == 0, "pass").when(n % 3 == 1, "skipped").alias("status"), (n * 3).alias("metadata_size_bytes"), F.when(n % 3 == 0, F.concat(F.lit("store/frames/"), n, F.lit(".parquet"))).alias("frame_timeline_path"),
    )
    lines.unionAll(lines.filter("CAST(video_id AS BIGINT) % 23 = 0")).write.json(f"{path}/manifest")
    stored = flat.filter(n % 13 != 0).withColumns({
        "width": F.when(n % 11 == 0, F.col("width") + 1).otherwise(F.col("width")), "fps": F.when(n % 31 == 0, F.col("fps") * 1.01).otherwise(F.col("fps")),
        "canonical_video_path": F.concat(F.lit("videos/"), F.when(n % 29 == 0, n + 1).otherwise(n), F.lit(".mp4")), "canonical_metadata_path": F.concat(F.lit("/store/meta/"), n, F.lit(".json")),
        "canonical_frame_timeline_path": F.when(n % 21 == 0, F.concat(F.lit("frames/other"), n)).when(n % 6 == 0, F.concat(F.lit("frames/"), n, F.lit(".parquet"))),
        "frame_timeline_status": F.when(n % 6 == 0, "pass"), "frame_timeline_row_count": F.when(n % 6 == 0, F.when(n % 15 == 0, n + 1).otherwise(n)), "video_id": n.cast("string"),
    })
    # the newest revision of the inventory lacks a quarter of the videos, an older one has all
    stored.filter("CAST(video_id AS BIGINT) % 4 <> 1").write.parquet(f"{path}/new")
    stored.write.parquet(f"{path}/old")
    inventory = ingest.newest({"main": t.spark.read.parquet(f"{path}/new"), "before": t.spark.read.parquet(f"{path}/old")}, "video_id")
    timelines = flat.filter((n % 3 == 0) & (n % 9 != 0)).select(n.cast("string").alias("video_id"), n.alias("rows"))
    described = flat.withColumn("filename", F.concat(n, F.lit(".mp4"))).withColumn("video_id", n.cast("string"))
    return ingest.ingested(ingest.manifest_rows(t.spark, f"{path}/manifest", "store"), inventory, described, timelines, prefix="store")


_INGEST_SQL = """
    WITH x AS (SELECT c_custkey AS n, c_custkey % 19 <> 0 AND c_custkey % 17 <> 0 AS m, c_custkey % 13 <> 0 AS i, CASE WHEN c_custkey % 10 = 0 THEN 'failed' WHEN c_custkey % 5 = 0 THEN 'partial' ELSE 'pass' END AS probe FROM customer),
    y AS (SELECT *, CASE WHEN NOT m THEN 'not in manifest' WHEN NOT i THEN 'not in inventory' WHEN n % 23 = 0 THEN 'manifest row repeats' WHEN n % 29 = 0 THEN 'video path'
                         WHEN n % 31 = 0 AND n % 5 <> 0 AND n % 7 - 0.5 <> 0 THEN 'field fps' WHEN n % 11 = 0 AND n % 10 <> 0 THEN 'field width'
                         WHEN n % 21 = 0 THEN 'timeline path' WHEN n % 9 = 0 THEN 'timeline is not stored' WHEN n % 15 = 0 AND n % 6 = 0 THEN 'timeline rows' END AS conflict
          FROM x WHERE m OR i)"""


@query(_INGEST_SQL + """
    SELECT n::VARCHAR AS video_id, CASE WHEN conflict IS NOT NULL THEN 'conflict' WHEN probe <> 'pass' THEN 'warning' ELSE 'pass' END AS status, coalesce(conflict, CASE WHEN probe <> 'pass' THEN 'probe ' || probe END) AS reason,
           CASE WHEN i THEN CASE WHEN n % 4 = 1 THEN 'before' ELSE 'main' END END AS revision FROM y""")
def manifest_verdicts(t):
    """One row per video: whether manifest, inventory, metadata and timeline agree, else the first reason why not."""
    return _ingested(t).verdicts


@query(_INGEST_SQL + """
    SELECT n::VARCHAR AS video_id, 'media://raw_videos/' || n || '.mp4' AS video_ref, 'media://metadata/' || n || '.json' AS metadata_ref, n || '.mp4' AS video_filename, n || '.json' AS metadata_filename, n * 1000 AS video_size_bytes, n * 3 AS metadata_size_bytes,
           CASE WHEN n % 4 = 1 THEN 'before' ELSE 'main' END AS canonical_revision, 'videos/' || n || '.mp4' AS canonical_video_path, 'meta/' || n || '.json' AS canonical_metadata_path, CASE WHEN n % 3 = 0 THEN 'frames/' || n || '.parquet' END AS canonical_frame_timeline_path,
           '1' AS metadata_schema_version, n % 4 <> 0 AS organizer_metadata_present, n % 4 = 0 AS metadata_generated, probe AS probe_status FROM y WHERE conflict IS NULL""")
def manifest_media(t):
    """The media table of the videos that agree, written and read again."""
    path = new_path(t.spark, "media")
    _ingested(t).media.write.parquet(path)
    return t.spark.read.parquet(path)


@query(_INGEST_SQL + """
    SELECT count(*) FILTER (conflict IS NULL) AS videos, count(*) FILTER (conflict IS NULL AND probe <> 'pass') AS warnings, count(*) FILTER (conflict IS NOT NULL) AS conflicts, count(*) FILTER (conflict IS NULL AND n % 4 <> 0) AS organizer_metadata,
           count(*) FILTER (conflict IS NULL AND n % 4 = 0) AS metadata_generated, count(*) FILTER (conflict IS NULL AND n % 3 = 0) AS timelines, coalesce(sum(n) FILTER (conflict IS NULL AND n % 3 = 0), 0)::BIGINT AS timeline_rows FROM y""")
def manifest_report(t):
    return ingest.report(_ingested(t))


# ---- an opened release


def _release(t, mark: str) -> str:
    """A release of the documents' texts in 16 files; the texts of the first four are marked."""
    root, at = new_path(t.spark, "release"), F.col("doc_id") % 16
    text = F.concat(F.coalesce("text", F.lit("")), F.when(at < 4, mark).otherwise(""))
    d = t("documents").select(at.alias("part"), "doc_id", text.alias("value")).repartition("part").sortWithinPartitions("part", "doc_id")
    d.select("part", "value").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("part").text(root)
    opening.publish(t.spark, root, mark or "plain")
    return root


@query("""
    WITH d AS (SELECT doc_id % 16 AS part, strlen(coalesce(text, '')) + 1 AS size FROM documents), a AS (SELECT count(DISTINCT part)::BIGINT AS files, count(DISTINCT part) FILTER (part < 4)::BIGINT AS marked, sum(size)::BIGINT AS size, count(*) FILTER (part < 4)::BIGINT AS marks FROM d)
    SELECT 1::BIGINT AS opening, 'plain' AS release, files AS copied, files, size FROM a UNION ALL SELECT 2, 'plain', 0, files, size FROM a
    UNION ALL SELECT 3, '*', marked, files, size + marks FROM a UNION ALL SELECT 4, 'plain', 0, files, size FROM a""")
def opened_releases(t):
    """Two releases that share most of their files, opened in turn into one copy: artifacts copied, and what the copy holds whole."""
    cache, plain, other = new_path(t.spark, "copy"), _release(t, ""), _release(t, "*")
    rows = []
    for k, root in enumerate((plain, plain, other, plain), 1):
        done = opening.opened(t.spark, root, cache)
        whole = done.files.filter(F.sha2("content", 256) == F.col("sha256")).agg(F.count(F.lit(1)), F.sum(F.length("content"))).first()
        rows.append((k, done.manifest["release_id"], done.copied, *whole))
    return t.rows(rows, "opening long, release string, copied long, files long, size long")


@query("""
    SELECT part, 'sha256' AS fault FROM (SELECT DISTINCT doc_id % 16 AS part FROM documents WHERE doc_id % 16 = 1)
    UNION ALL SELECT part, 'missing' FROM (SELECT DISTINCT doc_id % 16 AS part FROM documents WHERE doc_id % 16 = 2) UNION ALL SELECT part, 'unlisted' FROM (SELECT DISTINCT doc_id % 16 + 100 AS part FROM documents WHERE doc_id % 16 = 3)""")
def release_faults(t):
    """What the sums of a release say after one file was altered, one was lost and one was added."""
    root = _release(t, "")
    listed, found = opening.manifest_rows(t.spark, root)[1], opening.artifacts(t.spark, root).drop("content")
    part = F.regexp_extract("path", r"part=(\d+)/", 1).cast("int")
    found = found.filter(part != 2).withColumn("sha256", F.when(part == 1, F.reverse("sha256")).otherwise(F.col("sha256")))
    added = found.filter(part == 3).withColumn("path", F.regexp_replace("path", r"part=3/", "part=103/"))
    return opening.faults(listed, found.unionByName(added)).select(part.alias("part"), "fault")


# ---- frame rows of probe output

_LINES_SQL = """(SELECT video_id, event_id, frame_id AS line, CASE WHEN value_ms % 7 = 0 THEN NULL ELSE value_ms / 1000.0::DOUBLE END AS pts, CASE WHEN value_ms % 3 = 0 THEN NULL WHEN value_ms % 3 = 1 THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END AS d FROM {timeline}) l"""


@query(f"SELECT video_id::VARCHAR AS video_id, row_number() OVER (PARTITION BY video_id ORDER BY line) - 1 AS frame_id, pts AS pts_time, d AS duration_time FROM {_LINES_SQL} WHERE pts IS NOT NULL")
def probe_rows(t):
    """A CSV of frames per video, some without a time; rows are numbered in the file's order."""
    path, v = new_path(t.spark, "probes"), F.col("value_ms")
    time = F.when(v % 7 == 0, "N/A").otherwise((v / 1000).cast("string"))
    line = F.concat_ws(",", time, F.when(v % 3 == 1, "0.4").otherwise("N/A"), F.when(v % 3 != 0, "0.2"))
    probes.write_lines(t("timeline").select("video_id", "frame_id", line.alias("value")), path)
    return probes.frame_rows(t.spark, path)


# ---- packages


def _payload(t):
    """Per video a file of frames for each of three kinds of events."""
    d = t("timeline").groupBy("video_id", (F.col("frame_id") % 3).alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("frame_id", "event_type"))), lambda x: x["event_type"]), "\n").alias("text"))
    return d.select(F.concat(F.lit("v"), "video_id").alias("video_id"), F.concat(F.lit("frames/part"), "part", F.lit(".txt")).alias("path"), F.col("text").cast("binary").alias("content"))


_PAYLOAD_SQL = """(SELECT video_id AS v, frame_id % 3 AS part, 'v' || video_id AS video_id, 'frames/part' || (frame_id % 3) || '.txt' AS path, string_agg(event_type, chr(10) ORDER BY frame_id) AS text FROM {timeline} GROUP BY video_id, frame_id % 3) p"""


@query(f"SELECT video_id, path, length(text) AS size, sha256(text) AS sha256 FROM {_PAYLOAD_SQL}")
def package_payload(t):
    """Packages are written, checked, and their files read again."""
    path = new_path(t.spark, "packages")
    packages.write_packages(_payload(t), path, "frames", batch_id="b1", status="pass")
    return packages.payload(t.spark, path).select("video_id", "path", F.length("content").alias("size"), F.sha2("content", 256).alias("sha256"))


@query(f"""
    SELECT video_id || '_frames.zip' AS package, video_id || '/' || path AS path, CASE WHEN v % 5 = 0 AND part = 0 THEN 'missing' WHEN v % 5 = 1 AND part = 1 THEN 'no checksum' WHEN v % 5 = 2 AND part = 2 THEN 'altered' ELSE 'not in manifest' END AS fault
    FROM {_PAYLOAD_SQL} WHERE (v % 5 = 0 AND part = 0) OR (v % 5 = 1 AND part = 1) OR (v % 5 = 2 AND part = 2) OR (v % 5 = 3 AND part = 0)
    UNION ALL SELECT DISTINCT video_id || '_frames.zip', NULL, 'not a ZIP' FROM {_PAYLOAD_SQL} WHERE v % 5 = 4""")
def package_faults(t):
    """What the three listings of written packages say after files were lost, added, altered, or left out of a manifest."""
    path = new_path(t.spark, "packages")
    packages.write_packages(_payload(t), path, "frames")
    d = packages.listings(t.spark, path)
    v, n = F.regexp_extract("package", r"v(\d+)_", 1).cast("int") % 5, F.regexp_extract("path", r"part(\d)", 1).cast("int")
    for k, part, which in ((0, 0, "payload"), (1, 1, "checksums"), (3, 0, "manifest")):
        d = d.filter(~((v == k) & (n == part) & (F.col("part") == which)))
    d = d.withColumn("sha256", F.when((v == 2) & (n == 2) & (F.col("part") == "payload"), "0").otherwise(F.col("sha256")))
    # every video has a frame 0, so one row of each broken package is left
    whole = v != 4
    d = d.filter(whole | ((F.col("part") == "payload") & (n == 0)))
    broken = {"part": F.lit("fault"), "path": F.lit("not a ZIP"), "size": F.lit(None).cast("long"), "sha256": F.lit(None).cast("string")}
    return packages.package_faults(d.withColumns({c: F.when(whole, F.col(c)).otherwise(x) for c, x in broken.items()}))
