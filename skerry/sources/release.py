"""Sources and sinks of a release: frame maps, metadata JSON, detections, shards, vectors, manifests, artifacts."""

from __future__ import annotations

import hashlib
import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Column-exact schemas of the runtime release; scores and boxes are doubles.
SCHEMAS = {
    "videos": "video_id string, collection_id string, title string, author string, channel_id string, channel_url string, description string, keywords_json string, duration_sec bigint, publish_date_raw string, publish_date_iso string, thumbnail_url string, watch_url string",
    "keyframes": "vector_id bigint, keyframe_id string, video_id string, collection_id string, keyframe_no int, frame_idx bigint, pts_time_sec double, fps double, width int, height int, image_relpath string",
    "detections": "keyframe_id string, rank int, entity string, class_mid string, class_label int, score double, ymin double, xmin double, ymax double, xmax double",
}
MAP_SCHEMA = "n int, pts_time double, fps double, frame_idx bigint"


def _stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1)


def read_maps(spark: SparkSession, path: str) -> DataFrame:
    """Frame maps, one CSV per video named by it: video_id, n, pts_time, fps, frame_idx."""
    return spark.read.schema(MAP_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path).select(_stem().alias("video_id"), "n", "pts_time", "fps", "frame_idx")


def map_faults(maps: DataFrame) -> DataFrame:
    """Videos whose n is not 1..N."""
    d = maps.groupBy("video_id").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.countDistinct("n").alias("kinds"))
    return d.filter("NOT (lo = 1 AND hi = rows AND kinds = rows)").select("video_id", "rows", "lo", "hi")


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a broken line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def video_rows(metadata: DataFrame) -> DataFrame:
    """Metadata records as videos rows: nothing is null, keywords as a JSON list, the date as ISO or ''."""
    from skerry.functions.scalars import iso_or_empty

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return metadata.select(
        "video_id", F.split_part("video_id", F.lit("_"), F.lit(1)).alias("collection_id"), *[text(c).alias(c) for c in ("title", "author", "channel_id", "channel_url", "description")],
        F.to_json(F.coalesce("keywords", F.array().cast("array<string>"))).alias("keywords_json"), F.coalesce(F.col("length").cast("long"), F.lit(0).cast("long")).alias("duration_sec"),
        text("publish_date").alias("publish_date_raw"), iso_or_empty(text("publish_date")).alias("publish_date_iso"), text("thumbnail_url").alias("thumbnail_url"), text("watch_url").alias("watch_url"),
    )


class Detections(NamedTuple):
    rows: DataFrame
    malformed: DataFrame


def detections(raw: DataFrame, threshold: float) -> Detections:
    """raw(keyframe_id, five parallel arrays of text) -> rows of at least the threshold with rank from 1, and the malformed ones per keyframe.

    Rows below the threshold go before they are checked; a NaN score is not below it and is malformed.
    """
    names = ["detection_class_entities", "detection_class_names", "detection_class_labels", "detection_scores", "detection_boxes"]
    d = raw.select("keyframe_id", F.posexplode(F.arrays_zip(*names)).alias("at", "x"))
    box = F.col("x.detection_boxes")
    number = lambda c: c.cast("string").try_cast("double")
    d = d.select(
        "keyframe_id", (F.col("at") + 1).alias("rank"), F.col("x.detection_class_entities").alias("entity"), F.col("x.detection_class_names").alias("class_mid"),
        F.col("x.detection_class_labels").try_cast("int").alias("class_label"), number(F.col("x.detection_scores")).alias("score"),
        *[number(F.get(box, F.lit(k))).alias(n) for k, n in enumerate(("ymin", "xmin", "ymax", "xmax"))],
    )
    d = d.filter(F.col("score").isNull() | F.isnan("score") | (F.col("score") >= threshold))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    fine = finite("score") & finite("ymin") & finite("xmin") & finite("ymax") & finite("xmax") & (F.col("ymin") <= F.col("ymax")) & (F.col("xmin") <= F.col("xmax")) & F.col("class_label").isNotNull()
    return Detections(d.filter(fine), d.filter(~fine).groupBy("keyframe_id").agg(F.count(F.lit(1)).alias("malformed")))


def numbered(keyframes: DataFrame) -> DataFrame:
    """vector_id dense from 0 in (video_id, keyframe_no) order: counts per video are summed up, so only that small table is ordered as a whole."""
    counts = keyframes.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))
    start = F.coalesce(F.sum("n").over(Window.orderBy("video_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("video_id", start.alias("start"))
    place = F.row_number().over(Window.partitionBy("video_id").orderBy("keyframe_no")) - 1
    return keyframes.join(offsets, "video_id").withColumn("vector_id", F.col("start") + place).drop("start")


def shards(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """Per-video shards of a table as one; with no path an empty table of the schema."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def with_fallback(primary: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of the first table, and of the second for keys that the first lacks."""
    return primary.unionByName(other.join(primary.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def vector_map(meta: DataFrame, vectors: DataFrame) -> DataFrame:
    """Metadata and vectors paired by (video_id, ordinal); vector_id dense over videos."""
    return numbered(meta.join(vectors, ["video_id", "ordinal"]).withColumnRenamed("ordinal", "keyframe_no")).withColumnRenamed("keyframe_no", "ordinal")


def write_table(d: DataFrame, path: str, codec: str = "zstd", rows_per_file: int = 0, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    writer = d.write.mode(mode).option("compression", codec)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_lines(d: DataFrame, path: str) -> None:
    """One text file of answer lines; the answer list is capped, so one file is no burden. Never overwrites."""
    d.select("line").coalesce(1).write.mode("errorifexists").text(path)


def nested_as_json(d: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text."""
    kinds = dict(d.dtypes)
    return d.select([F.to_json(c).alias(c) if kinds[c].startswith(("array", "map", "struct")) else F.col(c) for c in d.columns])


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, stem, size, sha256 of the files below a folder."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return d.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, stem, size: a listing that reads no content."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return d.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("length").alias("size"))


def single_artifacts(d: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that have more than one artifact."""
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("artifacts")).filter("artifacts > 1")


def manifest(d: DataFrame, release_id: str) -> str:
    """Canonical JSON of the listed files of a release (name, size, sha256), which is small by nature."""
    rows = sorted((r["name"], r["size"], r["sha256"]) for r in d.select("name", "size", "sha256").toLocalIterator())
    return json.dumps({"schema_version": 1, "release_id": release_id, "files": [{"name": n, "size": s, "sha256": h} for n, s, h in rows]}, sort_keys=True)


def ready(manifest_text: str, release_id: str) -> str:
    """The READY marker of a manifest."""
    return json.dumps({"release_id": release_id, "manifest_sha256": hashlib.sha256(manifest_text.encode()).hexdigest()}, sort_keys=True)


def opened(manifest_text: str, ready_text: str) -> dict:
    """The manifest, if the READY marker agrees with it; otherwise ValueError."""
    m, r = json.loads(manifest_text), json.loads(ready_text)
    if r["manifest_sha256"] != hashlib.sha256(manifest_text.encode()).hexdigest():
        raise ValueError("READY does not match the manifest")
    if m["release_id"] != r["release_id"] or m["schema_version"] != 1:
        raise ValueError("manifest and READY differ in release or schema version")
    return m


def latest_release(candidates: DataFrame) -> DataFrame:
    """The candidate with the latest timestamp; empty if that is not unique or a timestamp is null."""
    d = candidates.agg(F.max("created").alias("newest"), F.count_if(F.col("created").isNull()).alias("unknown"))
    top = candidates.join(d, F.col("created") == F.col("newest"))
    return top.filter("unknown = 0").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("newest"))).filter("n = 1").drop("newest", "unknown", "n")


def canonical_stems(names: DataFrame) -> DataFrame:
    """names(path) -> path, stem: the file's stem, with as many parent folders before it as make it unique (all of them at most).

    The deepest path, one number, is read first: it says how many folders can be needed.
    """
    parts = F.transform(F.split(F.regexp_replace("path", r"\.[^./]*$", ""), "/"), lambda p: F.regexp_replace(p, r"[^A-Za-z0-9._-]+", "_"))
    d = names.select("path", parts.alias("parts"))
    most_depth = d.agg(F.max(F.size("parts"))).first()[0] or 1
    at = lambda k: F.array_join(F.slice("parts", F.greatest(F.size("parts") - k + 1, F.lit(1)), F.least(F.size("parts"), F.lit(k))), "__")
    options = d.select("path", F.posexplode(F.array(*[at(k) for k in range(1, most_depth + 1)])).alias("depth", "stem"))
    same = options.groupBy("depth", "stem").agg(F.count(F.lit(1)).alias("n"))
    free = options.join(same, ["depth", "stem"]).filter((F.col("n") == 1) | (F.col("depth") == most_depth - 1))
    return free.groupBy("path").agg(F.min_by("stem", "depth").alias("stem"))
