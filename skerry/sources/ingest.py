"""Ingest from a canonical manifest: JSON lines joined with a Parquet inventory, metadata records and frame timelines."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of a manifest line; the first three are required.
MANIFEST_SCHEMA = (
    "video_id string, video_path string, metadata_path string, status string, video_filename string, metadata_filename string, video_size_bytes bigint, metadata_size_bytes bigint, frame_timeline_path string"
)
#: Manifest states that count as successful; a missing one does too.
SUCCESSFUL = ("pass", "skipped")
#: What a frame timeline is to the ingest.
TIMELINE_POLICIES = ("disabled", "if-available", "required")
#: Facts that inventory and metadata record must agree on; fractions to a relative 1e-9.
FACTS = ("organizer_metadata_present", "metadata_generated", "duration_sec", "fps", "frame_count", "width", "height", "is_vfr", "file_size_bytes", "probe_status")


def relative(path: Column, prefix: str = "") -> Column:
    """A path of the store without leading slashes and without the store's prefix; blank is null."""
    plain = F.ltrim(F.trim(path), F.lit("/"))
    top = prefix.strip().strip("/")
    if top:
        plain = F.when(F.startswith(plain, F.lit(f"{top}/")), F.substring(plain, len(top) + 2, 1 << 30)).otherwise(plain)
    return F.when(plain != "", plain)


def manifest_rows(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """The lines of a manifest with their paths as the store has them; a broken line is an error, blank lines are skipped."""
    d = spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(path)
    return d.withColumns({c: relative(F.col(c), prefix) for c in ("video_path", "metadata_path", "frame_timeline_path")})


def newest(revisions: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows of several revisions of a table, the newest first: every key is taken from the first revision that has it, which is named in revision."""
    ranked = [d.withColumns({"revision": F.lit(name), "rank_": F.lit(k)}) for k, (name, d) in enumerate(revisions.items())]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    first = every.groupBy(F.col(key).alias("key_")).agg(F.min("rank_").alias("first_"))
    return every.join(first, (F.col(key) == F.col("key_")) & (F.col("rank_") == F.col("first_")), "left_semi").drop("rank_")


class Ingested(NamedTuple):
    """verdicts: video_id, status (pass, warning, conflict), reason. videos, media, timelines: the tables of videos without a conflict."""

    verdicts: DataFrame
    videos: DataFrame
    media: DataFrame
    timelines: DataFrame


def _name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def _differs(a: Column, b: Column, kind: str) -> Column:
    if kind in ("double", "float"):
        near = F.abs(a - b) <= F.greatest(F.lit(1e-9), F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b)))
        return ~F.coalesce(near, a.isNull() & b.isNull())
    return ~a.eqNullSafe(b)


def ingested(manifest: DataFrame, inventory: DataFrame, records: DataFrame, timelines: DataFrame | None = None, policy: str = "if-available", version: str = "1", prefix: str = "") -> Ingested:
    """One verdict per video of the manifest's successful rows or of the inventory; the first reason that applies.

    manifest: as of manifest_rows. inventory(video_id, canonical_video_path, canonical_metadata_path, metadata_schema_version,
    FACTS, and if it has them canonical_frame_timeline_path, frame_timeline_status, frame_timeline_row_count, revision).
    records: the metadata's flat columns (video_id, filename, FACTS), one row per video. timelines(video_id, rows): stored
    frame timelines and their lengths. All sides meet by video_id; nothing is gathered.
    """
    if policy not in TIMELINE_POLICIES:
        raise ValueError(f"policy must be one of {', '.join(TIMELINE_POLICIES)}")
    optional = {"canonical_frame_timeline_path": "string", "frame_timeline_status": "string", "frame_timeline_row_count": "bigint", "revision": "string"}
    inventory = inventory.withColumns({c: F.lit(None).cast(kind) for c, kind in optional.items() if c not in inventory.columns})
    inventory = inventory.withColumns({c: relative(F.col(c), prefix) for c in ("canonical_video_path", "canonical_metadata_path", "canonical_frame_timeline_path")})

    def once(d: DataFrame, name: str, keep: list[str]) -> DataFrame:
        """A row per video with its columns in a struct, and how many rows it has."""
        return d.groupBy("video_id").agg(F.count(F.lit(1)).alias(f"n_{name}"), F.min(F.struct(*keep)).alias(name))

    good = manifest.filter(F.col("status").isNull() | F.col("status").isin(*SUCCESSFUL))
    m = once(good, "m", [c for c in manifest.columns if c not in ("video_id", "status")])
    i = once(inventory, "i", [c for c in inventory.columns if c != "video_id"])
    r = once(records, "r", [c for c in records.columns if c != "video_id"])
    d = m.join(i, "video_id", "full").join(r, "video_id", "left")
    if timelines is None:
        timelines = manifest.sparkSession.createDataFrame([], "video_id string, rows bigint")
    d = d.join(timelines.groupBy("video_id").agg(F.max("rows").alias("timeline_rows")), "video_id", "left")
    path = F.coalesce("m.frame_timeline_path", "i.canonical_frame_timeline_path")
    d = d.withColumn("timeline_path", F.lit(None).cast("string") if policy == "disabled" else path)
    kinds = dict(records.dtypes)
    rules = [
        ("not in manifest", F.col("n_m").isNull()),
        ("not in inventory", F.col("n_i").isNull()),
        ("manifest row repeats", F.col("n_m") > 1),
        ("inventory row repeats", F.col("n_i") > 1),
        ("manifest row lacks a path", F.col("m.video_path").isNull() | F.col("m.metadata_path").isNull()),
        ("schema version", ~F.col("i.metadata_schema_version").eqNullSafe(F.lit(version))),
        ("no metadata record", F.col("n_r").isNull()),
        ("video path", ~F.col("i.canonical_video_path").eqNullSafe(F.col("m.video_path"))),
        ("metadata path", ~F.col("i.canonical_metadata_path").eqNullSafe(F.col("m.metadata_path"))),
        ("filename", ~_name(F.col("m.video_path")).eqNullSafe(F.col("r.filename"))),
        *[(f"field {c}", _differs(F.col(f"r.{c}"), F.col(f"i.{c}"), kinds[c])) for c in FACTS],
    ]
    if policy != "disabled":
        rules.append(("timeline path", F.col("m.frame_timeline_path") != F.col("i.canonical_frame_timeline_path")))
        if policy == "required":
            rules.append(("no timeline", path.isNull() | ~F.coalesce((F.col("i.frame_timeline_status") == "pass") & (F.col("i.frame_timeline_row_count") >= 1), F.lit(False))))
        rules.append(("timeline is not stored", path.isNotNull() & F.col("timeline_rows").isNull()))
        rules.append(("timeline rows", path.isNotNull() & (F.col("i.frame_timeline_row_count") != F.col("timeline_rows"))))
    conflict = F.coalesce(*[F.when(c, reason) for reason, c in rules])
    partial = F.when(F.col("r.probe_status") != "pass", F.concat(F.lit("probe "), F.col("r.probe_status")))
    d = d.withColumn("conflict", conflict)
    status = F.when(F.col("conflict").isNotNull(), "conflict").when(partial.isNotNull(), "warning").otherwise("pass")
    verdicts = d.select("video_id", status.alias("status"), F.coalesce("conflict", partial).alias("reason"), F.col("i.revision").alias("revision"))
    fine = d.filter("conflict IS NULL")
    has = F.col("timeline_path").isNotNull()
    file = F.coalesce("m.video_filename", _name(F.col("m.video_path")))
    described = F.coalesce("m.metadata_filename", _name(F.col("m.metadata_path")))
    refs = [F.concat(F.lit("media://raw_videos/"), file).alias("video_ref"), F.concat(F.lit("media://metadata/"), described).alias("metadata_ref")]
    stored = F.when(has, F.concat(F.lit("frame_timeline/"), "video_id", F.lit(".parquet")))
    cost = F.coalesce(F.when(F.col("i.duration_sec") != 0, F.col("i.duration_sec").cast("double")), F.when(F.col("i.frame_count") != 0, F.col("i.frame_count").cast("double")), F.lit(1.0))
    fact = lambda c, name=None: F.col(f"i.{c}").alias(name or c)
    videos = fine.select(
        "video_id", *refs, file.alias("source_filename"), F.lower(F.regexp_extract(file, r"(\.[^.]*)$", 1)).alias("source_extension"), fact("fps", "fps_detected"), F.lit("canonical_video_inventory").alias("fps_source"),
        fact("duration_sec", "duration_seconds"), fact("width"), fact("height"), fact("frame_count"), F.lit(False).alias("frame_count_estimated"), F.lit("canonical_video_inventory").alias("frame_count_method"), fact("is_vfr"),
        has.alias("has_frame_timeline"), stored.alias("frame_timeline_ref"), cost.alias("estimated_compute_cost"),
    )
    media = fine.select(
        "video_id", *refs, file.alias("video_filename"), described.alias("metadata_filename"), fact("file_size_bytes", "video_size_bytes"), F.col("m.metadata_size_bytes").alias("metadata_size_bytes"), fact("revision", "canonical_revision"),
        F.col("m.video_path").alias("canonical_video_path"), F.col("m.metadata_path").alias("canonical_metadata_path"), F.col("timeline_path").alias("canonical_frame_timeline_path"),
        fact("metadata_schema_version"), fact("organizer_metadata_present"), fact("metadata_generated"), fact("probe_status"),
    )
    kept = fine.select("video_id", stored.alias("frame_timeline_ref"), F.when(has, F.col("timeline_rows")).otherwise(0).alias("row_count"), F.when(has, "pass").otherwise("unavailable").alias("status"), F.when(~has, "no frame timeline in the store").alias("error"))
    return Ingested(verdicts, videos, media, kept)


def report(found: Ingested) -> DataFrame:
    """One row: videos, their warnings and conflicts, generated records and stored timelines."""
    a = found.verdicts.agg(F.count_if(F.col("status") != "conflict").alias("videos"), F.count_if(F.col("status") == "warning").alias("warnings"), F.count_if(F.col("status") == "conflict").alias("conflicts"))
    b = found.media.agg(F.count_if("organizer_metadata_present").alias("organizer_metadata"), F.count_if("metadata_generated").alias("metadata_generated"))
    c = found.timelines.agg(F.count_if(F.col("status") == "pass").alias("timelines"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("timeline_rows"))
    return a.join(b, F.lit(True)).join(c, F.lit(True))  # one row each


def agreed(found: Ingested) -> Ingested:
    """The same, or an error that names conflicts: for callers that take all videos or none."""
    bad = found.verdicts.filter("status = 'conflict'").orderBy("video_id").limit(5).collect()
    if bad:
        raise ValueError("manifest and inventory disagree: " + "; ".join(f"{r.video_id}: {r.reason}" for r in bad))
    if found.verdicts.isEmpty():
        raise ValueError("the manifest has no successful rows")
    return found
