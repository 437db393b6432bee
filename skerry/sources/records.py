"""Metadata records of videos: nested rows from organiser fields and probe facts, their contract, and the flat inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions import scalars, text
from skerry.plans import checks

TEXT_FIELDS = ("title", "author", "channel_id", "channel_url", "description", "thumbnail_url", "watch_url")
MEDIA = ("filename", "file_size_bytes", "duration_sec", "fps", "frame_count", "width", "height", "is_vfr")
STATUSES = ("pass", "partial", "failed")


def organiser_fields(raw: DataFrame) -> DataFrame:
    """Blank texts as null, keywords trimmed without blanks, the date as ISO; a negative length or an unreadable date is an error."""
    length = F.when(F.col("length") < 0, F.raise_error(F.lit("length is negative")).cast("long")).otherwise(F.col("length").cast("long"))
    return raw.select("video_id", *[text.blank_to_null(F.col(c)).alias(c) for c in TEXT_FIELDS if c in raw.columns], text.string_list(F.col("keywords")).alias("keywords"), length.alias("length"), scalars.iso_or_error(F.col("publish_date")).alias("publish_date"))


def records(probes: DataFrame, organiser: DataFrame, version: str = "1") -> DataFrame:
    """One nested record per probed video: organiser fields, media (with a status by the known facts) and provenance; a video without organiser data gets a generated record."""
    fields = [c for c in organiser.columns if c != "video_id"]
    d = probes.join(organiser.withColumn("present", F.lit(True)), "video_id", "left").withColumn("present", F.coalesce("present", F.lit(False)))
    media = F.struct(*MEDIA, scalars.probe_status(*[F.col(c) for c in MEDIA[2:]]).alias("probe_status"))
    return d.select(F.lit(version).alias("schema_version"), "video_id", F.col("present").alias("organizer_metadata_present"), *fields, media.alias("media"), F.struct((~F.col("present")).alias("metadata_generated")).alias("provenance"))


def inventory(found: DataFrame) -> DataFrame:
    """The flat columns of the records."""
    return found.select("video_id", F.col("schema_version").alias("metadata_schema_version"), "organizer_metadata_present", "provenance.metadata_generated", *[f"media.{c}" for c in (*MEDIA[1:], "probe_status")])


def record_faults(found: DataFrame) -> DataFrame:
    """table, check, violations of the records' contract."""
    spec = checks.TableSpec(
        "records", required=("schema_version", "video_id", "media", "provenance"), non_null=("schema_version", "video_id"), unique=(("video_id",),), non_empty=("video_id",),
        rules={
            "status": f"media.probe_status IN {STATUSES}", "size": "media.file_size_bytes >= 0", "rate": "media.fps IS NULL OR media.fps > 0", "duration": "media.duration_sec IS NULL OR media.duration_sec >= 0",
            "generated": "provenance.metadata_generated = (NOT organizer_metadata_present)",
        },
    )
    return checks.check_table(found, spec)


def strict_rows(d: DataFrame, column: str, schema: str) -> DataFrame:
    """d with parsed, the JSON of a column, and fault: malformed, or unexpected where it has keys that the schema lacks."""
    parsed = F.from_json(column, schema + ", _broken string", {"columnNameOfCorruptRecord": "_broken"})
    names = [f.name for f in d.sparkSession.createDataFrame([], schema).schema.fields]
    out = d.withColumn("parsed", parsed)
    extra = F.size(F.array_except(F.json_object_keys(column), F.array(*[F.lit(n) for n in names]))) > 0
    return out.withColumn("fault", F.when(F.col("parsed").isNull() | F.col("parsed._broken").isNotNull(), "malformed").when(extra, "unexpected"))


def image_path(root: str, relative: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), F.ltrim(relative, F.lit("/")))
