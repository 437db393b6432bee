"""Per-keyframe feature rows: what models found for a keyframe, and defined rows where they failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_rows(keyframes: DataFrame, found: DataFrame, dimension: int, model: str) -> DataFrame:
    """One row per keyframe with its vector, text and label; a keyframe that failed has status failed and a zero vector.

    keyframes(keyframe_id, video_id, shot_id, frame_id); found(keyframe_id, vector, text, language, text_confidence, label,
    confidence, error). A keyframe has failed if it wasn't found, has an error, or its vector isn't of the dimension.
    """
    d = keyframes.join(found, "keyframe_id", "left")
    failed = F.coalesce(F.col("error").isNotNull() | (F.size("vector") != dimension), F.lit(True)) | F.col("vector").isNull()
    d = d.withColumn("failed", failed)

    def kept(c: str, otherwise: Column) -> Column:
        return F.when(F.col("failed"), otherwise).otherwise(F.coalesce(F.col(c), otherwise))

    return d.select(
        "keyframe_id", "video_id", F.coalesce("shot_id", F.lit("")).alias("shot_id"), "frame_id",
        F.when(F.col("failed"), "failed").otherwise("pass").alias("status"),
        F.concat("keyframe_id", F.when(F.col("failed"), "_failed").otherwise("_" + model)).alias("embedding_id"),
        F.lit(model).alias("model"), F.lit(dimension).alias("dimension"),
        F.when(F.col("failed"), F.array_repeat(F.lit(0.0).cast("float"), dimension)).otherwise(F.col("vector").cast("array<float>")).alias("vector"),
        kept("text", F.lit("")).alias("text"), kept("language", F.lit("vi")).alias("language"),
        F.when(~F.col("failed"), F.col("text_confidence")).alias("text_confidence"),
        kept("label", F.lit("")).alias("label"), kept("confidence", F.lit(0.0)).alias("confidence"), "error",
    )


def text_sources(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """video_id, entity_type, entity_id, source_type, text, status: recognised texts and labels of keyframes, then titles, descriptions and keywords of videos."""
    pair = F.array(F.struct(F.lit("ocr").alias("source_type"), F.col("text").alias("text")), F.struct(F.lit("object_labels").alias("source_type"), F.col("label").alias("text")))
    frames = rows.select("video_id", F.lit("keyframe").alias("entity_type"), F.col("keyframe_id").alias("entity_id"), F.explode(pair).alias("t"), "status")
    named = F.array(*[F.struct(F.lit(f"video_{c}").alias("source_type"), F.coalesce(F.col(c), F.lit("")).alias("text")) for c in ("title", "description", "keywords")])
    videos = metadata.select("video_id", F.lit("video").alias("entity_type"), F.col("video_id").alias("entity_id"), F.explode(named).alias("t"), F.lit("pass").alias("status"))
    return frames.unionByName(videos).select("video_id", "entity_type", "entity_id", "t.*", "status")


def video_status(rows: DataFrame) -> DataFrame:
    """video_id, rows, failed, status: partial where a keyframe failed."""
    d = rows.groupBy("video_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") == "failed").alias("failed"))
    return d.withColumn("status", F.when(F.col("failed") > 0, "partial").otherwise("pass"))
