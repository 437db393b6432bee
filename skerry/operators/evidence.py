"""Evidence per shot and scene: keyframe roles, change signals, source frames, caption modes, nested records, rendered texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.functions import scalars, text
from skerry.operators import dedup

#: Statuses of recognised text that can be compared.
RELIABLE = ("pass", "empty")
#: Roles in the order in which they claim a frame.
ROLE_RANK = {"middle": 0, "early": 1, "late": 2}


# ---- keyframe roles


def role_bands(low: float, high: float, step: float, safe_low: float, safe_high: float) -> list[tuple[float, float]]:
    """A role's search bands: widened by step on both sides until they fill the safe interior."""
    out = [(low, high)]
    while not (low <= safe_low and high >= safe_high):
        low, high = max(safe_low, low - step), min(safe_high, high + step)
        out.append((low, high))
    return out


def role_candidates(shots: DataFrame, roles: Mapping[str, Sequence[tuple[float, float]]], most: int) -> DataFrame:
    """shots(shot_id, start_frame, end_frame) -> shot_id, role, round, frame_id: frames of every band, each in its first round."""
    last = F.col("end_frame") - 1
    bands = [F.struct(F.lit(role).alias("role"), F.lit(k).alias("round"), scalars.band(F.col("start_frame"), last, low, high, most).alias("frames")) for role, all_ in roles.items() for k, (low, high) in enumerate(all_)]
    d = shots.select("shot_id", F.inline(F.array(*bands))).select("shot_id", "role", "round", F.explode("frames").alias("frame_id"))
    return d.groupBy("shot_id", "role", "frame_id").agg(F.min("round").alias("round"))


def role_keyframes(evaluated: DataFrame, ratio: float = 0.9) -> DataFrame:
    """evaluated(shot_id, role, round, frame_id, target_frame, center, quality, valid) -> shot_id, role, frame_id, quality, is_representative, reason.

    A role takes the best valid frame, then the one nearest its target, of its first round that has any. Frames are
    unique: middle claims first, then early, then late. The middle one represents the shot if its quality is at least
    ratio of the best; otherwise the best frame, then the one nearest the centre.
    """
    order = F.struct(-F.col("round"), "quality", -F.abs(F.col("frame_id") - F.col("target_frame")), -F.col("frame_id"))
    best = evaluated.filter("valid").groupBy("shot_id", "role").agg(F.max_by(F.struct("frame_id", "quality", "center"), order).alias("b"))
    rank = F.coalesce(*[F.when(F.col("role") == r, k) for r, k in ROLE_RANK.items()])
    d = best.select("shot_id", "role", "b.*", rank.alias("claim"))
    claims = Window.partitionBy("shot_id", "frame_id").orderBy("claim")
    d = d.withColumn("n", F.row_number().over(claims)).filter("n = 1").drop("n")
    shot = Window.partitionBy("shot_id")
    middle = F.max(F.when(F.col("role") == "middle", F.col("quality"))).over(shot)
    d = d.withColumn("middle", middle).withColumn("top", F.max("quality").over(shot))
    by_middle = F.coalesce(F.col("middle") >= ratio * F.col("top"), F.lit(False))
    nearest = F.row_number().over(shot.orderBy(F.desc("quality"), F.abs(F.col("frame_id") - F.col("center")), "frame_id")) == 1
    chosen = F.when(by_middle, F.col("role") == "middle").otherwise(nearest)
    reason = F.when(chosen, F.when(by_middle, "middle_within_quality_ratio").otherwise("highest_quality_fallback")).otherwise("best_valid_candidate_in_search_band")
    return d.withColumn("is_representative", chosen).withColumn("reason", reason).select("shot_id", "role", "frame_id", "quality", "is_representative", "reason")


# ---- change signals and source frames


def distinct_frames(frames: DataFrame) -> DataFrame:
    """frames(shot_id, keyframe_id, time, frame_id, is_representative, image, status, words) without repeats of (image, status, words) where the status is reliable; the representative wins, then the earliest."""
    return dedup.exact_first(frames, ["shot_id", "image", "status", "words"], [F.when(F.col("is_representative"), 0).otherwise(1), "time", "frame_id"], F.col("status").isin(*RELIABLE))


def pair_signals(frames: DataFrame, visual_limit: float, text_limit: float) -> DataFrame:
    """Neighbouring frames of a shot: left_id, right_id, visual (share of different hash bits), words (token distance, null if a text is unreliable), what crossed its limit, and strength, the larger change."""
    w = Window.partitionBy("shot_id").orderBy("time", "frame_id")
    d = frames.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in ("keyframe_id", "image", "status", "words")]).filter("next_keyframe_id IS NOT NULL")
    tokens = lambda c: F.array_distinct(text.tokens(F.col(c)))
    reliable = F.col("status").isin(*RELIABLE) & F.col("next_status").isin(*RELIABLE)
    d = d.withColumn("visual", dedup.hamming_ratio(F.col("image"), F.col("next_image"), 64)).withColumn("changed", dedup.token_jaccard_distance(tokens("words"), tokens("next_words"), reliable))
    return d.select(
        "shot_id", F.col("keyframe_id").alias("left_id"), F.col("next_keyframe_id").alias("right_id"), "time", "frame_id", "visual", "changed", (F.col("visual") >= visual_limit).alias("crossed_visual"),
        F.coalesce(F.col("changed") >= text_limit, F.lit(False)).alias("crossed_text"), F.greatest("visual", F.coalesce("changed", F.lit(0.0))).alias("strength"),
    )


def source_frames(frames: DataFrame, signals: DataFrame, most: int) -> DataFrame:
    """shot_id, keyframe_id, time, frame_id of at most so many frames a shot: the representative, supplemental ones by strength, then both ends of crossed pairs by strength."""
    crossed = signals.filter("crossed_visual OR crossed_text")
    ends = crossed.select("shot_id", "strength", "time", "frame_id", F.posexplode(F.array("left_id", "right_id")).alias("side", "keyframe_id"))
    strongest = ends.groupBy("shot_id", "keyframe_id").agg(F.max("strength").alias("power"))
    d = frames.join(strongest, ["shot_id", "keyframe_id"], "left")
    place = lambda tier, power, time, frame, side: F.struct(F.lit(tier).alias("tier"), (-power).alias("power"), time.alias("time"), frame.alias("frame"), side.alias("side"))
    zero = F.lit(0.0)
    own = d.filter("is_representative OR is_supplemental").select(
        "shot_id", "keyframe_id",
        F.when(F.col("is_representative"), place(0, zero, F.col("time"), F.col("frame_id"), F.lit(0))).otherwise(place(1, F.coalesce("power", zero), F.col("time"), F.col("frame_id"), F.lit(0))).alias("at"),
    )
    pairs = ends.select("shot_id", "keyframe_id", place(2, F.col("strength"), F.col("time"), F.col("frame_id"), F.col("side")).alias("at"))
    first = own.unionByName(pairs).groupBy("shot_id", "keyframe_id").agg(F.min("at").alias("at"))
    turn = F.row_number().over(Window.partitionBy("shot_id").orderBy("at", "keyframe_id"))
    return first.withColumn("turn", turn).filter(F.col("turn") <= most).select("shot_id", "keyframe_id").join(frames.select("shot_id", "keyframe_id", "time", "frame_id"), ["shot_id", "keyframe_id"])


def caption_modes(shots: DataFrame, frames: DataFrame, visual_limit: float, text_limit: float, least_seconds: float, most: int) -> DataFrame:
    """shot_id, mode, reasons, sources: a storyboard of several frames where a meaningful supplemental frame or, in shots long enough, a change calls for it; else the representative alone."""
    distinct = distinct_frames(frames)
    signals = pair_signals(distinct, visual_limit, text_limit)
    found = signals.groupBy("shot_id").agg(F.bool_or("crossed_visual").alias("v"), F.bool_or("crossed_text").alias("t"))
    kinds = distinct.groupBy("shot_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("is_supplemental").alias("s"))
    d = shots.select("shot_id", (F.col("end_sec") - F.col("start_sec") >= least_seconds).alias("long")).join(kinds, "shot_id").join(found, "shot_id", "left")
    reasons = F.array_compact(F.array(F.when(F.col("s"), "meaningful_supplemental"), F.when(F.col("long") & F.col("v"), "visual_change"), F.when(F.col("long") & F.col("t"), "ocr_change")))
    d = d.select("shot_id", F.when(F.col("n") >= 2, reasons).otherwise(F.array().cast("array<string>")).alias("reasons"))
    chosen = source_frames(distinct, signals, most).groupBy("shot_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("time", "frame_id", "keyframe_id"))), lambda x: x["keyframe_id"]).alias("several"))
    alone = frames.filter("is_representative").groupBy("shot_id").agg(F.min("keyframe_id").alias("one"))
    d = d.join(chosen, "shot_id", "left").join(alone, "shot_id")
    dynamic = (F.size("reasons") > 0) & (F.coalesce(F.size("several"), F.lit(0)) >= 2)
    return d.select(
        "shot_id", F.when(dynamic, "temporal_storyboard").otherwise("representative_only").alias("mode"), F.when(dynamic, F.col("reasons")).otherwise(F.array().cast("array<string>")).alias("reasons"),
        F.when(dynamic, F.col("several")).otherwise(F.array("one")).alias("sources"),
    )


# ---- nested records and rendered texts


def details(keyframes: DataFrame, videos: DataFrame, detections: DataFrame, key: str = "vector_id") -> DataFrame:
    """One record per keyframe with its video and its detections, the best score first, then the lower rank; scores rounded half to even at four digits."""
    found = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "rank", "entity")))
    d = detections.groupBy(key).agg(F.transform(found, lambda x: F.struct(x["entity"].alias("entity"), F.bround(-x["order"], 4).alias("score"), x["rank"].alias("rank"))).alias("detections"))
    return keyframes.join(videos, "video_id").join(d, key, "left")


def shot_records(shots: DataFrame, frames: DataFrame, words: DataFrame) -> DataFrame:
    """shot_id with its frames (by time) and its words' transcript as nested columns; shots without any keep empty ones."""
    a = frames.groupBy("shot_id").agg(F.array_sort(F.collect_list(F.struct("time", "frame_id", "keyframe_id", "status", "words"))).alias("frames"))
    b = text.transcript(words, "shot_id", ["start_sec", "word_id"], "text").withColumnRenamed("text", "transcript")
    none = F.array().cast(a.schema["frames"].dataType)
    return shots.select("shot_id").join(a, "shot_id", "left").join(b, "shot_id", "left").withColumns({"frames": F.coalesce("frames", none), "transcript": F.coalesce("transcript", F.lit(""))})


def evidence_body(shot_id: Column, start: Column, end: Column, mode: Column, frames: Column) -> Column:
    """Lines for a caption request; frames: array of structs (keyframe_id, time, status, words)."""
    shown = lambda x: F.when(x["status"].isin("failed", "unavailable"), "<UNAVAILABLE>").when(F.coalesce(x["words"], F.lit("")) != "", x["words"]).otherwise("<NONE>")
    head = F.format_string("CAPTION_MODE: %s\nSHOT_ID: %s\nSHOT_TIME: %.6f-%.6f\nSOURCE_FRAME_COUNT: %d\n\nORDERED_SOURCE_FRAMES:", mode, shot_id, start, end, F.size(frames))
    body = F.transform(frames, lambda x, i: F.format_string("\n\nFRAME_%02d\nKEYFRAME_ID: %s\nTIMESTAMP_SEC: %.6f\nOCR_STATUS: %s\nOCR_TEXT: %s", i + 1, x["keyframe_id"], x["time"], x["status"], shown(x)))
    return F.concat(head, F.array_join(body, ""))


def speech_summaries(scenes: DataFrame, words: DataFrame, most_chars: int) -> DataFrame:
    """scenes(scene_id, start_sec, end_sec, asr_status), words(scene_id, word_id, start_sec, text) -> scene_id, status, transcript (whole words within the limit), body, fingerprint."""
    w = words.groupBy("scene_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("start_sec", "word_id", F.trim("text").alias("text")))), lambda x: x["text"]).alias("w"))
    d = scenes.join(w, "scene_id", "left").withColumn("w", F.coalesce("w", F.array().cast("array<string>")))
    d = d.withColumn("status", scalars.speech_status(F.col("asr_status"), F.size("w")))
    d = d.withColumn("transcript", F.when(F.col("status") == "available", F.array_join(text.bounded_words(F.col("w"), most_chars), " ")).otherwise(""))
    shown = F.when(F.col("transcript") != "", F.col("transcript")).otherwise("<UNAVAILABLE>")
    d = d.withColumn("body", F.format_string("SCENE_ID: %s\nTIME: %.3f-%.3f\nCANONICAL_TRANSCRIPT:\n%s", F.col("scene_id").cast("string"), "start_sec", "end_sec", shown))
    return d.select("scene_id", "status", "transcript", "body", scalars.fingerprint("scene_id", "status", "transcript", "body").alias("fingerprint"))


def texts_by_keyframe(rows: DataFrame) -> DataFrame:
    """rows(keyframe_id, pos, status, text, raw_text) -> the last non-blank text of rows that have not failed."""
    shown = F.trim(F.coalesce(F.nullif("text", F.lit("")), F.nullif("raw_text", F.lit("")), F.lit("")))
    d = rows.filter(F.coalesce("status", F.lit("")) != "failed").withColumn("shown", shown).filter("shown <> ''")
    return d.groupBy("keyframe_id").agg(F.max_by("shown", "pos").alias("text"))


def diagnostic_counts(evaluated: DataFrame) -> DataFrame:
    """Frames and evaluations, all and valid ones: one row."""
    frame = F.struct("shot_id", "frame_id")
    return evaluated.agg(
        F.countDistinct(frame).alias("candidates"), F.countDistinct(F.when(F.col("valid"), frame)).alias("valid_candidates"), F.count(F.lit(1)).alias("evaluations"), F.count_if("valid").alias("valid_evaluations")
    )


def whole_video(timeline: DataFrame) -> DataFrame:
    """One shot over each video, for want of a detector: shot_id, start_frame, end_frame, start_sec, end_sec."""
    d = timeline.groupBy("video_id").agg(F.count(F.lit(1)).alias("end_frame"), F.max_by(F.col("pts_time") + F.coalesce("duration_time", F.lit(0.0)), "frame_id").alias("end_sec"))
    return d.select("video_id", F.concat(F.col("video_id").cast("string"), F.lit("_SH00000")).alias("shot_id"), F.lit(0).cast("long").alias("start_frame"), "end_frame", F.lit(0.0).alias("start_sec"), "end_sec")


def numbered_segments(segments: DataFrame) -> DataFrame:
    """segments(video_id, pos, start_sec, end_sec, text) without blank ones; ids keep the original position; backwards tells starts before the previous one."""
    w = Window.partitionBy("video_id").orderBy("pos")
    d = segments.withColumn("backwards", F.coalesce(F.col("start_sec") < F.lag("start_sec").over(w), F.lit(False))).filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    return d.withColumn("segment_id", F.format_string("%s_A%05d", F.col("video_id").cast("string"), F.col("pos"))).withColumn("text", F.trim("text"))
