"""Window operators over ordered rows of a group: runs, interval packing, windows of gaps, contiguity, folds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.operators.folds import folded


def end_times(frames: DataFrame) -> DataFrame:
    """end_sec: the next frame's time, and for the last frame its own plus its duration."""
    w = Window.partitionBy("video_id").orderBy("frame_id")
    return frames.withColumn("end_sec", F.coalesce(F.lead("pts_time").over(w), F.col("pts_time") + F.col("duration_time")))


def runs(rows: DataFrame, group: str, order: str, flag: Column) -> DataFrame:
    """group, first, last, length of each maximal run of rows where flag holds (order: dense from 0)."""
    w = Window.partitionBy(group).orderBy(order)
    d = rows.filter(flag).withColumn("island", F.col(order) - F.row_number().over(w))
    return d.groupBy(group, "island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length")).drop("island")


def longest_run(rows: DataFrame, group: str, order: str, flag: Column) -> DataFrame:
    found = runs(rows, group, order, flag).groupBy(group).agg(F.max("length").alias("longest"))
    return rows.select(group).distinct().join(found, group, "left").select(group, F.coalesce("longest", F.lit(0)).cast("long").alias("longest"))


def cuts(predictions: DataFrame, threshold: float) -> DataFrame:
    """video_id, start_frame, end_frame (both included): frames parted at the middle of each run above the threshold.

    predictions(video_id, frame_id, value). Runs that touch the first or last frame cut nothing.
    """
    ends = predictions.groupBy("video_id").agg(F.min("frame_id").alias("lo"), F.max("frame_id").alias("hi"))
    found = runs(predictions, "video_id", "frame_id", F.col("value") > threshold).join(ends, "video_id").filter("first > lo AND last < hi")
    marks = found.select("video_id", F.floor((F.col("first") + F.col("last")) / 2).alias("end_frame")).unionByName(ends.select("video_id", F.col("hi").alias("end_frame")))
    w = Window.partitionBy("video_id").orderBy("end_frame")
    d = marks.join(ends.select("video_id", "lo"), "video_id")
    return d.select("video_id", F.coalesce(F.lag("end_frame").over(w) + 1, "lo").alias("start_frame"), "end_frame")


def partitioned(shots: DataFrame, group: str = "video_id") -> DataFrame:
    """Scenes from shots(video_id, shot_index, start_sec, end_sec, frames, boundary): boundary says that a scene ends after the shot."""
    before = Window.partitionBy(group).orderBy("shot_index").rowsBetween(Window.unboundedPreceding, -1)
    d = shots.withColumn("scene_index", F.coalesce(F.sum(F.col("boundary").cast("int")).over(before), F.lit(0)))
    return d.groupBy(group, "scene_index").agg(
        F.min("shot_index").alias("start_shot"), F.max("shot_index").alias("end_shot"), F.min_by("start_sec", "shot_index").alias("start_sec"),
        F.max_by("end_sec", "shot_index").alias("end_sec"), F.sum("frames").alias("frames"), F.count(F.lit(1)).alias("shot_count"),
    ).withColumn("duration_sec", F.col("end_sec") - F.col("start_sec"))


def focus_windows(counts: DataFrame, length: int = 8, stride: int = 6, context: int = 4) -> DataFrame:
    """counts(video_id, shots) -> windows over its gaps: window, first_gap, last_gap, first_shot, last_shot; the first window that reaches the end is the last."""
    gaps = F.col("shots") - 1
    d = counts.filter(gaps > 0).withColumn("first_gap", F.explode(F.sequence(F.lit(0).cast("long"), gaps.cast("long") - 1, F.lit(stride).cast("long"))))
    d = d.filter((F.col("first_gap") == 0) | (F.col("first_gap") - stride + length < gaps))
    d = d.withColumn("last_gap", F.least(F.col("first_gap") + length, gaps) - 1)
    return d.select(
        "video_id", (F.col("first_gap") / stride).cast("long").alias("window"), "first_gap", "last_gap",
        F.greatest(F.lit(0), F.col("first_gap") - context).alias("first_shot"), F.least(F.col("shots") - 1, F.col("last_gap") + 1 + context).alias("last_shot"),
    )


def vote_weight(position: Column, gaps: Column) -> Column:
    """1 + depth / largest depth, the depth counted from the nearer end of a window."""
    deepest = F.floor((gaps - 1) / 2)
    return F.when(deepest <= 0, 1.0).otherwise(1 + F.least(position, gaps - 1 - position) / deepest)


def voted(votes: DataFrame, high: float = 0.67, low: float = 0.33) -> DataFrame:
    """votes(video_id, gap, boundary, weight) -> score (weighted share of true) and route; both limits included."""
    d = votes.groupBy("video_id", "gap").agg(
        F.count(F.lit(1)).alias("votes"), F.sum(F.when(F.col("boundary"), F.col("weight")).otherwise(0.0)).alias("true_weight"),
        F.sum(F.when(F.col("boundary"), 0.0).otherwise(F.col("weight"))).alias("false_weight"),
    ).withColumn("score", F.col("true_weight") / (F.col("true_weight") + F.col("false_weight")))
    return d.withColumn("route", F.when(F.col("score") >= high, "boundary").when(F.col("score") <= low, "same").otherwise("review"))


def beside_boundaries(gaps: DataFrame, window: int = 3, least: int = 2) -> DataFrame:
    """gaps(video_id, gap from 0, boundary) with beside: the gap is one of neighbouring boundaries, or in a dense window. With fewer gaps than the window one short window counts."""
    order = Window.partitionBy("video_id").orderBy("gap")
    n = F.count(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    d = gaps.withColumn("next_to", F.col("boundary") & (F.coalesce(F.lag("boundary").over(order), F.lit(False)) | F.coalesce(F.lead("boundary").over(order), F.lit(False)))).withColumn("n", n)
    found = F.sum(F.col("boundary").cast("int")).over(order.rowsBetween(0, window - 1))
    starts = (F.col("gap") + window <= F.col("n")) | (F.col("gap") == 0)
    d = d.withColumn("dense", starts & (found >= least))
    d = d.withColumn("in_dense", F.max("dense").over(order.rowsBetween(-(window - 1), 0)))
    return d.withColumn("beside", F.col("next_to") | F.col("in_dense")).drop("next_to", "n", "dense", "in_dense")


def triggered(gaps: DataFrame, votes: DataFrame, window: int = 3, least: int = 2, least_votes: int = 2) -> DataFrame:
    """video_id, gap of provisional labels to look at again: those beside boundaries, and gaps whose votes disagree."""
    first = beside_boundaries(gaps, window, least).filter("beside").select("video_id", "gap")
    split = votes.groupBy("video_id", "gap").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("boundary").alias("kinds")).filter((F.col("n") >= least_votes) & (F.col("kinds") == 2))
    return first.unionByName(split.select("video_id", "gap")).distinct()


def merged(rows: DataFrame, group: str | list[str], start: str, end: str, slack: Column | float = 0.0) -> DataFrame:
    """Unions of intervals whose distance is the slack at most: group, start, end, parts."""
    groups = [group] if isinstance(group, str) else group
    order = Window.partitionBy(*groups).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) > reach + slack), 1).otherwise(0)
    d = rows.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*groups, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("parts")).drop("island")


def padded(gaps: DataFrame, padding: int) -> DataFrame:
    """gaps(video_id, shots, gap) -> padded, clamped and merged regions (touching ones merge): video_id, shots, start, end, parts."""
    d = gaps.select("video_id", "shots", F.greatest(F.lit(0), F.col("gap") - padding).alias("start"), F.least(F.col("shots") - 2, F.col("gap") + padding).alias("end"))
    return merged(d, ["video_id", "shots"], "start", "end", 1)


def review_regions(gaps: DataFrame, counts: DataFrame, padding: int) -> DataFrame:
    """Padded, clamped and merged regions of triggered gaps (touching ones merge): video_id, start, end, parts."""
    return padded(gaps.join(counts.select("video_id", "shots"), "video_id"), padding).drop("shots")


def chunks_of(regions: DataFrame, most: int) -> DataFrame:
    """Regions of whole numbers start..end cut into pieces of at most so many."""
    d = regions.withColumn("piece_start", F.explode(F.sequence(F.col("start"), F.col("end"), F.lit(most).cast("long"))))
    return d.withColumn("piece_end", F.least(F.col("end"), F.col("piece_start") + most - 1))


def split_long(start: Column, end: Column, longest: float, overlap: float) -> Column:
    """array<struct<start, end, forced, overlap>>: a range cut into pieces of at most longest, each reaching overlap back."""
    step = longest - overlap
    pieces = F.greatest(F.ceil((end - start - longest) / step), F.lit(0)) + 1
    cut = F.transform(
        F.sequence(F.lit(0).cast("long"), pieces - 1),
        lambda i: F.struct((start + i * step).alias("start"), F.least(end, start + i * step + longest).alias("end"), F.lit(True).alias("forced"), F.when(i > 0, F.lit(overlap)).otherwise(0.0).alias("overlap")),
    )
    whole = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(False).alias("forced"), F.lit(0.0).alias("overlap")))
    return F.when(end - start <= longest, whole).otherwise(cut)


def packed(ranges: DataFrame, longest: float, gap: float, overlap: float, shortest: float) -> DataFrame:
    """Greedy packing per video: a range joins the open one while their gap and joint length allow; long results are cut.

    ranges(video_id, start_sec, end_sec). The rule is sequential: a video's ranges stream in order through the fold, which
    numbers the pieces, and the pieces are then aggregated.
    """
    def step(open_: dict, row) -> int:
        if not open_ or row.s - open_["e"] > gap or row.e - open_["s"] > longest:
            open_.update(piece=open_.get("piece", -1) + 1, s=row.s)
        open_["e"] = row.e
        return open_["piece"]

    d = ranges.filter(F.col("end_sec") - F.col("start_sec") >= shortest).select("video_id", F.col("start_sec").cast("double").alias("s"), F.col("end_sec").cast("double").alias("e"))
    d = folded(d, "video_id", ["s", "e"], dict, step, "piece long").groupBy("video_id", "piece").agg(F.min("s").alias("s"), F.max_by("e", F.struct("s", "e")).alias("e"))
    d = d.select("video_id", F.posexplode(split_long(F.col("s"), F.col("e"), longest, overlap)).alias("k", "p"))
    d = d.select("video_id", "p.*").withColumnsRenamed({"start": "start_sec", "end": "end_sec"})
    order = Window.partitionBy("video_id").orderBy("start_sec")
    return d.withColumn("segment_index", F.row_number().over(order) - 1).filter(F.col("end_sec") - F.col("start_sec") >= shortest)


def gaps_by_size(rows: DataFrame, group: str, time: str, tie: str) -> DataFrame:
    """Gaps to the next row, the largest first, then the earlier: position from 1."""
    order = Window.partitionBy(group).orderBy(time, tie)
    d = rows.withColumn("next_time", F.lead(time).over(order)).filter("next_time IS NOT NULL").withColumn("gap", F.col("next_time") - F.col(time))
    return d.withColumn("position", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("gap"), time, tie)))


def bisection(shots: DataFrame, target: float, most: int) -> DataFrame:
    """shots(shot_id, times array<double>) -> shot_id, probes: times added one by one at the stored time nearest the middle of the widest gap between chosen ones, until gaps are at the target or most are added."""

    @F.pandas_udf("array<double>")
    def probes(column: pd.Series) -> pd.Series:
        out = []
        for times in column:
            times = sorted(times)
            chosen, added = ([times[0], times[-1]] if len(times) > 1 else list(times)), []
            while len(added) < most:
                wide = sorted(((b - a, a, b) for a, b in zip(chosen, chosen[1:])), key=lambda g: (-g[0], g[1]))
                wide = [(a, b) for g, a, b in wide if g > target and any(a < t < b for t in times)]
                if not wide:
                    break
                a, b = wide[0]
                new = min((t for t in times if a < t < b), key=lambda t: (abs(t - (a + b) / 2), t))
                added.append(new)
                chosen = sorted([*chosen, new])
            out.append(added)
        return pd.Series(out)

    return shots.select("shot_id", probes("times").alias("probes"))


def novel(candidates: DataFrame, separation: float, threshold: float, budget: int) -> DataFrame:
    """candidates(shot_id, time, signature bigint) -> those taken per shot: in time order, each at least separation after and threshold (share of differing bits) away from every one taken before, up to the budget."""

    taken = F.slice(F.col("rows"), 1, 0)

    def step(got, x):
        far = F.forall(got, lambda y: (F.abs(x["time"] - y["time"]) >= separation) & (F.bit_count(x["signature"].bitwiseXOR(y["signature"])) / 64 >= threshold))
        return F.when((F.size(got) < budget) & far, F.concat(got, F.array(x))).otherwise(got)

    d = candidates.groupBy("shot_id").agg(F.array_sort(F.collect_list(F.struct("time", "signature"))).alias("rows"))
    return d.select("shot_id", F.inline(F.aggregate("rows", taken, step)))


def variable_rate(frames: DataFrame) -> DataFrame:
    """video_id, variable: whether a positive step differs from the upper median by over 1 % and 0.1 ms; null under 3 rows or 2 steps."""
    order = Window.partitionBy("video_id").orderBy("frame_id")
    d = frames.withColumn("step", F.col("pts_time") - F.lag("pts_time").over(order))
    d = d.groupBy("video_id").agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list(F.when(F.col("step") > 0, F.col("step")))).alias("steps"))
    middle = F.try_element_at("steps", (F.floor(F.size("steps") / 2) + 1).cast("int"))
    off = F.exists("steps", lambda x: F.abs(x - F.col("middle")) > F.greatest(0.01 * F.greatest(F.abs(x), F.abs(F.col("middle"))), F.lit(1e-4)))
    return d.withColumn("middle", middle).select("video_id", F.when((F.col("rows") >= 3) & (F.size("steps") >= 2), off).alias("variable"))


def timeline_faults(frames: DataFrame) -> DataFrame:
    """video_id and counts of frames that are not numbered from 0, go back in time, or have a negative duration."""
    order = Window.partitionBy("video_id").orderBy("frame_id")
    d = frames.withColumn("expected", F.row_number().over(order) - 1).withColumn("before", F.lag("pts_time").over(order))
    return d.groupBy("video_id").agg(
        F.count_if(F.col("frame_id") != F.col("expected")).alias("misnumbered"), F.count_if(F.col("pts_time") < F.col("before")).alias("backwards"),
        F.count_if(F.coalesce(F.col("duration_time") < 0, F.lit(False))).alias("negative"),
    )


def chain_faults(rows: DataFrame, group: str, start: str, end: str, tolerance: float = 0.0) -> DataFrame:
    """Rows that don't start where the one before ends, or that are empty."""
    order = Window.partitionBy(group).orderBy(start, end)
    d = rows.withColumn("before", F.lag(end).over(order))
    return d.filter((F.abs(F.col(start) - F.col("before")) > tolerance) | (F.col(end) <= F.col(start)))


def repeated_runs(rows: DataFrame, group: str, order: list[str], text: Column, most: int) -> DataFrame:
    """Adds run_length and rejected: rows of a run of one non-empty text that is longer than most."""
    w = Window.partitionBy(group).orderBy(*order)
    d = rows.withColumn("same", text).withColumn("fresh", F.when(F.col("same").eqNullSafe(F.lag("same").over(w)), 0).otherwise(1))
    d = d.withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("run_length", F.count(F.lit(1)).over(Window.partitionBy(group, "run")))
    return d.withColumn("rejected", (F.col("run_length") > most) & (F.coalesce(F.col("same"), F.lit("")) != "")).drop("same", "fresh", "run")


def speech_gaps(shots: DataFrame) -> DataFrame:
    """shots(video_id, shot_index, words, first_word_sec, last_word_sec, segments array) -> per neighbouring pair: words on both sides, silence, shared segments, and whether speech runs on."""
    order = Window.partitionBy("video_id").orderBy("shot_index")
    names = ["words", "first_word_sec", "segments"]
    d = shots.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in names], F.lead("shot_index").over(order).alias("next_index")).filter("next_index IS NOT NULL")
    shared = F.array_sort(F.array_intersect("segments", "next_segments"))
    return d.select(
        "video_id", F.col("shot_index").alias("gap"), F.col("words").alias("left_words"), F.col("next_words").alias("right_words"),
        (F.col("next_first_word_sec") - F.col("last_word_sec")).alias("silence_sec"), shared.alias("shared_segments"), (F.size(shared) > 0).alias("continues"),
        F.when((F.col("words") == 0) & (F.col("next_words") == 0), "missing_both_aligned_words").when(F.col("words") == 0, "missing_left_aligned_words")
        .when(F.col("next_words") == 0, "missing_right_aligned_words").otherwise("reliable_words_both_sides").alias("reliability"),
    )


def history(rows: DataFrame, label: str, time: str, limit: int = 10) -> DataFrame:
    """The newest row of each label, the newest first."""
    newest = F.row_number().over(Window.partitionBy(label).orderBy(F.desc(time)))
    return rows.withColumn("newest", newest).filter("newest = 1").drop("newest").orderBy(F.desc(time), label).limit(limit)


def trimmed_overlaps(chunks: DataFrame, most: int = 12) -> DataFrame:
    """chunks(video_id, chunk, text, accepted) -> kept: the text without the longest run of up to most words that repeats the end of the chunk accepted before it; a rejected chunk breaks the chain.

    The text compared is the stored one, so the previous row decides and no fold over kept texts is needed.
    """
    order = Window.partitionBy("video_id").orderBy("chunk")
    d = chunks.withColumn("previous", F.lag(F.when(F.col("accepted"), F.col("text"))).over(order))
    words = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\s+"), lambda w: w != "")
    bare = lambda a: F.array_join(F.filter(F.transform(a, lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}_]+", "")), lambda w: w != ""), " ")
    d = d.withColumn("p", words("previous")).withColumn("c", words("text"))
    d = d.withColumn("n", F.least(F.lit(most), F.size("p"), F.size("c")))
    same = F.filter(
        F.when(F.col("n") > 0, F.sequence(F.col("n"), F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>")),
        lambda k: (bare(F.slice("p", F.size("p") - k + 1, k)) == bare(F.slice("c", F.lit(1), k))) & (bare(F.slice("c", F.lit(1), k)) != ""),
    )
    d = d.withColumn("overlap", F.when(F.col("accepted"), F.coalesce(F.get(same, F.lit(0)), F.lit(0))).otherwise(0))
    return d.select("video_id", "chunk", "overlap", F.array_join(F.slice("c", F.col("overlap") + 1, F.greatest(F.size("c"), F.lit(1))), " ").alias("kept"))
