"""Scene review: boundary labels of gaps between shots, from a judge's votes to a partition that is looked at until it settles.

Every video goes through the same states, all videos of a state in one job: votes of overlapping windows, a focused
question where votes disagree, rounds over inconsistent regions, and rounds over whole videos whose partition is
suspicious. A video leaves a loop when nothing triggers or nothing changes; later rounds read the videos that are left.

Tables of a round are small as files, but not as rows, so their joins are merges: a plan that goes by the size of the
files would send them through the driver. Both sides are dealt by video, which the windows after the join need anyway.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.operators import aggregates, sequences
from skerry.sources.shared import Rounds

#: requests(video_id, kind, round, window, gap, position, gaps, first_shot, last_shot) -> video_id, window, gap, boundary and, if it has them, reason and confidence.
Judge = Callable[[DataFrame], DataFrame]
KEYS = ["video_id", "window", "gap"]


@dataclasses.dataclass(frozen=True)
class ReviewPolicy:
    focus_gaps: int = 8
    context_shots: int = 4
    stride: int = 6
    boundary_at: float = 0.67
    same_at: float = 0.33
    dense_window: int = 3
    dense_count: int = 2
    least_votes: int = 2
    consistency_rounds: int = 1
    quality_guard: bool = True
    least_shots: int = 4
    density: float = 0.9
    one_shot_rate: float = 0.8
    degenerate_review: bool = True
    degenerate_focus: int = 8
    degenerate_context: int = 6
    degenerate_rounds: int = 1

    def __post_init__(self):
        if min(self.focus_gaps, self.stride, self.degenerate_focus) < 1 or self.stride > self.focus_gaps:
            raise ValueError("windows must be positive and leave no gap between them")


class Reviewed(NamedTuple):
    """decisions: a row per gap. scenes: the final partition. videos: a row per video with its quality before and after, and its rounds."""

    decisions: DataFrame
    scenes: DataFrame
    videos: DataFrame


def asked(judge: Judge, requests: DataFrame, rounds: Rounds) -> DataFrame:
    """The requests with the judge's answers. Each request must be answered once, with a label, and nothing else may be; otherwise ValueError."""
    requests = rounds.put(requests).repartition("video_id")
    given = judge(requests)
    more = [(F.min(c) if c in given.columns else F.lit(None).cast(kind)).alias(c) for c, kind in (("reason", "string"), ("confidence", "double"))]
    given = given.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("answers"), F.min("boundary").alias("boundary"), *more)
    both = rounds.put(requests.withColumn("was_asked", F.lit(True)).join(given.hint("merge"), KEYS, "full"))
    wrong = both.filter("was_asked IS NULL OR answers IS NULL OR answers <> 1 OR boundary IS NULL").limit(3).collect()
    if wrong:
        raise ValueError("the judge must answer every gap that was asked, once: " + "; ".join(f"video {r.video_id}, window {r.window}, gap {r.gap}" for r in wrong))
    return both.drop("was_asked", "answers")


def _requests(windows: DataFrame, kind: str, round_: int) -> DataFrame:
    """windows(video_id, window, first_gap, last_gap, first_shot, last_shot) -> a request per gap."""
    d = windows.select("*", F.explode(F.sequence("first_gap", "last_gap")).alias("gap"))
    place, gaps = F.col("gap") - F.col("first_gap"), F.col("last_gap") - F.col("first_gap") + 1
    return d.select("video_id", F.lit(kind).alias("kind"), F.lit(round_).alias("round"), "window", "gap", place.alias("position"), gaps.alias("gaps"), "first_shot", "last_shot")


def _around(d: DataFrame, context: int) -> DataFrame:
    """d(video_id, shots, first_gap, last_gap) as windows named by their first gap, with the shots around them."""
    return d.select("video_id", F.col("first_gap").alias("window"), "first_gap", "last_gap", F.greatest(F.lit(0), F.col("first_gap") - context).alias("first_shot"), F.least(F.col("shots") - 1, F.col("last_gap") + 1 + context).alias("last_shot"))


def _answered(state: DataFrame, answers: DataFrame, route: str) -> DataFrame:
    """The state with the answers in it, and per video whether any gap was asked and whether any label has changed."""
    new = answers.select("video_id", "gap", F.col("boundary").alias("new"), F.col("reason").alias("new_reason"), F.col("confidence").alias("new_confidence"))
    d = state.repartition("video_id").join(new.repartition("video_id").hint("merge"), ["video_id", "gap"], "left")
    hit, video = F.col("new").isNotNull(), Window.partitionBy("video_id")
    fresh = {"boundary": F.coalesce("new", "boundary"), "route": F.when(hit, route).otherwise(F.col("route")), "reason": F.when(hit, F.col("new_reason")).otherwise(F.col("reason")), "confidence": F.when(hit, F.col("new_confidence")).otherwise(F.col("confidence"))}
    flags = {"gap_hit": hit, "hit": F.max(hit).over(video), "moved": F.max(F.coalesce(F.col("new") != F.col("boundary"), F.lit(False))).over(video)}
    d = d.withColumns(flags).withColumns(fresh)
    return d.drop("new", "new_reason", "new_confidence")


def _quality(shots: DataFrame, gaps: DataFrame, policy: ReviewPolicy, rounds: Rounds) -> tuple[DataFrame, DataFrame]:
    """Scenes of the labels, and per video their quality with flags that name what is odd."""
    marks = gaps.select("video_id", F.col("gap").alias("shot_index"), "boundary")
    marked = rounds.put(shots.join(marks.hint("merge"), ["video_id", "shot_index"], "left").na.fill(False, ["boundary"]))
    scenes = sequences.partitioned(marked)
    d = aggregates.partition_quality(marked, scenes, policy.least_shots, policy.density, policy.one_shot_rate)
    judged = F.lit(policy.quality_guard) & (F.col("shot_count") >= policy.least_shots)
    every = (F.col("shot_count") > 1) & (F.col("boundary_count") == F.col("shot_count") - 1)
    named = [("all_gaps_are_boundaries", every), ("extreme_boundary_density", F.col("boundary_density") >= policy.density), ("extreme_one_shot_scene_rate", F.col("one_shot_rate") >= policy.one_shot_rate)]
    flags = F.array_compact(F.array(*[F.when(judged & c, n) for n, c in named]))
    return scenes, d.withColumn("suspicious", F.col("suspicious") & F.lit(policy.quality_guard)).withColumn("flags", flags)


def reviewed(shots: DataFrame, judge: Judge, policy: ReviewPolicy = ReviewPolicy()) -> Reviewed:
    """shots(video_id, shot_index from 0, start_sec, end_sec, frames) -> decisions, scenes and videos.

    A video of one shot has no gap and one scene. Shots are read several times, so they should be a stored table. Rounds
    are written to the shared folder, so the plan of a round doesn't hold those before it and a lost executor costs a stage.
    """
    rounds = Rounds(shots.sparkSession, "reviews")
    counts = rounds.put(shots.groupBy("video_id").agg(F.count(F.lit(1)).alias("shots")))

    # votes of overlapping windows
    windows = sequences.focus_windows(counts, policy.focus_gaps, policy.stride, policy.context_shots)
    votes = asked(judge, _requests(windows, "primary", 0), rounds).withColumn("weight", sequences.vote_weight(F.col("position"), F.col("gaps")))
    said = votes.groupBy("video_id", "gap").agg(F.max_by("reason", "window").alias("reason"), F.max_by("confidence", "window").alias("confidence"))
    scored = sequences.voted(votes, policy.boundary_at, policy.same_at).join(said.hint("merge"), ["video_id", "gap"]).join(counts.hint("merge"), "video_id")
    open_ = F.col("route") == "review"
    # a vote weighs at least 1, so both weights tell whether votes disagree
    split = (F.col("votes") >= policy.least_votes) & (F.col("true_weight") > 0) & (F.col("false_weight") > 0)
    scored = rounds.put(scored.withColumns({"boundary": F.when(~open_, F.col("route") == "boundary"), "open": open_, "split": split}).drop("route"))

    # one question for each gap whose votes leave it open
    lone = _around(scored.filter("open").select("video_id", "shots", F.col("gap").alias("first_gap"), F.col("gap").alias("last_gap")), policy.context_shots)
    state = scored.withColumn("route", F.lit("primary"))
    answers = asked(judge, _requests(lone, "focused_review", 0), rounds)
    state = _answered(state, answers, "focused_review").drop("open", "gap_hit", "hit", "moved")
    state = state.withColumns({"consistency_round": F.lit(None).cast("int"), "consistency_rounds": F.lit(0), "degenerate_review": F.lit(False), "degenerate_rounds": F.lit(0)})

    def loop(active: DataFrame, most: int, step: Callable[[DataFrame, int], DataFrame], on: Callable[[DataFrame], Column]) -> DataFrame:
        """Rounds over the videos that are still on; each leaves with the labels of its last round."""
        left: list[DataFrame] = []
        for k in range(1, most + 1):
            d = rounds.put(step(active, k))
            stays = on(d)
            left.append(d.filter(~stays))
            active = d.filter(stays)
            if active.isEmpty():
                break
        return reduce(DataFrame.unionByName, [x.drop("gap_hit", "hit", "moved") for x in (*left, active)])

    def consistency(active: DataFrame, k: int) -> DataFrame:
        hits = sequences.beside_boundaries(active, policy.dense_window, policy.dense_count).filter(F.col("beside") | F.col("split"))
        pieces = sequences.chunks_of(sequences.padded(hits, policy.context_shots), policy.focus_gaps)
        pieces = _around(pieces.select("video_id", "shots", F.col("piece_start").alias("first_gap"), F.col("piece_end").alias("last_gap")), policy.context_shots)
        d = _answered(active, asked(judge, _requests(pieces, "consistency_review", k), rounds), "consistency_review")
        return d.withColumns({"consistency_round": F.when(F.col("gap_hit"), k).otherwise(F.col("consistency_round")), "consistency_rounds": F.when(F.col("hit"), k).otherwise(F.col("consistency_rounds"))})

    state = rounds.put(loop(rounds.put(state), policy.consistency_rounds, consistency, lambda d: F.col("moved")))
    _, before = _quality(shots, state, policy, rounds)
    before = rounds.put(before)

    def degenerate(active: DataFrame, k: int) -> DataFrame:
        own = active.select("video_id", "shots").distinct()
        whole = sequences.focus_windows(own, policy.degenerate_focus, policy.degenerate_focus, policy.degenerate_context)
        d = _answered(active, asked(judge, _requests(whole, "degenerate_review", k), rounds), "degenerate_review")
        d = d.withColumns({"degenerate_review": F.lit(True), "degenerate_rounds": F.lit(k)})
        mine = shots.join(own.select("video_id").hint("merge"), "video_id", "left_semi")
        _, now = _quality(mine, d, policy, rounds)
        return d.join(now.select("video_id", F.col("suspicious").alias("still")).hint("merge"), "video_id").withColumn("moved", F.col("moved") & F.col("still")).drop("still")

    if policy.degenerate_review:
        odd = before.filter("suspicious").select("video_id")
        again = state.join(odd.hint("merge"), "video_id", "left_semi")
        if not again.isEmpty():
            again = loop(again, policy.degenerate_rounds, degenerate, lambda d: F.col("moved"))
            state = rounds.put(state.join(odd.hint("merge"), "video_id", "left_anti").unionByName(again))
    scenes, after = _quality(shots, state, policy, rounds)
    run = state.groupBy("video_id").agg(F.max("consistency_rounds").alias("consistency_rounds"), F.max("degenerate_review").alias("degenerate_triggered"), F.max("degenerate_rounds").alias("degenerate_rounds"))
    first = before.select("video_id", F.col("boundary_count").alias("first_boundary_count"), F.col("suspicious").alias("first_suspicious"))
    videos = after.join(first.hint("merge"), "video_id").join(run.hint("merge"), "video_id", "left").na.fill(0, ["consistency_rounds", "degenerate_rounds"]).na.fill(False, ["degenerate_triggered"])
    status = F.when(F.col("suspicious"), "suspicious").when(F.col("first_suspicious"), "mended").otherwise("pass")
    return Reviewed(state.drop("shots", "split", "consistency_rounds", "degenerate_rounds"), scenes, videos.withColumn("status", status))
