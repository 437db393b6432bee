import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.operators import intervals, sequences


def test_touching_intervals_do_not_overlap(spark):
    a = spark.createDataFrame([("v", 0, 0.0, 10.0), ("v", 1, 10.0, 200.0)], "video_id string, entity_id int, start_sec double, end_sec double")
    b = spark.createDataFrame([("v", 7, 10.0, 12.0), ("v", 8, 50.0, 130.0)], "video_id string, segment_id int, start_sec double, end_sec double")
    got = {(r.entity_id, r.segment_id): r for r in intervals.overlapping(a, b).collect()}
    assert set(got) == {(1, 7), (1, 8)}  # each pair once, also across buckets
    assert got[1, 8].segment_coverage == 1.0 and got[1, 8].overlap_sec == 80.0


def test_a_word_centred_on_a_border_goes_right(spark):
    shots = spark.createDataFrame([("v", 0, 0.0, 5.0), ("v", 1, 5.0, 9.0)], "video_id string, entity_id int, start_sec double, end_sec double")
    words = spark.createDataFrame([("v", 1, 4.5, 5.5), ("v", 2, 4.0, 5.2)], "video_id string, segment_id int, start_sec double, end_sec double")
    assert {r.segment_id: r.entity_id for r in intervals.best_interval(words, shots).collect()} == {1: 1, 2: 0}


def test_ranges_on_a_timeline(spark):
    t = spark.createDataFrame([("v", i, i * 0.5) for i in range(5)], "video_id string, frame_id long, pts_time double")
    r = spark.createDataFrame([(1, "v", -3.0, -2.0), (2, "v", 0.6, 0.9), (3, "v", 1.0, 1.0), (4, "v", 1.9, 99.0)], "range_id long, video_id string, start_sec double, end_sec double")
    got = {x.range_id: (x.start_frame, x.end_frame) for x in intervals.as_of_frames(r, t).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (2, 3), 4: (3, 5)}


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [("v", int(f), float(p)) for f, p in zip(rng.permutation(40), rng.integers(0, 15, 40))]
    targets = [("v", k, float(t)) for k, t in enumerate(rng.integers(-3, 18, 30))]
    a = spark.createDataFrame(targets, "video_id string, target_id long, target double")
    b = spark.createDataFrame(rows, "video_id string, frame_id long, pts_time double")
    got = {r.target_id: r.nearest for r in intervals.nearest(a, b, "pts_time").collect()}
    assert got == {k: min(rows, key=lambda x: (abs(x[2] - t), x[1]))[1] for _, k, t in targets}


def test_unknown_ids_are_errors(spark):
    top = spark.createDataFrame([(1, 1), (99, 2)], "vector_id long, rank int")
    with pytest.raises(Exception, match="no metadata for 99"):
        intervals.looked_up(top, spark.createDataFrame([(1, "x")], "vector_id long, title string")).collect()


def predictions(spark, values):
    return spark.createDataFrame([("v", i, float(x)) for i, x in enumerate(values)], "video_id string, frame_id long, value double")


@pytest.mark.parametrize("values,want", [([0, 0, 1, 1, 1, 0, 0], [(0, 3), (4, 6)]), ([1, 1, 1], [(0, 2)]), ([1, 0, 0, 1], [(0, 3)]), ([0, 1, 0, 1, 0], [(0, 1), (2, 3), (4, 4)]), ([0], [(0, 0)])])
def test_cuts(spark, values, want):
    assert sorted((r.start_frame, r.end_frame) for r in sequences.cuts(predictions(spark, values), 0.5).collect()) == want


def test_windows_cover_every_gap(spark):
    for shots in range(1, 40):
        d = spark.createDataFrame([("v", shots)], "video_id string, shots long")
        rows = sequences.focus_windows(d).collect() if shots in (1, 2, 8, 9, 10, 15, 16, 39) else None
        if rows is not None:
            assert {g for r in rows for g in range(r.first_gap, r.last_gap + 1)} == set(range(shots - 1))
            assert sum(r.last_gap == shots - 2 for r in rows) == (shots > 1)


def pack(ranges, longest, gap, overlap, shortest):
    """Plain loop of the greedy packing."""
    out = []
    for s, e in sorted(r for r in ranges if r[1] - r[0] >= shortest):
        if out and s - out[-1][1] <= gap and e - out[-1][0] <= longest:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    pieces = []
    for s, e in out:
        at = s
        while True:
            end = e if e - at <= longest else at + longest
            pieces.append((round(at, 6), round(end, 6)))
            if end >= e:
                break
            at += longest - overlap
    return [p for p in sorted(pieces) if p[1] - p[0] >= shortest]


def test_packing_equals_the_loop(spark):
    rng = np.random.default_rng(8)
    videos = {}
    for k in range(12):
        cuts = np.sort(rng.uniform(0, 80, 14)).round(2)
        videos[f"v{k}"] = [(float(a), float(b)) for a, b in zip(cuts[::2], cuts[1::2]) if b > a]
    d = spark.createDataFrame([(v, a, b) for v, r in videos.items() for a, b in r], "video_id string, start_sec double, end_sec double")
    got = {}
    for r in sequences.packed(d, 12.0, 1.0, 2.0, 0.5).collect():
        got.setdefault(r.video_id, []).append((round(r.start_sec, 6), round(r.end_sec, 6)))
    assert {v: sorted(x) for v, x in got.items()} == {v: p for v, r in videos.items() if (p := pack(r, 12.0, 1.0, 2.0, 0.5))}


def test_merge_and_slack(spark):
    d = spark.createDataFrame([("v", 0, 4), ("v", 5, 6), ("v", 8, 9), ("v", 1, 2)], "g string, s long, e long")
    got = sequences.merged(d, "g", "s", "e", 1).orderBy("s").collect()
    assert [(r.s, r.e, r.parts) for r in got] == [(0, 6, 3), (8, 9, 1)]


def test_overlaps_are_trimmed_and_rejection_breaks_the_chain(spark):
    d = spark.createDataFrame([("v", 0, "one two three", True), ("v", 1, "Two, three four", True), ("v", 2, "four five", False), ("v", 3, "four five six", True)], "video_id string, chunk int, text string, accepted boolean")
    got = [r.kept for r in sequences.trimmed_overlaps(d).orderBy("chunk").collect()]
    assert got == ["one two three", "four", "four five", "four five six"]


def test_probes_halve_the_widest_gap(spark):
    d = spark.createDataFrame([("s", [0.0, 1.0, 4.0, 5.0, 6.0, 10.0]), ("t", [0.0, 1.0])], "shot_id string, times array<double>")
    got = {r.shot_id: r.probes for r in sequences.bisection(d, 3.0, 5).collect()}
    assert got["t"] == [] and got["s"][0] in (4.0, 5.0, 6.0) and len(got["s"]) <= 4


def test_novelty(spark):
    d = spark.createDataFrame([("s", 0.0, 0), ("s", 1.0, -1), ("s", 5.0, 1), ("s", 9.0, -1), ("s", 20.0, 0x0F0F0F0F0F0F0F0F)], "shot_id string, time double, signature bigint")
    assert sorted(r.time for r in sequences.novel(d, 2.0, 0.45, 3).collect()) == [0.0, 9.0, 20.0]


def test_variable_rate(spark):
    rows = [("c", i, i * 0.04, 0.04) for i in range(9)] + [("x", i, i * 0.04 + (0.02 if i > 4 else 0), 0.04) for i in range(9)] + [("s", 0, 0.0, 0.1), ("s", 1, 0.1, 0.1)]
    d = spark.createDataFrame(rows, "video_id string, frame_id long, pts_time double, duration_time double")
    assert {r.video_id: r.variable for r in sequences.variable_rate(d).collect()} == {"c": False, "x": True, "s": None}


def test_runs_of_an_empty_table(spark):
    assert sequences.longest_run(predictions(spark, []), "video_id", "frame_id", F.col("value") > 0).count() == 0


def test_lookups_of_a_hot_video(spark):
    # linear in a video's rows
    n = 100_000
    frames = spark.range(n).select(F.lit("v").alias("video_id"), F.col("id").alias("frame_id"), F.col("id").cast("double").alias("pts_time"))
    at = spark.range(n).select(F.lit("v").alias("video_id"), F.col("id").alias("target_id"), (F.col("id") + 0.25).alias("target"))
    assert intervals.nearest(at, frames, "pts_time").filter("nearest = target_id").count() == n
    ranges = at.select("video_id", F.col("target_id").alias("range_id"), F.col("target").alias("start_sec"), (F.col("target") + 1).alias("end_sec"))
    got = intervals.as_of_frames(ranges, frames)
    assert got.filter(f"start_frame = range_id AND end_frame = least(range_id + 2, {n})").count() == n


def test_novel_picks_run_without_a_python_call_per_shot(spark):
    d = spark.createDataFrame([("a", 0.0, 0), ("a", 1.0, -1), ("a", 2.0, -1), ("a", 5.0, 1), ("a", 6.0, 0x0F0F0F0F), ("a", 8.0, 0x0F0F0F0F << 8), (None, 3.0, 7)], "shot_id string, time double, signature long")
    found = sequences.novel(d, 2.0, 0.25, 3)
    assert "Python" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "InPandas" not in plan
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("a", 0.0, 0), ("a", 2.0, -1), ("a", 6.0, 0x0F0F0F0F), (None, 3.0, 7)], key=str)
