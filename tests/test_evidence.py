import pytest

from skerry.operators import evidence


def test_bands_widen_to_the_safe_interior():
    bands = evidence.role_bands(0.4, 0.6, 0.1, 0.05, 0.95)
    assert bands[0] == (0.4, 0.6) and bands[-1] == (0.05, 0.95) and all(a >= c and b <= d for (a, b), (c, d) in zip(bands, bands[1:]))


def test_candidates_keep_their_first_round(spark):
    d = spark.createDataFrame([("s", 0, 100), ("t", 0, 1)], "shot_id string, start_frame long, end_frame long")
    got = evidence.role_candidates(d, {"middle": [(0.4, 0.6), (0.0, 1.0)]}, 5).collect()
    assert {(r.frame_id, r.round) for r in got if r.shot_id == "s"} == {(40, 0), (45, 0), (50, 0), (54, 0), (59, 0), (0, 1), (25, 1), (74, 1), (99, 1)}
    assert [(r.frame_id, r.round) for r in got if r.shot_id == "t"] == [(0, 0)]


SCHEMA = "shot_id string, role string, round int, frame_id long, target_frame double, center double, quality double, valid boolean"


@pytest.mark.parametrize("middle,reason,representative", [(0.95, "middle_within_quality_ratio", "middle"), (0.5, "highest_quality_fallback", "late")])
def test_representative(spark, middle, reason, representative):
    rows = [("s", "early", 0, 10, 10.0, 50.0, 0.9, False), ("s", "early", 1, 12, 10.0, 50.0, 0.4, True), ("s", "middle", 0, 50, 50.0, 50.0, middle, True), ("s", "late", 0, 90, 90.0, 50.0, 1.0, True), ("s", "late", 1, 91, 90.0, 50.0, 9.0, True)]
    got = {r.role: r for r in evidence.role_keyframes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["early"].frame_id == 12 and got["late"].frame_id == 90  # the first round with a valid frame decides
    assert [(r.role, r.reason) for r in got.values() if r.is_representative] == [(representative, reason)]


def test_frames_are_claimed_once(spark):
    rows = [("s", role, 0, 5, 5.0, 5.0, 1.0, True) for role in ("late", "early", "middle")]
    got = evidence.role_keyframes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.role, r.is_representative) for r in got] == [("middle", True)]


FRAME = "shot_id string, keyframe_id string, time double, frame_id long, is_representative boolean, is_supplemental boolean, image long, status string, words string"


def modes(spark, rows, seconds):
    f = spark.createDataFrame(rows, FRAME)
    shots = spark.createDataFrame([("s", 0.0, seconds)], "shot_id string, start_sec double, end_sec double")
    return evidence.caption_modes(shots, f, 0.25, 0.5, 3.0, 3).first()


def test_caption_modes(spark):
    a = ("s", "a", 0.0, 0, True, False, 0, "pass", "x")
    b = ("s", "b", 1.0, 1, False, False, -1, "pass", "x")
    c = ("s", "c", 2.0, 2, False, True, 0, "failed", "")
    assert modes(spark, [a, b], 5.0)[1:] == ("temporal_storyboard", ["visual_change"], ["a", "b"])
    assert modes(spark, [a, b], 2.0)[1:] == ("representative_only", [], ["a"])  # too short for changes to count
    assert modes(spark, [a, c], 2.0)[1:] == ("temporal_storyboard", ["meaningful_supplemental"], ["a", "c"])
    assert modes(spark, [a, ("s", "d", 3.0, 3, False, False, 0, "pass", "x")], 5.0)[1:] == ("representative_only", [], ["a"])  # an exact copy
    many = [a] + [("s", f"k{i}", float(i), i, False, False, -(i % 2), "pass", f"w{i}") for i in range(1, 6)]
    assert len(modes(spark, many, 9.0).sources) == 3
