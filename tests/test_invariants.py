"""Package invariants fault by fault, and half precision against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.functions import vectors
from skerry.operators import events
from skerry.plans import checks


def _tables(video="v"):
    """Two scenes of two shots of ten frames, two keyframes a shot."""
    shots = [[video, i, f"{video}_SH{i:05d}", f"{video}_SC{i // 2:05d}", 10 * i, 10 * i + 10, 0.4 * i, 0.4 * i + 0.4] for i in range(4)]
    scenes = [[video, i, f"{video}_SC{i:05d}", 2, 20 * i, 20 * i + 20, 0.8 * i, 0.8 * i + 0.8] for i in range(2)]
    keyframes = [[video, f"{video}:{10 * i + k}", 10 * i + k, f"{video}_SH{i:05d}", f"{video}_SC{i // 2:05d}", "supplemental" if k else "start", k == 0] for i in range(4) for k in (0, 5)]
    return [shots, scenes, keyframes, [[video, f"{video}:5"]], [[video, s[2], f"{video}:{s[4]}"] for s in shots], [[video, s[2]] for s in scenes]]


SCHEMAS = [
    "video_id string, shot_index int, shot_id string, scene_id string, start_frame long, end_frame long, start_sec double, end_sec double", "video_id string, scene_index int, scene_id string, shot_count long, start_frame long, end_frame long, start_sec double, end_sec double",
    "video_id string, keyframe_id string, frame_id long, shot_id string, scene_id string, role string, is_representative boolean", "video_id string, keyframe_id string", "video_id string, shot_id string, keyframe_id string", "video_id string, scene_id string",
]

FAULTS = {
    "fine": (lambda t: None, set()),
    "gap": (lambda t: t[0][1].__setitem__(4, 11), {"shot ranges are not contiguous", "keyframe outside its shot"}),
    "empty": (lambda t: t[0][3].__setitem__(7, 1.0), {"shot range is empty"}),
    "time": (lambda t: t[0][1].__setitem__(6, 0.41), {"shot times are not contiguous"}),
    "index": (lambda t: t[0][3].__setitem__(1, 5), {"shot_index is not 0, 1, .."}),
    "scene index": (lambda t: t[1][1].__setitem__(1, 3), {"scene_index is not 0, 1, .."}),
    "scene times": (lambda t: t[1][1].__setitem__(6, 0.9), {"scene times are not contiguous"}),
    "scene empty": (lambda t: t[1][1].__setitem__(7, 0.8), {"scene range is empty"}),
    "name": (lambda t: [t[0][3].__setitem__(2, "x"), [k.__setitem__(3, "x") for k in t[2][6:]], t[4][3].__setitem__(1, "x")], {"shot_id does not follow the order"}),
    "scene name": (lambda t: [[x.__setitem__(3, "x") for x in t[0][2:]], t[1][1].__setitem__(2, "x"), [k.__setitem__(4, "x") for k in t[2][4:]], t[5][1].__setitem__(1, "x")], {"scene_id does not follow the order"}),
    "no representative": (lambda t: t[2][0].__setitem__(6, False), {"shot without one representative"}),
    "supplemental": (lambda t: [t[2][0].__setitem__(6, False), t[2][1].__setitem__(6, True), t[4][0].__setitem__(2, "v:5")], {"supplemental representative"}),
    "keyframe name": (lambda t: [t[2][3].__setitem__(1, "v:99")], {"keyframe_id does not name its frame"}),
    "repeats": (lambda t: t[2].append(list(t[2][1])), {"keyframe_id repeats"}),
    "text": (lambda t: t[3].append(["v", "v:77"]), {"text of an unknown keyframe"}),
    "captions": (lambda t: t[4].append(list(t[4][0])), {"shot without one caption"}),
    "caption lost": (lambda t: t[4].pop(), {"shot without one caption"}),
    "strange caption": (lambda t: t[4].append(["v", "none", "v:0"]), {"shot without one caption"}),
    "summary": (lambda t: t[5].pop(), {"scene without one summary"}),
    "mapping": (lambda t: t[2][1].__setitem__(4, None), {"scene mapping is incomplete"}),
    "count": (lambda t: t[1][0].__setitem__(3, 3), {"scene does not count its shots"}),
    "scene range": (lambda t: [t[1][0].__setitem__(5, 21), t[1][1].__setitem__(4, 21)], {"scene range differs from its shots"}),
    "unknown shot": (lambda t: t[2].append(["v", "v:40", 40, "none", "v_SC00001", "supplemental", False]), {"keyframe of an unknown shot"}),
    "outside": (lambda t: t[2].append(["v", "v:10", 10, "v_SH00000", "v_SC00000", "supplemental", False]), {"keyframe outside its shot", "keyframe_id repeats"}),
    "other scene": (lambda t: t[2][1].__setitem__(4, "v_SC00001"), {"keyframe of another scene"}),
    "caption of another": (lambda t: t[4][1].__setitem__(2, "v:15"), {"caption of another representative"}),
}


def test_each_invariant(spark):
    """Every case is a video of its own; all are checked at once."""
    tables, want = [[] for _ in SCHEMAS], {}
    for k, (change, faults) in enumerate(FAULTS.values()):
        case = _tables()
        change(case)
        for table, rows in zip(tables, case):
            table += [[f"v{k}", *[x.replace("v_", f"v{k}_").replace("v:", f"v{k}:") if isinstance(x, str) else x for x in r[1:]]] for r in rows]
        want[f"v{k}"] = faults
    frames = [spark.createDataFrame([tuple(r) for r in rows], schema) for rows, schema in zip(tables, SCHEMAS)]
    found = checks.package_invariants(*frames)
    got = {v: set() for v in want}
    for r in found.collect():
        got[r.video_id].add(r.check)
    assert got == want
    assert {c for _, x in FAULTS.values() for c in x} | {"scene ranges are not contiguous"} == set(checks.INVARIANTS)
    assert checks.package_invariants(*[f.limit(0) for f in frames]).count() == 0


def test_one_shuffle(spark):
    frames = [spark.createDataFrame([tuple(r) for r in rows], schema) for rows, schema in zip(_tables(), SCHEMAS)]
    plan = checks.package_invariants(*frames)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange single" not in plan


def test_partitions_are_not_joined(spark):
    """the rows keep a number of partitions that adaptive execution doesn't join into large tasks."""
    frames = [spark.createDataFrame([tuple(r) for r in rows], schema) for rows, schema in zip(_tables(), SCHEMAS)]
    plan = checks.package_invariants(*frames)._jdf.queryExecution().executedPlan().toString()
    assert f", {checks.PACKAGE_PARTS}), REPARTITION_BY_NUM" in plan and checks.PACKAGE_PARTS <= 200


# ---- half precision


def test_half_as_numpy(spark):
    r = random.Random(2)
    values = [0.0, -0.0, 1.0, 2.0**-14, 2.0**-24, 2.0**-25, 2.0**-26, 65504.0, 65519.99, 65520.0, -70000.0, float("inf"), float("nan"), 2049.0, 2051.0, -2049.0, 0.1, 1 / 3]
    values += [s * m * 2.0**e for e in range(-26, 17) for m in (1, 1 + 2.0**-11, 1 + 3 * 2.0**-11, 1 + 2.0**-10, 1 + 2.0**-11 + 2.0**-20, 2 - 2.0**-11, 2 - 2.0**-12) for s in (1, -1)] + [r.gauss(0, 1) * 10.0 ** r.randint(-8, 5) for _ in range(2000)]
    single = np.array(values, dtype=np.float32)
    d = spark.createDataFrame([(i, float(x)) for i, x in enumerate(single)], "i int, x double")
    got = np.array([r.h for r in d.select("i", vectors.half(F.col("x")).alias("h")).orderBy("i").collect()], dtype=np.float32)
    with np.errstate(over="ignore"):
        want = single.astype(np.float16).astype(np.float32)
    assert np.array_equal(got, want, equal_nan=True)
    assert spark.range(1).select(vectors.half(F.lit(None).cast("double"))).first()[0] is None


@pytest.mark.parametrize("size", [1, 7, 64, 200])
def test_scores_and_ranks_as_numpy(spark, size):
    rng = np.random.default_rng(size)
    stored = rng.normal(size=(150, size)).astype(np.float32)
    stored = (stored / np.linalg.norm(stored, axis=1, keepdims=True)).astype(np.float16)
    stored[1::3] = stored[::3]  # ties
    query = stored[4].astype(np.float32) + np.float32(0.01)
    want = np.zeros(len(stored), dtype=np.float32)
    for i, row in enumerate(stored):
        total = np.float32(0)
        for a, b in zip(row.astype(np.float32), query.astype(np.float16).astype(np.float32)):
            total = np.float32(total + a * b)
        want[i] = np.float32(np.float16(total))
    frames = spark.createDataFrame([("v", i, [float(x) for x in r]) for i, r in enumerate(stored)], "video_id string, vector_id int, embedding array<float>")
    got = {r.vector_id: r.s[0] for r in events.scored(frames, [[float(x) for x in query]], half=True).collect()}
    assert [got[i] for i in range(len(stored))] == want.tolist()
    assert np.allclose(want, (stored @ query.astype(np.float16)).astype(np.float32), atol=2e-3)
