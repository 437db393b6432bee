import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.operators import dedup, events


def pool(spark, vectors, scores=None):
    scores = scores or [1 - 0.01 * i for i in range(len(vectors))]
    return spark.createDataFrame([(i, i + 1, float(s), list(map(float, v))) for i, (v, s) in enumerate(zip(vectors, scores))], "vector_id long, rank int, score double, embedding array<double>")


def at(cosine):
    return [cosine, float(np.sqrt(1 - cosine**2))]


@pytest.mark.parametrize("cosine,duplicates", [(0.94 + 1e-12, 1), (0.939, 0)])
def test_threshold_is_inclusive(spark, cosine, duplicates):
    got = dedup.anchored(pool(spark, [[1, 0], at(cosine)])).orderBy("rank").collect()
    assert [r.duplicates for r in got] == [0, duplicates]
    assert got[1].similar_to == (0 if duplicates else None)
    assert abs(got[1].adjusted - 0.99 * 0.4**duplicates) < 1e-12


def test_empty_and_single_pools(spark):
    assert dedup.anchored(pool(spark, [])).count() == 0
    assert dedup.linked(pool(spark, [])).count() == 0
    assert dedup.linked(pool(spark, [[1, 0]])).collect()[0].cluster == 0


def test_demoted_frames_demote_others(spark):
    got = dedup.anchored(pool(spark, [[1, 0], at(0.97), at(0.96)])).orderBy("rank").collect()
    assert [r.duplicates for r in got] == [0, 1, 2]


def test_headless_clusters_vanish(spark):
    # the anchor has the worst score after demotion of nothing, so trimming to one keeps another row
    d = dedup.anchored(pool(spark, [[1, 0], at(0.97), [0, 1]], [0.9, 0.8, 0.7]))
    kept = dedup.trimmed(d, 2)
    assert dedup.clusters(kept).count() == 0
    assert dedup.clusters(d).first().size == 1


def test_complete_linkage_does_not_chain(spark):
    # a~b and a~c at the threshold, b and c further apart
    a, b, c = [1, 0], at(0.945), [0.945, -float(np.sqrt(1 - 0.945**2))]
    got = {r.vector_id: r.cluster for r in dedup.linked(pool(spark, [a, b, c])).collect()}
    assert len(set(got.values())) == 2


def test_linkage_property(spark):
    v = np.random.default_rng(2).normal(size=(40, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    got = dedup.linked(pool(spark, v.tolist()), 0.8).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.cluster, []).append(r.vector_id)
    for members in groups.values():
        assert all(v[i] @ v[j] >= 0.8 - 1e-9 for i, j in itertools.combinations(members, 2))
    # no two clusters could still be joined
    for a, b in itertools.combinations(groups.values(), 2):
        assert min(v[i] @ v[j] for i in a for j in b) < 0.8


# ---- event sequences


def loop(s, by_min, w):
    """Direct recurrences: the best prefix by (smallest, sum) or by sum, first index on ties."""
    n, m = len(s), len(s[0])
    if n < m:
        return None
    state = [(s[i][0] if by_min else 0.0, s[i][0], [i]) for i in range(n)]
    for j in range(1, m):
        new = [None] * n
        for i in range(n):
            best = None
            for k in range(i):
                if state[k] is None:
                    continue
                lifted = (state[k][0] + w * k if by_min else 0.0, state[k][1] + w * k)
                if best is None or lifted > best[0]:
                    best = (lifted, state[k][2])
            if best:
                new[i] = (min(best[0][0] - w * i, s[i][j]) if by_min else 0.0, best[0][1] - w * i + s[i][j], best[1] + [i])
        state = new
    done = [x for x in state if x is not None]
    top = max(done, key=lambda x: (x[0], x[1])) if done else None
    return None if top is None else (top[0] if by_min else top[1], top[2])


@pytest.mark.parametrize("objective", list(events.OBJECTIVES))
@pytest.mark.parametrize("m", [1, 2, 3, 6])
def test_paths_equal_the_loop(spark, objective, m):
    rng = np.random.default_rng(m)
    videos = {f"v{k}": (rng.integers(-3, 4, size=(rng.integers(1, 12), m)) / 4 if k % 2 else rng.normal(size=(rng.integers(1, 12), m))).tolist() for k in range(30)}
    d = spark.createDataFrame([(v, i, list(map(float, row))) for v, s in videos.items() for i, row in enumerate(s)], "video_id string, i int, s array<double>")
    by_min, penalised = events.OBJECTIVES[objective]
    got = {r.video_id: r for r in events.best_paths(d, m, objective, 1 / 32).collect()}
    for v, s in videos.items():
        want = loop(s, by_min, 1 / 32 if penalised else 0.0)
        if want is None:
            assert v not in got
        else:
            assert got[v].path == want[1], v
            assert abs(got[v].score - want[0]) < 1e-9


def test_unknown_objective(spark):
    with pytest.raises(ValueError):
        events.best_paths(spark.createDataFrame([], "video_id string, i int, s array<double>"), 2, "max")


@pytest.mark.parametrize("texts", [[], ["", "  "], list("abcdefg")])
def test_one_to_six_events(texts):
    with pytest.raises(ValueError):
        events.event_texts(texts)


def test_jitter():
    rows = events.jittered("L01_V001", [100, 200, 300], 1000, 20, 12)
    assert rows == events.jittered("L01_V001", [100, 200, 300], 1000, 20, 12)
    assert rows != events.jittered("L01_V002", [100, 200, 300], 1000, 20, 12)
    assert rows[0] == [100, 200, 300] and len(rows) == 20 == len({tuple(r) for r in rows})
    assert all(abs(a - b) <= 12 for r in rows for a, b in zip(r, rows[0]))
    assert all(max(r) <= 5 and min(r) >= 0 for r in events.jittered("x", [1, 2, 3], 5, 10, 50))


@pytest.mark.parametrize("frames,largest,want", [([5, 5, 5], 100, [5, 6, 7]), ([98, 99, 150], 100, [98, 99, 100]), ([1, 1, 1], 1, [0, 0, 1]), ([-4, 3], 10, [0, 3])])
def test_clamping(spark, frames, largest, want):
    d = spark.createDataFrame([(frames,)], "f array<bigint>")
    assert d.select(events.clamp_increasing(F.col("f"), F.lit(largest))).first()[0] == want
    assert events.jittered("v", frames, largest, 1, 0)[0] == want


def test_pins(spark):
    m = spark.createDataFrame([("a", 1, [1, 2]), ("b", 2, [3, 4])], "video_id string, rank int, frames array<bigint>")
    p = spark.createDataFrame([("b|1", 9), ("b", 5), ("a|x", 7)], "key string, frame bigint")
    got = events.pinned(m, p).orderBy("position").collect()
    assert [(r.video_id, r.frames) for r in got] == [("b", [3, 9]), ("a", [1, 2])]


def test_ctc_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        steps, targets = int(rng.integers(4, 7)), rng.integers(1, 4, size=2).tolist()
        if targets[0] == targets[1]:
            steps = max(steps, 4)
        logs = np.log(rng.dirichlet(np.ones(4), size=steps))
        path = events.ctc_path(logs, targets)
        states = [0, targets[0], 0, targets[1], 0]
        best = -np.inf
        for cand in itertools.product(range(5), repeat=steps):
            if cand[0] > 1 or cand[-1] < 3:
                continue
            if all(0 <= b - a <= 1 or (b - a == 2 and states[b] != 0 and states[b] != states[a]) for a, b in zip(cand, cand[1:])):
                best = max(best, sum(logs[t, states[k]] for t, k in enumerate(cand)))
        assert abs(sum(logs[t, states[k]] for t, k in enumerate(path)) - best) < 1e-9


def test_nearest_references_equal_brute_force(spark):
    r = np.random.default_rng(4)
    values = lambda n: [None if v < 0.1 else round(float(v * 9), 1) for v in r.random(n)]
    a = [(f"v{i % 4}", i, v) for i, v in enumerate(values(120))]
    b = [(f"v{i % 3}", i, v) for i, v in enumerate(values(60))]
    a += [("v0", 0, 2.0), (None, 500, 1.0), ("v1", 501, float("nan"))]
    b += [(None, 900, 1.0), ("v1", 901, float("nan")), ("v2", 902, float("inf"))]
    got = dedup.nearest_references(
        spark.createDataFrame(a, "video_id string, candidate_id long, x double"), spark.createDataFrame(b, "video_id string, reference_id long, y double"), "video_id", "x", "y"
    )
    best = {}
    for v, c, x in a:
        for w, i, y in b:
            if v is not None and v == w and None not in (x, y) and x == x and y == y:
                best[v, c] = min(best.get((v, c), (np.inf, 10**9)), (abs(x - y), i))
    assert {(g.video_id, g.candidate_id): (g.distance, g.nearest) for g in got.collect()} == best
    assert not any(v == "v3" for v, _ in best)


def test_nearest_references_of_empty_tables(spark):
    a = spark.createDataFrame([("v", 1, 1.0)], "video_id string, candidate_id long, x double")
    b = spark.createDataFrame([], "video_id string, reference_id long, y double")
    assert dedup.nearest_references(a, b, "video_id", "x", "y").count() == 0
    assert dedup.nearest_references(a.limit(0), b, "video_id", "x", "y").count() == 0


def test_nearest_references_of_a_hot_group(spark):
    # 4 * 10^10 pairs
    n = 200_000
    a = spark.range(n).select(F.lit("v").alias("video_id"), F.col("id").alias("candidate_id"), (F.col("id") * 7919 % n + 0.25).alias("x"))
    b = spark.range(n).select(F.lit("v").alias("video_id"), F.col("id").alias("reference_id"), F.col("id").alias("y"))
    got = dedup.nearest_references(a, b, "video_id", "x", "y").agg(F.count("*").alias("n"), F.sum("distance").alias("d"), F.count_if(F.col("nearest") == F.col("candidate_id") * 7919 % n).alias("right")).first()
    assert (got.n, got.d, got.right) == (n, n / 4, n)


def frames_of(spark, sizes):
    rows = [(v, i, 1000 * k + 7 * i) for k, (v, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "video_id string, keyframe_no int, vector_id long"), {r[2]: r[:2] for r in rows}


def test_benchmark_cases_are_what_they_say(spark):
    d, at = frames_of(spark, {"a": 10, "b": 12, "c": 9, "d": 40})
    got = sorted(events.benchmark_cases(d).collect())
    assert [(r.case_id, r.category) for r in got] == [(i, "positive" if i < 30 else "distractor") for i in range(60)]
    for r in got:
        (v1, n1), (v2, n2), (v3, n3) = (at[i] for i in r.query_vector_ids)
        assert v1 == v2 == r.expected_video_id and n2 == n1 + 1 and "c" not in (v1, v3)
        assert (v3, n3) == (v1, n1 + 2) if r.category == "positive" else v3 != v1
    assert {r.expected_video_id for r in got} == {"a", "b", "d"}


def test_benchmark_cases_do_not_follow_the_partitioning(spark):
    d, _ = frames_of(spark, {f"v{i}": 10 + i for i in range(20)})
    odd = d.unionByName(spark.createDataFrame([(None, 1, 5), ("v1", 1, None)], d.schema))
    assert sorted(events.benchmark_cases(d.repartition(1)).collect()) == sorted(events.benchmark_cases(odd.repartition(7, "vector_id")).collect())
    assert sorted(events.benchmark_cases(d).collect()) != sorted(events.benchmark_cases(d, seed=43).collect())


def test_benchmark_cases_of_few_videos(spark):
    d, _ = frames_of(spark, {"a": 10, "b": 9})
    assert {r.category for r in events.benchmark_cases(d).collect()} == {"positive"}
    assert events.benchmark_cases(d.limit(0)).count() == 0
    assert events.benchmark_cases(d, positives=0, distractors=3, least=3).count() == 3
    with pytest.raises(ValueError):
        events.benchmark_cases(d, positives=0, distractors=0)
