"""The scene review against a version that walks one video at a time."""

import zlib
from statistics import median

import pytest
from pyspark.sql import functions as F

from skerry.plans import reviews

KINDS = {"primary": 3, "focused_review": 2, "consistency_review": 3, "degenerate_review": 4}


def label(video, kind, round_, window, gap):
    return video % 4 == 0 and kind != "degenerate_review" or zlib.crc32(f"{video}|{kind}|{round_}|{window}|{gap}".encode()) % KINDS[kind] == 0


def judge(requests):
    text = F.concat_ws("|", "video_id", "kind", "round", "window", "gap")
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    found = F.crc32(text.cast("binary")) % kinds[F.col("kind")] == 0
    return requests.select("video_id", "window", "gap", (((F.col("video_id") % 4 == 0) & (F.col("kind") != "degenerate_review")) | found).alias("boundary"))


def windows(gaps, length, stride):
    out = []
    for start in range(0, gaps, stride):
        out.append((start // stride, start, min(gaps, start + length)))
        if out[-1][2] == gaps:
            break
    return out


def quality(labels, p):
    shots = len(labels) + 1
    ends = [g for g, x in enumerate(labels) if x] + [shots - 1]
    sizes = [b - a for a, b in zip([-1, *ends], ends)]
    density = sum(labels) / len(labels) if labels else 0.0
    single = sum(s == 1 for s in sizes) / len(sizes)
    odd = p.quality_guard and shots >= p.least_shots and ((bool(labels) and all(labels)) or (density >= p.density and single >= p.one_shot_rate))
    return odd, len(sizes), median(sizes)


def plain(video, shots, p):
    gaps = shots - 1
    votes = [[] for _ in range(gaps)]
    for w, start, end in windows(gaps, p.focus_gaps, p.stride):
        for g in range(start, end):
            deepest = max(1, (end - start - 1) // 2)
            votes[g].append((label(video, "primary", 0, w, g), 1 + min(g - start, end - 1 - g) / deepest))
    now, routes, at_round = [], [], [None] * gaps
    for g, v in enumerate(votes):
        score = sum(w for x, w in v if x) / sum(w for _, w in v)
        sure = score >= p.boundary_at or score <= p.same_at
        now.append(score >= p.boundary_at if sure else label(video, "focused_review", 0, g, g))
        routes.append("primary" if sure else "focused_review")
    rounds = again = 0
    for k in range(1, p.consistency_rounds + 1):
        hit = {g for g in range(gaps) for d in (-1, 1) if now[g] and 0 <= g + d < gaps and now[g + d]}
        for s in range(max(1, gaps - p.dense_window + 1) if gaps else 0):
            part = range(s, min(gaps, s + p.dense_window))
            if sum(now[g] for g in part) >= p.dense_count:
                hit |= set(part)
        hit |= {g for g, v in enumerate(votes) if len(v) >= p.least_votes and len({x for x, _ in v}) == 2}
        if not hit:
            break
        rounds, before = k, list(now)
        wide = sorted({g for h in hit for g in range(max(0, h - p.context_shots), min(gaps, h + p.context_shots + 1))})
        regions = []
        for g in wide:
            if regions and g == regions[-1][-1] + 1:
                regions[-1].append(g)
            else:
                regions.append([g])
        for r in regions:
            for i in range(0, len(r), p.focus_gaps):
                for g in r[i : i + p.focus_gaps]:
                    now[g], routes[g], at_round[g] = label(video, "consistency_review", k, r[i], g), "consistency_review", k
        if now == before:
            break
    first = quality(now, p)[0]
    for k in range(1, p.degenerate_rounds + 1) if first and p.degenerate_review else ():
        again, before = k, list(now)
        for w, start, end in windows(gaps, p.degenerate_focus, p.degenerate_focus):
            for g in range(start, end):
                now[g], routes[g] = label(video, "degenerate_review", k, w, g), "degenerate_review"
        if now == before or not quality(now, p)[0]:
            break
    odd, scenes, mid = quality(now, p)
    return [(video, g, now[g], routes[g], at_round[g], again > 0) for g in range(gaps)], (video, shots, scenes, mid, first, odd, rounds, again)


POLICIES = [reviews.ReviewPolicy(), reviews.ReviewPolicy(consistency_rounds=4, degenerate_rounds=3, context_shots=1, density=0.5, one_shot_rate=0.4), reviews.ReviewPolicy(focus_gaps=3, stride=2, quality_guard=False, consistency_rounds=0)]


def shots_of(spark, sizes):
    return spark.createDataFrame([(v, i, float(i), float(i + 1), 1) for v, n in sizes.items() for i in range(n)], "video_id long, shot_index long, start_sec double, end_sec double, frames long")


@pytest.mark.parametrize("policy", POLICIES)
def test_against_one_video_at_a_time(spark, policy):
    sizes = dict(enumerate([1, 2, 3, 4, 5, 7, 8, 9, 10, 14, 15, 16, 20, 23, 31, 40, 41, 6, 1, 2, 12, 26, 3, 30, 17]))
    got = reviews.reviewed(shots_of(spark, sizes), judge, policy)
    want = [plain(v, n, policy) for v, n in sizes.items()]
    columns = ["video_id", "gap", "boundary", "route", "consistency_round", "degenerate_review"]
    assert sorted(tuple(r) for r in got.decisions.select(columns).collect()) == sorted((x for d, _ in want for x in d), key=lambda x: x[:2])
    columns = ["video_id", "shot_count", "scene_count", "median_shots", "first_suspicious", "suspicious", "consistency_rounds", "degenerate_rounds"]
    assert sorted(tuple(r) for r in got.videos.select(columns).collect()) == [v for _, v in want]
    assert got.scenes.agg(F.sum("shot_count")).first()[0] == sum(sizes.values())


@pytest.mark.parametrize("wrong", [lambda r: judge(r).filter("gap <> 3"), lambda r: judge(r).unionAll(judge(r).filter("gap = 2")), lambda r: judge(r).withColumn("boundary", F.when(F.col("gap") != 1, F.col("boundary"))), lambda r: judge(r).withColumn("gap", F.col("gap") + 1)])
def test_answers_must_fit_the_question(spark, wrong):
    with pytest.raises(ValueError, match="answer every gap"):
        reviews.reviewed(shots_of(spark, {1: 6}), wrong)


def test_policy_and_empty(spark):
    with pytest.raises(ValueError, match="no gap"):
        reviews.ReviewPolicy(stride=9)
    got = reviews.reviewed(shots_of(spark, {}), judge)
    assert got.decisions.count() == got.scenes.count() == got.videos.count() == 0


def test_reasons_and_confidences(spark):
    told = lambda r: judge(r).withColumns({"reason": F.concat_ws("/", F.lit("w"), "window"), "confidence": F.lit(0.25)})
    rows = reviews.reviewed(shots_of(spark, {1: 12}), told, reviews.ReviewPolicy(consistency_rounds=0)).decisions.filter("route = 'primary'").collect()
    assert rows and all(r.confidence == 0.25 and r.reason == f"w/{1 if r.gap >= 6 else 0}" for r in rows)


def test_timeline_is_gone_through_once(spark, sf_dir, monkeypatch):
    """the rounds read the shots and labels of a stored table, not the events again."""
    from skerry.queries import reviews as queries
    from skerry.queries.base import Loader

    seen = []
    monkeypatch.setattr(queries.reviews, "reviewed", lambda shots, judge, policy: seen.append(shots))
    queries._reviewed(Loader(spark, sf_dir))
    assert seen[0].count() > 0 and not any("events.parquet" in f for f in seen[0].inputFiles())


def test_rounds_are_joined_by_merges(spark):
    """tables of a round are small as files only, so no join may send one through the driver."""
    plans = []

    def watched(requests):
        plans.append(judge(requests)._jdf.queryExecution().executedPlan().toString())
        return judge(requests)

    got = reviews.reviewed(shots_of(spark, {v: 12 for v in range(8)}), watched, POLICIES[1])
    plans += [d._jdf.queryExecution().executedPlan().toString() for d in got]
    assert len(plans) > 5 and not any("Broadcast" in p for p in plans)
