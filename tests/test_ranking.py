import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.functions import vectors
from skerry.operators import filters, ranking

rng = np.random.default_rng(5)


def unit(n, d=8):
    v = rng.normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def frames(spark):
    v = unit(300)
    return v, spark.createDataFrame([(i, f"V{i // 50}", v[i].tolist()) for i in range(300)], "vector_id long, video_id string, embedding array<double>")


def test_top_k_equals_numpy(frames):
    v, d = frames
    q = v[11]
    want = sorted(range(300), key=lambda i: (-float(v[i] @ q), i))[:10]
    got = ranking.ranked(ranking.cosine_top_k(d, q.tolist(), 10)).orderBy("rank").collect()
    assert [r.vector_id for r in got] == want
    assert math.isclose(got[0].score, 1.0)


def test_ties_go_to_the_smaller_id(spark):
    d = spark.createDataFrame([(i, [1.0, 0.0]) for i in (5, 3, 9, 1)], "vector_id long, embedding array<double>")
    assert [r.vector_id for r in ranking.ranked(ranking.cosine_top_k(d, [1.0, 0.0], 3)).orderBy("rank").collect()] == [1, 3, 5]


def test_top_k_is_no_full_sort(frames):
    v, d = frames
    assert "TakeOrderedAndProject" in ranking.cosine_top_k(d, v[0].tolist(), 5)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [0, 201, -3])
def test_k_outside_1_to_200(frames, k):
    v, d = frames
    with pytest.raises(ValueError):
        ranking.search(d, v[0].tolist(), k)


def test_pool_is_twice_k(frames):
    v, d = frames
    assert ranking.search(d, v[0].tolist(), 20).count() == 40


def test_source_goes_after_the_cut(frames):
    v, d = frames
    got = ranking.more_like_this(d, 7, v[7].tolist(), 10).collect()
    assert len(got) == 9 and 7 not in {r.vector_id for r in got}


def test_inverted_lists_have_high_recall(frames):
    v, d = frames
    indexed, centroids = ranking.ivf(d, 6)
    indexed = indexed.cache()
    hits = 0
    for i in range(0, 300, 50):
        want = set(np.argsort(-(v @ v[i]))[:10].tolist())
        hits += len(want & {r.vector_id for r in ranking.ivf_top_k(indexed, centroids, v[i].tolist(), 10, 4).collect()})
    assert hits / 60 >= 0.8


@pytest.mark.parametrize("vector", [[1.0], [0.0] * 4, [float("nan")] * 4])
def test_query_vectors_are_checked(vector):
    with pytest.raises(ValueError):
        vectors.unit_list(vector, 4)


def test_zero_vector_is_an_error(spark):
    d = spark.createDataFrame([([0.0, 0.0],)], "v array<double>")
    with pytest.raises(Exception, match="finite norm"):
        d.select(vectors.unit(F.col("v"))).collect()


@pytest.mark.parametrize("number,first", [(-4, 1), (1, 1), (2, 11), (3, 21), (99, 21)])
def test_page_is_clamped(spark, number, first):
    d = spark.range(1, 26).withColumnRenamed("id", "rank")
    assert ranking.page(d, number, 10, 25).agg(F.min("rank")).first()[0] == first


@pytest.mark.parametrize("n,k,want", [(10, 1, [5]), (3, 7, [0, 1, 2]), (11, 3, [0, 5, 10]), (10, 4, [0, 3, 6, 9]), (0, 3, [])])
def test_even_positions(spark, n, k, want):
    d = spark.createDataFrame([("a", i) for i in range(n)], "g string, i int")
    assert sorted(r.i for r in ranking.evenly_sampled(d, "g", ["i"], k).collect()) == want


@pytest.mark.parametrize("bound", ["2024-1-05", "2024-13-01", "yesterday"])
def test_dates_are_strict(bound):
    with pytest.raises(ValueError):
        filters.SearchFilters(date_from=bound).predicate()


def test_dates_in_order():
    with pytest.raises(ValueError):
        filters.SearchFilters(date_from="2024-05-02", date_to="2024-05-01").predicate()


def test_unknown_dates_pass_an_upper_bound_only(spark):
    d = spark.createDataFrame([("a", ""), ("b", "2024-03-01"), ("c", "2024-06-01")], "video_id string, publish_date_iso string")
    got = lambda **k: sorted(r.video_id for r in d.filter(filters.SearchFilters(**k).predicate()).collect())
    assert got(date_from="2024-01-01") == ["b", "c"]
    assert got(date_to="2024-04-01") == ["a", "b"]


def test_number_fields_take_numbers_only(spark):
    d = spark.createDataFrame([(0, "x"), (7, "y70")], "keyframe_no int, title string")
    with pytest.raises(ValueError):
        filters.refine(d, "abc", "keyframe_no")
    assert filters.refine(d, "0").collect()[0].title == "y70"  # a zero shows as nothing
    assert filters.refine(d, "7", "keyframe_no").count() == 1
