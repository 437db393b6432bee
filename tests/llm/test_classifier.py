"""The quality classifier: held-out accuracy, its parts against plain versions, odd tables."""

import re
import zlib

import numpy as np
import pytest

from skerry.llm import classifier
from skerry.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    rows = QUERIES["op13_classifier"](spark, big).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{big}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q, _ in unseen if q], [s for s, q, _ in unseen if not q]
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.97 and np.mean([p == q for _, q, p in unseen]) > 0.95


def test_only_the_text_counts_and_held_out_labels_do_not(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    want = {r.doc_id: r.score for r in classifier.judge(docs, labels).collect()}
    turned = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "label": F.lit("clash"), "features": F.lit(1), "place": F.lit("z"), "key": F.lit("k")})
    assert {r.doc_id: r.score for r in classifier.judge(other, turned.withColumn("label", F.lit(3))).collect()} == want


def plain_features(text):
    """Number of distinct n-grams, hash collisions aside."""
    tokens = re.findall(r"[A-Za-z\x80-\U0010FFFF]+|[0-9]+|[^A-Za-z0-9\x80-\U0010FFFF\s]+", text)
    words = [t.lower() for t in tokens]
    shapes = ["=" if i and words[i - 1] == w else "s" + classifier.shape_of(t) for i, (w, t) in enumerate(zip(words, tokens))]
    grams = {("w", *words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)}
    return len(grams | {("s", *shapes[i : i + n]) for n in (1, 2, 3) for i in range(len(shapes) - n + 1)})


def test_features(texts):
    tokens = classifier.Tokens()
    for text in [*texts.values()][:60]:
        found = classifier.features(text or "", tokens)
        assert list(found) == sorted(set(found)) and abs(len(found) - plain_features(text or "")) <= 0.01 * len(found) + 1
    assert len(classifier.features("", tokens)) == 0 and list(classifier.features("A a!!", tokens)) == list(classifier.features("A a!!", classifier.Tokens()))


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 12)).astype(np.int32) for _ in range(120)]
    ratios = rng.normal(size=40)
    signs = np.where([ratios[x].sum() + 0.5 * rng.normal() > 0 for x in rows], 1, -1)
    w = classifier.dual_descent(rows, ratios, signs)
    x = np.zeros((120, 41))
    for i, r in enumerate(rows):
        x[i, r], x[i, 40] = ratios[r] / np.sqrt(len(r)), 1
    cost = np.where(signs > 0, 60 / (signs > 0).sum(), 60 / (signs < 0).sum())

    def value(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - signs * (x @ v))).sum()

    best, v = value(w), w.copy()
    for step in range(1, 4000):  # subgradient steps find nothing much better
        v = v - 1 / (step + 50) * (v - (cost * signs * (signs * (x @ v) < 1)) @ x)
        best = min(best, value(v))
    assert value(w) <= best * 1.01


@pytest.mark.parametrize("marks", [[], [(5, 1), (6, 1), (7, None), (None, 0)], [(5, 1), (5, 0), (8, 0), (3, 1), (3, 1), (12, 0)]])
def test_few_labels(spark, odd, odd_rows, clashing, marks):
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    key = lambda rows: sorted(map(repr, rows))
    got = classifier.judge(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert key(classifier.judge(clashing(odd), clashing(labels)).collect()) == key(got)
    assert classifier.judge(odd.limit(0), labels).count() == 0
