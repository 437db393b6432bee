"""Decontamination finds all that its verification accepts: every pattern of differing words, every length of item."""

import itertools

import pytest

from skerry.llm import decontaminate
from tests.llm.conftest import SCHEMA


def accepted(n):
    """Places that differ in a window of n words, as far as 80 % agree."""
    return itertools.combinations(range(n), n - -(-80 * n // 100))


@pytest.mark.parametrize("n", range(1, 21))
def test_masks_miss_no_pattern(n):
    masks = [[k for k, c in enumerate(m) if c == "1"] for m in decontaminate.masks_of(n)]
    laid = [{s + k for k in m} for m in masks for s in range(n - m[-1])]
    assert all(any(not m & set(gone) for m in laid) for gone in accepted(n))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 10, 12, 13, 16, 20])
def test_all_patterns_at_both_parities(spark, n):
    item = [f"word{i}" for i in range(n)]
    docs = []
    for gone in accepted(n):
        w = ["other" if i in gone else x for i, x in enumerate(item)]
        docs += [" ".join(["before"] * k + w + ["after"]) for k in (1, 2)]
    d = spark.createDataFrame([(k, t, "en", "web", 0) for k, t in enumerate(docs)] + [(-1, "nothing of it here", "en", "web", 0)], SCHEMA)
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {x.doc_id for x in decontaminate.leaks(d, b).collect()} == set(range(len(docs)))
    assert [x.doc_id for x in decontaminate.clean(d, b).collect()] == [-1]


def test_items_of_all_lengths_together(spark):
    items = {n: " ".join(f"i{n}x{k}" for k in range(n)) for n in (1, 3, 4, 7, 9, 12, 30)}
    docs = [(n, f"a b {t} c", "en", "web", 0) for n, t in items.items()] + [(99, "i3x0 i3x1 no i3x2", "en", "web", 0)]
    got = decontaminate.leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id, x.agreeing) for x in got} == {(n, n, n) for n in items}
