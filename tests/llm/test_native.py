"""Quality rules, line dedup, sharding and decontamination: SQL on the small tables, fixtures for the rest."""

import hashlib
import random
from collections import defaultdict

import pytest

from skerry.llm import decontaminate, lines, quality, shards
from skerry.llm.common import Scratch
from skerry.llm.queries import QUERIES
from skerry.llm.sql import ORACLE
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(name, spark, sf_dir, same):
    same(QUERIES[name](spark, sf_dir), ORACLE[name])


@pytest.mark.parametrize("name", ["op3_lines", "op6_sharding", "op7_quality", "op10_decontamination"])
def test_native_plans_have_no_python(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# ---- quality


def words(r, n):
    return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 7))) for _ in range(n))


def test_thresholds_follow_the_group(spark):
    """A source whose documents all have many symbols keeps them; elsewhere such a document goes."""
    r = random.Random(1)
    rows = [(i, words(r, 80), "en", "web", 0) for i in range(100)] + [(200 + i, " # ".join(words(r, 1) for _ in range(60)), "en", "code", 0) for i in range(100)]
    rows += [(900, " # ".join(words(r, 1) for _ in range(60)), "en", "web", 0), (901, "too short", "en", "web", 0), (902, "spam eggs ham " * 40, "en", "web", 0)]
    got = {x.doc_id: x for x in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].kept for i in range(100)) and all(got[200 + i].kept for i in range(100))
    assert not got[900].kept and not got[900].base_failed
    assert got[901].base_failed and got[902].base_failed and not got[902].kept


def test_repeated_words_by_hand(spark):
    d = spark.createDataFrame([(1, "a b c a b c d", "en", "x", 0), (2, "a a a a", "en", "x", 0), (3, "a b c", "en", "x", 0), (4, "x y\nx y\n\nz\nx y", "en", "x", 0)], SCHEMA)
    got = {x.doc_id: x for x in quality.judge(d).collect()}
    assert [got[k].n_repeat_words for k in (1, 2, 3)] == [6, 4, 0]
    assert got[4].n_dup_lines == 2 and got[4].n_words == 7 and got[4].word_chars == 7


def test_bounds_adapt(spark):
    """Two sources with different symbol rates get different bounds, and what is kept differs from any fixed cut-off."""
    r = random.Random(3)

    def text(rate):
        return " ".join(w + ("#" if r.random() < rate else "") for w in words(r, 200).split(" "))

    rows = [(i, text(0.01 + 0.02 * r.random()), "en", "web", 0) for i in range(150)] + [(300 + i, text(0.1 + 0.1 * r.random()), "en", "forum", 0) for i in range(150)]
    rows += [(900, text(0.45), "en", "web", 0), (901, text(0.45), "en", "forum", 0)]
    d = spark.createDataFrame(rows, SCHEMA)
    counted = Scratch(spark, "counts").put(quality.counts(d))
    found = {x.source: x.max_symbols for x in quality.thresholds(counted).collect()}
    assert found["forum"] > 2 * found["web"]
    kept = {x.doc_id: x.kept for x in quality.judge(d).collect()}
    assert all(k for i, k in kept.items() if i < 900) and not kept[900] and kept[901]


def test_junk_does_not_lift_its_bound(spark):
    """A source that is mostly junk is held by its language's bound."""
    r = random.Random(4)
    junk = lambda: " ".join(w + "$$%" for w in words(r, 100).split(" "))
    rows = [(i, words(r, r.randint(60, 400)), "en", f"s{i % 8}", 0) for i in range(800)] + [(1000 + i, junk(), "en", "bad", 0) for i in range(90)] + [(2000 + i, words(r, 90), "en", "bad", 0) for i in range(40)]
    kept = {x.doc_id: x.kept for x in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(kept[i] for i in kept if i < 1000 or i >= 2000) and not any(kept[i] for i in kept if 1000 <= i < 2000)


def test_small_groups_take_the_languages_bounds(spark):
    r = random.Random(2)
    rows = [(i, words(r, 80), "en", f"s{i}", 0) for i in range(60)] + [(900, " # ".join(words(r, 1) for _ in range(60)), "en", "s900", 0)]
    got = {x.doc_id: x.kept for x in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] for i in range(60)) and not got[900]


# ---- lines


def test_lines_equal_brute_force(spark):
    r = random.Random(5)
    pool = [words(r, r.randint(3, 14)) for _ in range(25)]
    texts = {}
    for k in range(60):
        rows = []
        for _ in range(r.randint(1, 6)):
            t = r.choice(pool).split(" ")
            if r.random() < 0.4:
                t[r.randrange(len(t))] = r.choice(["17", "x9", "other", "4.5"])
            rows.append(r.choice(["", " "]) + " ".join(t))
        texts[k] = "\n".join(rows)
    d = spark.createDataFrame([(k, t, "en", "web", len(t)) for k, t in texts.items()], SCHEMA)
    gone = brute.lines_dropped(texts)
    got = {x.doc_id: x for x in lines.report(d).collect()}
    for k, t in texts.items():
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k])
        assert (got[k].n_dropped, got[k].kept_sha256) == (len(gone[k]), hashlib.sha256(kept.encode()).hexdigest())
    rewritten = {x.doc_id: x.text for x in lines.rewrite(d).collect()}
    assert rewritten == brute.lines_rewritten(texts)


def test_varying_fields_are_one_template(spark):
    rows = [(k, f"Downloaded {k} times since 2024-01-0{k} by our readers", "en", "web", 0) for k in range(1, 6)]
    got = {x.doc_id: x.n_dropped for x in lines.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1}


# ---- sharding


@pytest.mark.parametrize("limit", [1, 300, 5000, 10**9])
def test_shards(spark, limit):
    r = random.Random(limit)
    rows = [(k, words(r, r.randint(0, 60)), "en", "web", 0) for k in range(200)] + [(500, "same text", "en", "web", 0)] * 5 + [(600, "x" * 4000, "en", "web", 0)]
    got = shards.assign(spark.createDataFrame(rows, SCHEMA), limit).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for x in got:
        by[x.shard].append(x)
    small = {s: v for s, v in by.items() if not s.startswith("large-")}
    for s, v in small.items():
        assert sum(x.n_bytes for x in v) == v[0].shard_bytes and len(v) == v[0].shard_docs
        assert v[0].shard_bytes <= limit or len({x.hash for x in v}) == 1
        assert all(format(x.hash, "060b").startswith(s) and x.depth == len(s) for x in v)
        # it was split only because its parent was over the limit
        if s:
            assert sum(x.n_bytes for t, w in small.items() if t.startswith(s[:-1]) for x in w) > limit
    # prefixes of shards don't overlap
    names = sorted(small)
    assert all(not b.startswith(a) for a, b in zip(names, names[1:]))


def test_written_shards(spark, tmp_path):
    d = spark.createDataFrame([(k, f"text {k} " * 20, "en", "web", 0) for k in range(50)], SCHEMA)
    shards.write(d, f"{tmp_path}/out", 2000)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 50 and back.select("shard").distinct().count() > 3


# ---- decontamination


def contaminated(r, item, swaps):
    w = item.split(" ")
    for i in range(4, len(w), max(1, len(w) // swaps)) if swaps else ():
        w[i] = "changed"
    return words(r, 20) + " " + " ".join(w) + " " + words(r, 20)


def test_planted_passages(spark):
    r = random.Random(8)
    items = {k: words(r, 40) for k in range(10)}
    docs = {k: contaminated(r, items[k % 10], k % 4) for k in range(40)} | {100 + k: words(r, 120) for k in range(40)}
    docs[200] = items[3].upper().replace(" ", ", ")
    d = spark.createDataFrame([(k, t, "en", "web", 0) for k, t in docs.items()], SCHEMA)
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in decontaminate.leaks(d, b).collect()}
    assert set(got) == {(k, k % 10) for k in range(40)} | {(200, 3)}
    assert got[0, 0].agreeing == 40 and got[0, 0].best == 20 and got[1, 1].agreeing < 40
    assert {x.doc_id for x in decontaminate.clean(d, b).collect()} == {100 + k for k in range(40)}


def test_substitutions_at_the_gaps_are_found(spark):
    item = " ".join(f"word{i}" for i in range(20))
    rows = []
    for k in range(20):
        w = item.split(" ")
        w[k] = "other"
        rows.append((k, " ".join(w), "en", "web", 0))
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.leaks(spark.createDataFrame(rows, SCHEMA), b).count() == 20
