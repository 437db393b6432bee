"""Resampling and fill-in-middle against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from skerry.llm import infill, resample
from skerry.llm.common import Scratch
from skerry.llm.queries import QUERIES
from skerry.llm.sql import ORACLE


def _words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def _grams(text):
    w = _words(text)
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _bucket(gram):
    return zlib.crc32(gram.encode()) % 10000


def plain_draw(rows, target):
    """[(doc_id, n_features, weight, score, rank)] of rows [(doc_id, text)]."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(_bucket, _grams(text)))
    for text in target:
        t.update(map(_bucket, _grams(text)))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for k, text in rows:
        grams = _grams(text)
        weight = sum(gain[_bucket(g)] for g in grams)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(_words(text)) >= 20])
    fit = sorted((x for x in out if x[5]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    for i, x in enumerate(fit[: 5 * len(fit) // 100]):
        x[4] = i + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


def _drawn(docs, target):
    return sorted((tuple(r)[:5] for r in resample.draw(docs, target).collect()), key=repr)


def test_draw_against_plain(spark, documents, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert _drawn(documents, target) == plain_draw(rows, [r.text for r in target.collect()])


def test_draw_odd_rows(spark, odd, odd_rows):
    many = odd
    for _ in range(2):  # repeated rows tie with one another
        many = many.unionAll(many)
    target = spark.createDataFrame([("The quick brown FOX jumps",), (None,), ("",)], "text string")
    assert _drawn(many, target) == plain_draw([r[:2] for r in odd_rows] * 4, ["The quick brown FOX jumps", None, ""])
    assert _drawn(odd, target.limit(0)) == plain_draw([r[:2] for r in odd_rows], [])


def test_capitals_beyond_ascii_stay(spark):
    rows = [(1, "ÉCOLE Ünder X" * 9), (2, "école Ünder x"), (3, "İstanbul KKELVIN ẞ")]
    assert _drawn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("École x",)], "text string")) == plain_draw(rows, ["École x"])


def test_share_drawn_and_sampled(documents, spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    d = resample.draw(documents, target, percent=30)
    ranks = sorted(r["rank"] for r in d.filter("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 30 * d.filter("n_words >= 20").count() // 100 + 1))
    kept = resample.sampled(documents.withColumn("rank", F.lit("clash")), target, percent=30)
    assert kept.columns == [*documents.columns, "rank"] and kept.count() == len(ranks)


def test_numbered_is_global(spark):
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 331).alias("v")).repartition(7)
    scratch = Scratch(spark, "numbered")
    got = resample.numbered(rows, [F.desc("v"), F.asc("id")], "k", scratch).collect()
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.k)] == sorted(((i * 7919 % 331, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))
    assert sorted(r.k for r in got) == list(range(1, 5001))
    scratch.close()


def plain_infill(k, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = [int(hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infill_against_plain(spark, odd, odd_rows):
    extra = [(k, x) for k in range(100, 160) for x in ("a<P>b", "x < P> <S <<M", "<P<S<M", "line\nbreak\r\n\t z", "é́\U0001f600a" * (k % 5), "<")]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionAll(more)
    d = infill.transform(docs)
    got = [tuple(r) for r in d.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()]
    rows = [(k, x or "") for k, x in [r[:2] for r in odd_rows] + extra]
    assert sorted(got, key=repr) == sorted(((k, *plain_infill(k, x), x) for k, x in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_ranks_at_both_ends():
    for text in ("word", "a b", "...", "x1"):
        n = infill.count_units(text)
        for a in range(n + 1):
            for b in range(a, n + 1):
                units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
                assert infill.ends_of(text, a, b) == (len("".join(units[:a])), len("".join(units[:b])))
    assert infill.count_units("") == 0


def test_queries_against_sql(spark, sf_dir, same):
    for name in ("op11_resampling", "op12_infill"):
        same(QUERIES[name](spark, sf_dir), ORACLE[name])
