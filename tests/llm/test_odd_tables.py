"""Every operator on the odd table, on an empty one, and with columns whose names clash."""

import pytest
from pyspark.sql import functions as F

from skerry.llm import bpe, chat, decontaminate, html, infill, jaccard, licenses, lines, pii, quality, resample, shards
from skerry.llm.common import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")
BYTES = tokenizer_path("byte_bpe_50k.json")


def _items(d):
    text = "the quick brown fox jumps over the lazy dog while seven wise owls watch"
    return d.sparkSession.createDataFrame([(1, text), (None, text + " quietly"), (2, None), (3, ""), (4, "too short")], "item_id long, text string")


def _pages(d):
    return d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.concat(F.lit("<article><p>"), "text", F.lit("</p></article>")).alias("html"), *[c for c in d.columns if c not in ("doc_id", "source", "text")])


def _turns(d):
    return d.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text", *[c for c in d.columns if c not in ("doc_id", "n_chars", "lang", "text")])


OPERATORS = {
    "bpe": (lambda d: bpe.round_trip(d, WORDS), True),
    "pii": (pii.find, True),
    "lines": (lines.report, True),
    "lines.rewrite": (lines.rewrite, None),
    "jaccard": (jaccard.components, True),
    "jaccard.keep_one": (jaccard.keep_one, None),
    "licenses": (licenses.find, True),
    "shards": (shards.assign, True),
    "quality": (quality.judge, True),
    "quality.keep_good": (quality.keep_good, None),
    "html": (lambda d: html.find(_pages(d)), True),
    "chat": (lambda d: chat.digests(_turns(d), BYTES), False),
    "resample": (lambda d: resample.draw(d, _items(d)), True),
    "infill": (infill.digests, True),
    "decontaminate": (lambda d: decontaminate.leaks(d, _items(d)), False),
    "decontaminate.clean": (lambda d: decontaminate.clean(d, _items(d)), None),
}


def rows(d, columns):
    return sorted(map(repr, d.select(*columns).collect()))


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_and_clashing(name, odd, odd_rows, clashing):
    run, one_each = OPERATORS[name]
    plain = run(odd)
    columns = [c for c in plain.columns]
    want = rows(plain, columns)
    if one_each:
        assert len(want) == len(odd_rows)
    more = run(clashing(odd))
    assert rows(more, columns) == want
    if one_each is None:  # filters give their input's columns
        assert plain.columns == odd.columns and more.columns == clashing(odd).columns


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty(name, empty):
    assert OPERATORS[name][0](empty).count() == 0


def test_empty_benchmark(odd, odd_rows):
    none = _items(odd).limit(0)
    assert decontaminate.leaks(odd, none).count() == 0
    assert decontaminate.clean(odd, none).count() == len(odd_rows)
