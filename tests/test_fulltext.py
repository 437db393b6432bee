"""Tokens against SQLite's own tokenizer, phrases against a scan."""

import random
import sqlite3
import unicodedata

import pytest
from pyspark.sql import functions as F

from skerry.functions import fulltext
from skerry.sources import shared


@pytest.fixture(scope="module")
def sqlite():
    c = sqlite3.connect(":memory:")
    try:
        c.execute("CREATE VIRTUAL TABLE t USING fts5(x, tokenize='unicode61')")
    except sqlite3.OperationalError:
        pytest.skip("this SQLite has no full-text search")
    c.execute("CREATE VIRTUAL TABLE v USING fts5vocab(t, 'instance')")
    return c


def _tokens(sqlite, texts):
    sqlite.execute("DELETE FROM t")
    sqlite.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", enumerate(texts))
    out = [[] for _ in texts]
    for doc, term, _ in sqlite.execute('SELECT doc, term, "offset" FROM v ORDER BY doc, "offset"'):
        out[doc].append(term)
    return out


def _ours(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    return [r.t for r in d.select("i", fulltext.terms(F.col("x")).alias("t")).orderBy("i").collect()]


def _old(c):
    """Whether a character means the same in the tokenizer's Unicode as today: letters and numbers of long standing, with the case that they had then."""
    return not ("Ͱ" <= c <= "ͳ" or c in "ͶͷͿ" or "Ԧ" <= c <= "ԯ" or "Ⴠ" <= c <= "ჿ" or "Ꭰ" <= c <= "᏿" or "ᲀ" <= c <= "Ჿ" or "Ꙁ" <= c <= "ꟿ" or "ꬰ" <= c <= "ꮿ")


def test_letters_and_numbers_fold_as_in_sqlite(spark, sqlite):
    letters = [chr(i) for i in range(0x80, 0x2200) if unicodedata.category(chr(i))[0] in "LN" and _old(chr(i))]
    theirs, ours = _tokens(sqlite, letters), _ours(spark, letters)
    differ = [(hex(ord(c)), a, b) for c, a, b in zip(letters, theirs, ours) if a != b and len(a) == len(b) == 1]
    assert not differ
    # what one of the tables doesn't know as a letter yet
    assert sum(len(a) != 1 or len(b) != 1 for a, b in zip(theirs, ours)) < 0.04 * len(letters)


def test_texts_as_in_sqlite(spark, sqlite):
    rng = random.Random(5)
    parts = ["déjà", "deja", "DÉJÀ", "déjà", "ñandú", "Ünïcödé", "straße", "ΣΊΣΥΦΟΣ", "Việt", "ộ", "İstanbul", "o'neil", "a_b", "x-1", "3.14", " ", "\n", "_", "—", "́", "a̅b", "ﬁ", "Å", "ſ", "µ", "١٢", "東京"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "-", ", "]) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["", "   ", "̀"]
    assert _ours(spark, texts) == _tokens(sqlite, texts)
    assert _ours(spark, [None]) == [[]]


def test_accents_are_those_of_sqlite(sqlite):
    marks = [chr(i) for i in range(0x300, 0x370)]
    assert "".join(m for m, t in zip(marks, _tokens(sqlite, [f"a{m}b" for m in marks])) if t == ["ab"]) == fulltext.ACCENTS


@pytest.fixture(scope="module")
def index(spark):
    rng, words = random.Random(7), ["a", "b", "c", "A", "á"]
    texts = {i: " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40]))) for i in range(80)} | {100: None, 101: "déjà vu, encore", 102: "deja-vu"}
    path = shared.new_path(spark, "index")
    fulltext.write_index(spark.createDataFrame(list(texts.items()), "id long, x string"), "id", F.col("x"), path)
    yield texts, spark.read.parquet(path)
    shared.removed(spark, path)


@pytest.mark.parametrize("phrase", ["a", "a b", "a a", "a a a", "A, b. á", "c b a c", "z", "déjà vu", "Deja VU encore", "", "..."])
def test_phrases_against_a_scan(index, phrase):
    texts, table = index
    bare = {"á": "a", "é": "e", "à": "a"}
    words = lambda x: "".join(c if c.isalnum() else " " for c in "".join(bare.get(c, c) for c in (x or "").lower())).split()
    want = words(phrase)
    places = sorted((k, i) for k, x in texts.items() for i in range(len(words(x))) if want and words(x)[i : i + len(want)] == want)
    assert sorted(tuple(r) for r in fulltext.phrase_places(table, "id", phrase).collect()) == places


def test_positions_round_trip(spark, index):
    texts, table = index
    rows = table.filter("id = 3 OR id = 101").select("id", "token", fulltext.places(F.col("gaps")).alias("p")).collect()
    got = {k: sorted((p, r.token) for r in rows if r.id == k for p in r.p) for k in (3, 101)}
    assert [t for _, t in got[101]] == ["deja", "vu", "encore"] and [p for p, _ in got[3]] == list(range(len((texts[3] or "").split())))


def test_only_the_tokens_folders_are_read(index):
    plan = fulltext.phrase_places(index[1], "id", "déjà vu")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and "PushedFilters: [In(token" in plan


def test_all_phrases_must_be_there(index):
    assert {r.id: r.hits for r in fulltext.matching(index[1], "id", ["vu", "deja vu", "encore"]).collect()} == {101: 3}
    assert sorted(r.id for r in fulltext.prefixed(index[1], "id", "DÉ").collect()) == [101, 102]
    with pytest.raises(ValueError, match="one word"):
        fulltext.prefixed(index[1], "id", "a b")


def test_postings_need_no_shuffle(spark, monkeypatch):
    monkeypatch.setattr(fulltext, "ROWS", 2)
    d = spark.createDataFrame([(1, "b a B"), (2, None), (None, "a"), (4, "!"), (5, "x y x x")], "id long, text string").coalesce(1)
    found = fulltext.postings(d, "id", F.col("text"))
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.token, r.id): r.gaps for r in found.collect()} == {("b", 1): [0, 2], ("a", 1): [1], ("a", None): [0], ("x", 5): [0, 2, 1], ("y", 5): [1]}
