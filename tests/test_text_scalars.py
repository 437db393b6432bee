import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from skerry.functions import scalars, text


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize("raw,want", [
    ("red car", text.Query("red car")), ("L21, red", text.Query("red", ("L21",))), ("L21_V001", text.Query("", (), ("L21_V001",))),
    ("L21_V001_007", text.Query("", (), ("L21_V001",), (("L21_V001", 7),))), ("L21_V001, 7", text.Query("", (), ("L21_V001",), (("L21_V001", 7),))), ("", text.Query("")), (None, text.Query("")),
])
def test_query_box(raw, want):
    assert text.parse_query(raw) == want


@pytest.mark.parametrize("raw", ["L21_V001_007, dog", "7, 8", "7", "L21_V001, 7, dog"])
def test_query_box_errors(raw):
    with pytest.raises(ValueError):
        text.parse_query(raw)


def test_the_column_form_agrees(spark):
    raws = ["red car", "L21, red", "L21_V001", "L21_V001_007, L21_V001_7", "L21_V001, 7", "", "7, 8", "L21_V001_007, dog", "l21, L21 , L21"]
    got = spark.createDataFrame([(r,) for r in raws], "raw string").select("raw", text.parsed_queries(F.col("raw")).alias("q")).collect()
    for r in got:
        try:
            want = text.parse_query(r.raw)
        except ValueError:
            assert r.q.error
            continue
        assert (r.q.text, tuple(r.q.collections), tuple(r.q.videos), tuple(r.q.keyframes)) == (want.text, want.collections, want.videos, tuple(f"{v}_{n}" for v, n in want.keyframes))


@pytest.mark.parametrize("raw,want", [("Điện Biên Phủ", "Đien Bien Phu"), ("café", "cafe"), (None, None), ("", "")])
def test_marks_go_and_strokes_stay(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(text.without_marks(F.col("t")).alias("x")).first().x == want


def test_comparable(spark):
    assert spark.createDataFrame([("Straße,  ＡＢＣ!",)], "t string").select(text.comparable(F.col("t")).alias("x")).first().x == "strasse abc"


@pytest.mark.parametrize("raw,want", [("- a\n* b\n1. c\n<none>\nA\n\n", ["a", "b", "c"]), ("", []), (None, [])])
def test_lines(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(text.line_list(F.col("t")).alias("x")).first().x == want


@pytest.mark.parametrize("most,want", [(5, "ab cd"), (4, "ab"), (1, ""), (99, "ab cd efg")])
def test_whole_words_within_a_budget(spark, most, want):
    assert one(spark, F.array_join(text.bounded_words(F.split(F.lit("ab cd efg"), " "), most), " ")) == want


@pytest.mark.parametrize("raw,want", [("5/3/2024", "2024-03-05"), ("2024-3-5", "2024-03-05"), ("31/02/2024", ""), ("", ""), ("03-05-2024", "")])
def test_dates(spark, raw, want):
    assert one(spark, scalars.iso_or_empty(F.lit(raw))) == want


def test_unsupported_dates_are_errors(spark):
    assert one(spark, scalars.iso_or_error(F.lit(" "))) is None
    with pytest.raises(Exception, match="unsupported date"):
        one(spark, scalars.iso_or_error(F.lit("soon")))


@pytest.mark.parametrize("pts,fps,want", [(1.0, 25.0, 25), (-3.0, 25.0, 0), (None, 25.0, None), (float("nan"), 25.0, None), (2.0, 0.0, None), (0.9999999, 10.0, 10), (0.999999, 10.0, 9)])
def test_frames(spark, pts, fps, want):
    assert one(spark, scalars.frame_of(F.lit(pts).cast("double"), F.lit(fps))) == want


@pytest.mark.parametrize("x", [1000.125, 1000.375, 93750.25, 93750.75, 0.1234565, 2.0000005, 1e-320, -1000.125, 1.7e308])
def test_six_digits_round_the_exact_value_half_to_even(spark, x):
    assert one(spark, scalars.six_digits(F.lit(x))) == float(f"{x:.6g}")


@pytest.mark.parametrize("s,want", [(0.0, "00:00:00.000"), (3661.0625, "01:01:01.062"), (59.9996, "00:01:00.000"), (360000.0, "100:00:00.000")])
def test_clock_rounds_half_to_even(spark, s, want):
    assert one(spark, scalars.clock(F.lit(s))) == want


@pytest.mark.parametrize("raw,want", [("30000/1001", 30000 / 1001), ("25", 25.0), ("0/0", None), ("x/2", None), ("", None)])
def test_rates(spark, raw, want):
    assert one(spark, scalars.rate(F.lit(raw))) == want


def test_null_is_not_zero(spark):
    assert one(spark, scalars.confidence(F.lit("none"))) is None
    assert one(spark, scalars.confidence(F.lit("1.7"))) == 1.0
    assert one(spark, scalars.bounded_ratio(F.lit(1.0), F.lit(0.0))) is None


def test_costs(spark):
    assert one(spark, scalars.cost(F.lit(""), F.lit(0))) == 0.0
    assert one(spark, scalars.cost(F.lit(None).cast("string"))) == 1.0


def test_statuses_outside_the_domain_are_errors(spark):
    with pytest.raises(Exception, match="unknown status"):
        one(spark, scalars.speech_status(F.lit("?"), F.lit(1)))
    with pytest.raises(Exception, match="not in the domain"):
        one(spark, scalars.domain_value(F.lit("smell"), ["audio", "visual"]))


def test_find_in_results_folds_both_sides(spark):
    from skerry.operators import filters

    rows = [(1, "Hauptstraße", "L01"), (2, "HAUPTSTRASSE", "L02"), (3, "İzmir", "L03"), (4, "ΟΔΥΣΣΕΥΣ", "L04"), (5, None, "L05")]
    d = spark.createDataFrame(rows, "keyframe_no int, title string, collection_id string")
    for query in ("Straße", "strasse", "STRASSE", "izmir", "İZM", "οδυσσευς", "l02", "5"):
        want = [r[0] for r in rows if any(query.casefold() in str(v or "").casefold() for v in (r[1], r[2], r[0]))]
        assert [r.keyframe_no for r in filters.refine(d, query).orderBy("keyframe_no").collect()] == want, query
    with pytest.raises(ValueError, match="Frame Index must be an integer"):
        filters.matches_within("x", "frame_idx", ["frame_idx"])


def test_low_information_counts_compared_characters(spark):
    texts = ["ﬁﬂ", "１２３４５ ６", "a_b", "one two three four five six seven", "", None, "ß" * 7, "́"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")

    def plain(t, chars, words):
        t = " ".join(re.findall(r"\w+", unicodedata.normalize("NFKC", t or "").casefold()))
        return len(t.replace(" ", "")) <= chars or len(t.split()) <= words

    for chars, words in ((3, 1), (6, 0), (12, 1), (20, 3)):
        got = {r.i: r.low for r in d.select("i", text.low_information(F.col("t"), chars, words).alias("low")).collect()}
        assert got == {i: plain(t, chars, words) for i, t in enumerate(texts)}


def test_keep_first_keeps_places(spark):
    d = spark.createDataFrame([(["b", "A", "a", "B", "c", "a"],), ([],), (["x"],)], "v array<string>")
    assert [r.k for r in d.select(text.keep_first(F.col("v"), F.lower).alias("k")).collect()] == [["b", "A", "c"], [], ["x"]]
