"""Quality rules whose cut-offs come from quantile sketches of each language and source.

Each document gets counts (DataFrame functions only). percentile_approx keeps a Greenwald-Khanna sketch per group,
merged from the partial sketches of all partitions, so a hot source is summed before the shuffle. Metrics are logarithms
of shares (one count added, so that texts without any spread by their length). A metric fails where it lies more than
REACH times the group's quartile distance beyond its upper quartile (word length also below the lower one): junk moves
neither quartile unless it is a quarter of the group, and no fixed share decides.

A group's quartiles are drawn towards its language's by PRIOR documents, a language's towards those of all documents, so
a few documents make no bound of their own. And a group's bound ends one quartile distance beyond its language's: a source
that is mostly junk can't lift its own bound at will. Counts are held against the bound less twice their standard
deviation, so a few symbols in a short text don't reject it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch, checked_broadcast, without_rows

#: Rank error of the sketches is 1 / ACCURACY; groups below ACCURACY documents get exact quantiles.
ACCURACY = 10_000
#: Documents by which a group's quartiles are drawn towards those of the level above.
PRIOR = 20
#: Quartile distances that a metric may lie beyond the quartile; metrics that rejected junk and texts of their own kind share less get less.
REACH = {"symbols": 2.0, "lines": 3.0, "repeats": 3.0, "length": 6.0}
#: A quartile distance counts as this factor at least (as a logarithm), so groups of texts of one size aren't judged by their noise.
LEAST = {"symbols": math.log(3), "lines": math.log(3), "repeats": math.log(3), "length": 0.04}
WORD_BREAK = r"[\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What each share counts, and of how many.
SHARES = {"symbols": ("n_symbols", "n_words"), "lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words")}


def _counts(docs: DataFrame, extra: list[Column]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "lang", "source", text.alias("text"), *extra)
    names = [c for c in d.columns if c not in ("doc_id", "lang", "source", "text")]
    keep = ["doc_id", "lang", "source", *names]
    d = d.select(
        *keep,
        F.filter(F.split("text", WORD_BREAK), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    d = d.select(
        *keep,
        "words",
        "n_symbols",
        F.size("words").alias("n"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(words, 0L, (s, w) -> s + char_length(w))").alias("word_chars"),
    )
    # windows of three words by hash, then by place: equal ones stand side by side
    windows = F.expr("sort_array(transform(sequence(0, n - 3), i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i)))")
    d = d.select(*keep, "n", "n_lines", "word_chars", "n_symbols", "n_dup_lines", F.when(F.col("n") >= 3, windows).alias("w"))
    found = F.expr(
        "sort_array(filter(transform(sequence(0, n - 3), k -> if(w[k].h = get(w, k - 1).h OR w[k].h = get(w, k + 1).h, w[k].i, NULL)), x -> x IS NOT NULL))"
    )
    d = d.select(*keep, "n", "n_lines", "word_chars", "n_symbols", "n_dup_lines", F.when(F.col("n") >= 3, found).alias("f"))
    covered = F.expr("aggregate(sequence(0, size(f) - 1), 0L, (s, k) -> s + least(3, coalesce(get(f, k + 1) - f[k], 3)))")
    return d.select(
        *keep,
        F.col("n").cast("long").alias("n_words"),
        "n_lines",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.size("f") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def counts(docs: DataFrame) -> DataFrame:
    """Per document: the counts, whether the base rules fail it, and a hash of the text that tells rows apart.

    To be written before it is used: where a query needs few of the columns, Spark may merge the steps and split a text
    again for each of its words.
    """
    d = _counts(docs, [F.xxhash64("text").alias("text_hash")])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def _metrics() -> dict[str, Column]:
    shares = {k: F.log((F.col(x) + 1) / (F.col(n) + 1)) for k, (x, n) in SHARES.items()}
    return shares | {"length": F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)))}


def thresholds(found: DataFrame) -> DataFrame:
    """Bounds per language and source, from documents that the base rules pass: max_* (shares; code points a word) and min_length.

    found: counts as written to a table. The number of rows follows the number of sources.
    """
    d = found.filter(~F.col("base_failed")).select("lang", "source", *[c.alias(k) for k, c in _metrics().items()])
    sketched = [F.percentile_approx(k, [0.25, 0.75], ACCURACY).alias(k) for k in REACH]
    groups = d.rollup("lang", "source").agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).cast("double").alias("size"), *sketched)
    groups = Scratch(found.sparkSession, "thresholds").put(groups)

    def drawn(own: str, above: str, k: str) -> Column:
        """The quartiles of a level, drawn towards those above."""
        at = [(F.col(own)[k][i] * F.col(f"{own}.size") + F.col(above)[k][i] * PRIOR) / (F.col(f"{own}.size") + PRIOR) for i in (0, 1)]
        return F.array(*at).alias(k)

    def spread(at: str, k: str) -> Column:
        return F.greatest(F.col(at)[k][1] - F.col(at)[k][0], F.lit(LEAST[k]))

    everything = groups.filter("level = 3").select(F.struct(*REACH).alias("all"))
    languages = groups.filter("level = 1").select(F.col("lang").alias("lang_1"), F.struct("size", *REACH).alias("of"))
    languages = languages.join(F.broadcast(everything)).select("lang_1", F.struct(*[drawn("of", "all", k) for k in REACH]).alias("language"))
    of_language = F.col("lang").eqNullSafe(F.col("lang_1"))
    own = groups.filter("level = 0").select("lang", "source", F.struct("size", *REACH).alias("of")).join(checked_broadcast(languages), of_language)
    own = own.select("lang", "source", "language", F.struct(*[drawn("of", "language", k) for k in REACH]).alias("group"))
    most = [F.exp(F.least(F.col("group")[k][1] + r * spread("group", k), F.col("language")[k][1] + (r + 1) * spread("language", k))).alias(f"max_{k}") for k, r in REACH.items()]
    least = F.exp(F.col("group")["length"][0] - REACH["length"] * spread("group", "length")).alias("min_length")
    return own.select("lang", "source", *most, least)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and text_hash for every row of docs(doc_id, text, lang, source).

    Null and empty texts have no words and fail. Null languages and sources form groups of their own; a null doc_id
    stays null; repeated rows are judged alike, each for itself; other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    found = scratch.put(counts(docs))
    bounds = scratch.put(thresholds(found)).withColumnsRenamed({"lang": "lang_0", "source": "source_0"})
    same = F.col("lang").eqNullSafe(F.col("lang_0")) & F.col("source").eqNullSafe(F.col("source_0"))
    # a group of documents that all fail the base rules has no bounds
    d = found.join(checked_broadcast(bounds), same, "left")
    over = F.lit(False)
    for k, (x, n) in SHARES.items():
        over = over | ((F.col(x) - 2 * F.sqrt(x)) / F.greatest(F.col(n), F.lit(1)) > F.col(f"max_{k}"))
    length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    over = over | (length > F.col("max_length")) | (length < F.col("min_length"))
    return d.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~F.coalesce(over, F.lit(False))).alias("kept"), "text_hash")


def keep_good(docs: DataFrame) -> DataFrame:
    """docs without the rows that the rules reject, columns as they were."""
    bad = judge(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return without_rows(docs, bad)
