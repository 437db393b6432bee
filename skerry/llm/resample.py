"""Target-distribution importance resampling over hashed n-grams, in DataFrame functions.

Words are posexploded into a position table; lead() over each row's positions concatenates the following words, so one
row holds the features of orders 1 to 3 that begin there. Features are hashed to buckets; bucket counts of the documents
and of the target give each bucket's gain, and the gains are joined back and summed per document. The texts are shuffled
once, by a row number, before they are exploded: the window needs no shuffle of words, and no row's words leave its task.
The gains are BUCKETS rows, whatever the input, so they are broadcast. Ranks come from a range partitioning and counts of
its parts: no task sees all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.llm.common import Scratch, checked_broadcast

BUCKETS = 10_000
ORDERS = 3
#: Added to every count of a bucket.
PRIOR = 1
SEED = 42
LEAST_WORDS = 20
DRAWN_PERCENT = 5
#: Words are what stands between these; capital letters are lower-cased word by word.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(word: Column) -> Column:
    """A-Z to lower case and nothing else; translate is needed only beyond ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def positions(rows: DataFrame) -> DataFrame:
    """rows(id, row, text) -> id, row, pos, word. A text's first and last word may be empty; every row has one word at least."""
    dealt = rows.repartition("row")
    each = dealt.select("id", "row", F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), SEPARATORS)).alias("pos", "word"))
    return each.withColumn("word", _lowered(F.col("word")))


def buckets(rows: DataFrame) -> DataFrame:
    """rows(id, row, text) -> id, row, b1, b2, b3: the buckets of the features that begin at each word, null where none does."""
    at = Window.partitionBy("row").orderBy("pos")
    following = [F.lead("word", k).over(at).alias(f"w{k}") for k in range(1, ORDERS)]
    words = positions(rows).select("id", "row", F.col("word").alias("w0"), *following)

    def bucket(n: int) -> Column:
        parts = [F.col(f"w{k}") for k in range(n)]
        whole = reduce(lambda a, b: a & b, [p != "" for p in parts])
        return F.when(whole, (F.crc32(F.concat_ws(" ", *parts).cast("binary")) % BUCKETS).cast("short")).alias(f"b{n}")

    return words.select("id", "row", *[bucket(n) for n in range(1, ORDERS + 1)])


def totals(found: DataFrame, name: str) -> DataFrame:
    """bucket, and in name its number of features; summed in every task before the shuffle."""
    one = [found.select(F.col(f"b{n}").alias("bucket")) for n in range(1, ORDERS + 1)]
    return reduce(DataFrame.unionAll, one).filter("bucket IS NOT NULL").groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def gains(s: DataFrame, t: DataFrame) -> DataFrame:
    """bucket, gain for every bucket: floor of 1000 times the logarithm of target share over source share, counts raised by PRIOR."""
    every = s.sparkSession.range(BUCKETS).select(F.col("id").cast("short").alias("bucket"))
    d = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    whole = d.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    d = d.join(F.broadcast(whole))  # one row
    share = [(F.col(c).cast("double") + PRIOR, F.col(f"all_{c}").cast("double") + PRIOR * BUCKETS) for c in ("s", "t")]
    (s_1, s_all), (t_1, t_all) = share
    return d.select("bucket", F.floor(1000 * F.log((t_1 * s_all) / (s_1 * t_all))).alias("gain"))


def weights(docs: DataFrame, target: DataFrame, scratch: Scratch) -> DataFrame:
    """id, row, n_words, n_features, weight: one row per row of docs."""

    def table(d: DataFrame, key: Column) -> DataFrame:
        return scratch.put(buckets(d.select(key.alias("id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))))

    found = table(docs, F.col("doc_id"))
    gain = scratch.put(gains(totals(found, "s"), totals(table(target, F.lit(None).cast("long")), "t")))
    d = found
    for n in range(1, ORDERS + 1):
        d = d.join(F.broadcast(gain.select(F.col("bucket").alias(f"b{n}"), F.col("gain").alias(f"g{n}"))), f"b{n}", "left")
    orders = range(1, ORDERS + 1)
    features = sum(F.count(f"b{n}") for n in orders)
    weight = sum(F.coalesce(F.sum(f"g{n}"), F.lit(0)) for n in orders)
    return d.groupBy("id", "row").agg(F.count("b1").alias("n_words"), features.alias("n_features"), weight.alias("weight"))


def numbered(rows: DataFrame, order: list[Column], name: str, scratch: Scratch) -> DataFrame:
    """rows and name: 1, 2, 3.. in the order. Parts are ranges of it; a row's number is its place in its part after those before."""
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place_", F.monotonically_increasing_id())
    parts = scratch.put(parts)  # the number's upper 31 bits are the part, the lower 33 the place in it
    part = F.shiftright("place_", 33)
    sizes = parts.groupBy(part.alias("part_")).agg(F.count(F.lit(1)).alias("size_"))
    before = F.sum("size_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))  # a row per part
    offsets = sizes.select("part_", F.coalesce(before, F.lit(0)).alias("before_"))
    d = parts.join(checked_broadcast(offsets), part == F.col("part_"))
    return d.withColumn(name, F.col("before_") + F.col("place_").bitwiseAND((1 << 33) - 1) + 1).drop("place_", "part_", "before_")


def draw(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) and n_words for every row of docs(doc_id, text).

    target(text): what the drawn documents should be like. Null and empty texts have no features, weight 0 and are never
    drawn. A null doc_id is hashed as an empty one and comes after others of its score; repeated rows are weighed and
    drawn each for itself, equal ones in either order. Texts without words, or an empty target, leave the prior alone.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    d = weights(docs, target, scratch)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(name, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    d = scratch.put(d.select("id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= LEAST_WORDS).alias("fit")))
    drawn = percent * d.filter("fit").count() // 100
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")]
    d = numbered(d, order, "rank", scratch)
    rank = F.when(F.col("fit") & (F.col("rank") <= drawn), F.col("rank"))
    return d.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", rank.alias("rank"), "n_words")


def sampled(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """The rows of docs whose doc_id is drawn, columns as they were; rows with a null doc_id are left out."""
    ids = draw(docs, target, percent, seed).filter("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(checked_broadcast(ids), "doc_id", "left_semi").select(docs.columns)
