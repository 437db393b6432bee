"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask names the places of a window that count; the words at the other places may differ. All windows of the benchmark
and of the documents are hashed under each mask and joined by hash. Around each hit the item is laid on the document at
that offset: the pair counts if some WINDOW consecutive words (the whole item, where it is shorter) agree in 80 % of
their places. The masks of an item follow from its length, and are such that every pattern of differing words that this
accepts leaves one of them whole at some place: nothing that counts goes without a hit. Items of under 5 words may differ
nowhere and are one hash. Documents are hashed only under masks that some item has. Items without words are not searched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch, checked_broadcast, without_rows

#: Shortest item, and its masks up to the next length. 1: the word counts, 0: it may differ.
MASKS = {
    13: ("1111011", "110010111", "11000010111"),
    5: ("1111", "10111", "11011", "11101"),
    4: ("1111",),
    3: ("111",),
    2: ("11",),
    1: ("1",),
}
WINDOW = 20
AGREE_PERCENT = 80
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Lower-case words: runs of letters and digits; all beyond ASCII counts as letters."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS), lambda w: w != "")


def masks_of(n: int) -> tuple[str, ...]:
    """The masks of an item of n words."""
    return next(m for least, m in MASKS.items() if n >= least)


def seeds(rows: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """rows(.., w: word hashes, n: their count) -> .., mask, place, seed for every window under every mask."""
    keep = [c for c in rows.columns if c not in ("w", "n")]
    least = min(map(len, masks))
    starts = F.sequence(F.lit(0), F.col("n") - least)

    def hashed(mask: str) -> Column:
        at = [k for k, c in enumerate(mask) if c == "1"]
        return F.transform(starts, lambda i: F.when(i + len(mask) <= F.col("n"), F.xxhash64(*[F.get("w", i + k) for k in at])))

    # short rows get no array, and the outer form of explode keeps Spark from evaluating the hashes in an inferred filter
    fit = F.col("n") >= least
    windows = (F.col("n") - least + 1).alias("windows")
    each = rows.select(*keep, windows, F.when(fit, F.concat(*map(hashed, masks))).alias("all"))
    each = each.select(*keep, "windows", F.posexplode_outer("all").alias("k", "seed")).filter(F.col("seed").isNotNull())
    name = F.get(F.array(*map(F.lit, masks)), F.expr("k div windows").cast("int"))
    return each.select(*keep, name.alias("mask"), (F.col("k") % F.col("windows")).alias("place"), "seed")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row_hash, item_id, agreeing (words of the item that agree), best (most agreeing in a window), window.

    One row per row of docs (told apart by row_hash, a hash of the text) and item that count as overlapping; the offset
    with the most agreeing words is reported. Null and empty texts overlap nothing; items with a null text or without
    words are not searched; rows with null ids are searched like others and carry the null; equal rows give one result; other
    columns are ignored. Either table may be empty.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    row_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))

    def hashes(d: DataFrame, *keep: Column) -> DataFrame:
        d = d.select(*keep, words("text").alias("words"))
        d = d.select(*[c for c in d.columns if c != "words"], F.transform("words", lambda w: F.xxhash64(w)).alias("w"))
        return d.withColumn("n", F.size("w"))

    # an item is known by its own text, so ids that are null or repeat do no harm
    items = scratch.put(benchmark.select("item_id", words("text").alias("item")).filter(F.size("item") > 0).withColumn("item_hash", F.xxhash64("item")))
    of_items = items.select("item_hash", F.transform("item", lambda w: F.xxhash64(w)).alias("w")).distinct().withColumn("n", F.size("w"))
    # lengths from WINDOW on have the same masks
    lengths = [r[0] for r in of_items.select(F.least("n", F.lit(WINDOW))).distinct().collect()]
    families = {masks_of(n) for n in lengths} or {MASKS[13]}
    have = F.coalesce(*[F.when(F.col("n") >= least, F.lit("|".join(masks))) for least, masks in MASKS.items()])
    each = [seeds(of_items.filter(have == "|".join(masks)), masks) for masks in sorted(families)]
    test = scratch.put(reduce(DataFrame.unionByName, each).withColumnRenamed("place", "item_place").distinct())
    train = seeds(hashes(docs, F.col("doc_id"), row_hash.alias("row_hash")), tuple(sorted({m for masks in families for m in masks})))
    hits = train.join(checked_broadcast(test), ["seed", "mask"])
    hits = scratch.put(hits.select("doc_id", "row_hash", "item_hash", (F.col("place") - F.col("item_place")).alias("offset")).distinct())
    of_docs = docs.select("doc_id", row_hash.alias("row_hash"), "text")
    rows = checked_broadcast(hits.select(F.col("doc_id").alias("hit_id"), F.col("row_hash").alias("hit_hash")).distinct())
    hit_docs = of_docs.join(rows, of_docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.col("row_hash") == F.col("hit_hash")), "left_semi")
    hit_docs = scratch.put(hit_docs.select("doc_id", "row_hash", words("text").alias("doc")).dropDuplicates(["doc_id", "row_hash"]))
    laid = hits.withColumnsRenamed({"doc_id": "hit_id", "row_hash": "hit_hash"})
    laid = hit_docs.join(laid, hit_docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.col("row_hash") == F.col("hit_hash")))
    laid = laid.join(checked_broadcast(items), "item_hash")
    # only the stretch of the document under the item
    laid = laid.select("doc_id", "row_hash", "item_id", F.expr("transform(item, (x, p) -> if(coalesce(get(doc, p + offset) = x, false), 1, 0))").alias("same"))
    laid = scratch.put(laid).withColumn("window", F.least(F.size("same"), F.lit(WINDOW)))
    best = F.expr("array_max(transform(sequence(0, size(same) - window), s -> aggregate(slice(same, s + 1, window), 0, (a, b) -> a + b)))")
    laid = laid.select("doc_id", "row_hash", "item_id", "window", F.expr("aggregate(same, 0, (a, b) -> a + b)").alias("agreeing"), best.alias("best"))
    laid = laid.filter(100 * F.col("best") >= AGREE_PERCENT * F.col("window"))
    return laid.groupBy("doc_id", "row_hash", "item_id", "window").agg(F.max("agreeing").cast("long").alias("agreeing"), F.max("best").cast("long").alias("best"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlapping documents and items: doc_id, item_id, agreeing, best, window, one row per pair of ids."""
    found = overlaps(docs, benchmark)
    return found.groupBy("doc_id", "item_id").agg(F.max("agreeing").alias("agreeing"), F.max("best").alias("best"), F.max("window").cast("long").alias("window"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that overlap an item, columns as they were."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("row_hash").alias("bad_hash")).distinct()
    return without_rows(docs, bad)
