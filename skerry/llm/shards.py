"""Sharding by extendible hashing, in DataFrame functions only.

Keys hash to BITS bits. A bucket of depth d holds the documents that share d leading bits; a bucket over the byte limit
splits on the next bit, others never do. The directory has 2^g entries, g the largest depth: entry e, g leading bits,
names the bucket that holds e, and documents find their shard by an equality join on e. Documents over the limit by
themselves no split can help; each is a shard of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch, checked_broadcast

BITS = 60
LIMIT = 64 << 20
#: Bits counted beyond those that an even split needs; buckets over the limit at that depth are counted again, deeper.
SPARE_BITS = 3


def _hash() -> Column:
    """The first 60 bits of md5 over id and text, so rows with null or repeated ids spread as well."""
    body = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), body)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _prefix(hashed: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", hashed, F.lit(BITS) - depth)


def buckets(keys: DataFrame, limit: int = LIMIT) -> DataFrame:
    """keys(hash, bytes) -> depth, prefix, docs, bytes of the buckets that no longer split."""
    scratch = Scratch(keys.sparkSession, "shards")
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    top = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    done, depth, todo = None, 0, keys
    while True:
        # documents are summed at the deepest level first; the levels above come from those sums
        leaf = scratch.put(todo.groupBy(_prefix(F.col("hash"), top).alias("leaf")).agg(F.count(F.lit(1)).alias("docs"), F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high")))
        levels = leaf.select("*", F.explode(F.sequence(F.lit(depth), F.lit(top))).alias("depth"))
        levels = levels.groupBy("depth", F.expr(f"shiftright(leaf, {top} - depth)").alias("prefix")).agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        splits = (F.col("bytes") > limit) & (F.col("low") < F.col("high"))
        levels = levels.withColumn("splits", splits)
        parents = levels.filter("splits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        # at the first level of a later round every bucket comes from one that split
        live = levels.withColumn("parent", F.expr("shiftright(prefix, 1)"))
        held = live.filter(F.col("depth") == depth).drop("parent").unionByName(live.filter(F.col("depth") > depth).join(parents, ["depth", "parent"]).drop("parent"))
        held = scratch.put(held)
        out = held.filter("NOT splits").select("depth", "prefix", "docs", "bytes")
        done = out if done is None else done.unionByName(out)
        open_ = held.filter(F.col("splits") & (F.col("depth") == top)).select(F.col("prefix").alias("open"))
        if top >= BITS or open_.isEmpty():
            return done
        depth, last = top + 1, top
        top = min(BITS, top + 8)
        todo = todo.join(checked_broadcast(open_), _prefix(F.col("hash"), last) == F.col("open"), "left_semi")


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard, depth, shard_docs, shard_bytes, fits, hash for every row.

    shard is the bucket's bits ('' for the only one), or 'large-' and the document's hash where its text alone exceeds
    the limit (fits is false there, and where only equal rows share a bucket, which no bit can part). Null and empty
    texts have no bytes; null ids are null; other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "assign")
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    keys = scratch.put(docs.select("doc_id", size.alias("bytes"), _hash().alias("hash")))
    found = buckets(keys.filter(F.col("bytes") <= limit).select("hash", "bytes"), limit)
    deepest = found.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("g")).first()["g"]
    # a bucket of depth d fills 2^(g - d) entries of the directory
    entries = F.explode(F.sequence(F.expr(f"shiftleft(prefix, {deepest} - depth)"), F.expr(f"shiftleft(prefix + 1, {deepest} - depth) - 1")))
    directory = found.select(entries.alias("entry"), "depth", "prefix", F.col("docs").alias("shard_docs"), F.col("bytes").alias("shard_bytes"))
    placed = keys.filter(F.col("bytes") <= limit).withColumn("entry", _prefix(F.col("hash"), deepest)).join(checked_broadcast(directory), "entry")
    bits = F.when(F.col("depth") > 0, F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))).otherwise("")
    placed = placed.select("doc_id", F.col("bytes").alias("n_bytes"), bits.alias("shard"), F.col("depth").cast("long").alias("depth"), "shard_docs", "shard_bytes", "hash")
    large = keys.filter(F.col("bytes") > limit).select(
        "doc_id", F.col("bytes").alias("n_bytes"), F.concat(F.lit("large-"), F.col("hash").cast("string")).alias("shard"), F.lit(0).cast("long").alias("depth"),
        F.lit(1).cast("long").alias("shard_docs"), F.col("bytes").alias("shard_bytes"), "hash",
    )
    return placed.unionByName(large).withColumn("fits", F.col("shard_bytes") <= limit)


def write(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Writes docs as Parquet, one folder per shard, named b and its bits; rows of one shard meet in one task, whose size the limit bounds."""
    # the letter keeps readers from taking the bits for a number
    placed = assign(docs, limit).select(F.col("hash").alias("placed_hash"), F.concat(F.lit("b"), "shard").alias("shard")).distinct()
    joined = docs.join(placed, _hash() == F.col("placed_hash")).drop("placed_hash")
    joined.repartition("shard").write.partitionBy("shard").parquet(path)
