"""Line dedup with a log-template tree, in DataFrame functions only.

A line's path in the tree has fixed depth: its token count, then its LEAD leading tokens; below that comes a template.
Tokens with a digit are variable fields wherever they stand. Besides those a template has one more variable field: one
of FIELDS equal stretches of what follows the leading tokens. So two lines share a template if they have the same token
count and leading tokens and all stretches but one at most are equal, which is at least 80 % of the line; each line has
FIELDS templates, and equal templates meet by a hash key in one aggregation. No pairs of lines are formed.

A template is recurring if lines of several documents have it. Its lines stay in the document with the smallest
doc_id among them and are dropped from all others. A line of under MIN_TOKENS tokens has one template without an open
stretch: its count and all its tokens (variable fields too, unless all of its tokens have digits: such a line is its own
template). Lines without tokens have no template and stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch

LEAD = 3
FIELDS = 5
MIN_TOKENS = 5
#: Dropped lines whose places are sent to every executor at most; beyond it documents and drops are joined by a shuffle.
BROADCAST_LINES = 1_000_000


def _row_hash() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def parsed(docs: DataFrame) -> DataFrame:
    """Lines with a template: doc_id, row_hash, line_no, n, lead and the hashes s0.. of the stretches."""
    # tokens come before explode, so that the filter on their number doesn't split every line again
    tokens = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda x: F.struct(x.rlike("[0-9]").alias("varies"), F.filter(F.split(x, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("t")),
    )
    rows = docs.select("doc_id", _row_hash().alias("row_hash"), F.posexplode_outer(tokens).alias("line_no", "line"))
    rows = rows.filter(F.size("line.t") > 0).select("doc_id", "row_hash", "line_no", "line.varies", "line.t")
    # in a short line of numbers alone nothing else would be left to tell lines apart
    numbers = (F.size("t") < MIN_TOKENS) & F.forall("t", lambda w: w.rlike("[0-9]"))
    masked = F.when(F.col("varies") & ~numbers, F.transform("t", lambda w: F.when(w.rlike("[0-9]"), "<*>").otherwise(w))).otherwise(F.col("t"))
    rows = rows.select("doc_id", "row_hash", "line_no", F.size("t").alias("n"), masked.alias("t"))

    def stretch(k: int) -> Column:
        rest = F.greatest(F.col("n") - LEAD, F.lit(0))
        start, end = F.floor(rest * k / FIELDS), F.floor(rest * (k + 1) / FIELDS)
        return F.xxhash64(F.slice("t", (start + LEAD + 1).cast("int"), (end - start).cast("int")))

    lead = F.xxhash64(F.slice("t", 1, LEAD))
    return rows.select("doc_id", "row_hash", "line_no", "n", lead.alias("lead"), *[stretch(k).alias(f"s{k}") for k in range(FIELDS)])


def _line_id() -> list[Column]:
    """id1, id2: 128 bits that stand for a line (n, lead, s0..) from here on, so that shuffles carry two numbers."""
    line = ["n", "lead", *[f"s{k}" for k in range(FIELDS)]]
    return [F.xxhash64(*line).alias("id1"), F.xxhash64(F.lit(2), *reversed(line)).alias("id2")]


def templates(lines: DataFrame) -> DataFrame:
    """id1, id2 of each distinct line of a recurring template with home, the smallest doc_id among its templates' documents."""
    line = ["n", "lead", *[f"s{k}" for k in range(FIELDS)]]
    distinct = lines.groupBy(line).agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last"))
    # -1: no stretch is open
    open_field = F.explode(F.when(F.col("n") >= MIN_TOKENS, F.sequence(F.lit(0), F.lit(FIELDS - 1))).otherwise(F.array(F.lit(-1)))).alias("field")
    # the template with stretch k open: the hash of the others, twice to have 128 bits
    with_key = distinct.select(*line, "home", "last", open_field)
    rest = [F.when(F.col("field") == k, F.lit(0)).otherwise(F.col(f"s{k}")) for k in range(FIELDS)]
    with_key = with_key.select(
        *_line_id(), "home", "last", F.xxhash64("n", "lead", "field", *rest).alias("key"), F.xxhash64(F.lit(1), *rest, "field", "lead", "n").alias("key2")
    )
    recurring = with_key.groupBy("key", "key2").agg(F.min("home").alias("home"), F.max("last").alias("last")).filter("last > home")
    found = with_key.select("id1", "id2", "key", "key2").join(recurring.select("key", "key2", "home"), ["key", "key2"])
    return found.groupBy("id1", "id2").agg(F.min("home").alias("home"))


def dropped(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, lines: for each row that loses lines the sorted places of those, from 0."""
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.put(parsed(docs))
    homes = scratch.put(templates(lines))
    lost = lines.select("doc_id", "row_hash", "line_no", *_line_id()).join(homes, ["id1", "id2"]).filter(F.col("doc_id") > F.col("home"))
    # equal rows lose equal lines, so each place counts once
    return scratch.put(lost.groupBy("doc_id", "row_hash").agg(F.array_sort(F.collect_set("line_no")).alias("lines")))


def without_recurring(docs: DataFrame) -> DataFrame:
    """docs with two columns more: kept_text, and lost_lines (sorted places).

    Null and empty texts are one empty line, which stays; kept_text is then empty. Rows with a null doc_id lose
    nothing and count nowhere. Equal rows lose the same lines. Lines that recur only within a document stay. Other
    columns may have any name but these two.
    """
    lost = dropped(docs).select(F.col("doc_id").alias("lost_id"), F.col("row_hash").alias("lost_hash"), F.col("lines").alias("lost_lines"))
    total = lost.agg(F.coalesce(F.sum(F.size("lost_lines")), F.lit(0)).alias("n")).first()["n"]
    side = F.broadcast(lost) if total <= BROADCAST_LINES else lost
    mine = docs.withColumn("kept_text", _row_hash())
    joined = mine.join(side, (mine["doc_id"] == F.col("lost_id")) & (mine["kept_text"] == F.col("lost_hash")), "left").drop("lost_id", "lost_hash")
    text = F.coalesce(F.col("text"), F.lit(""))
    # both lists are sorted: a map from place to nothing makes each look-up one step
    lost_at = F.map_from_arrays("lost_lines", F.transform("lost_lines", lambda x: F.lit(True)))
    rest = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.when(~F.map_contains_key(F.col("lost_at"), i), x)), lambda x: x.isNotNull())
    out = joined.withColumn("lost_at", lost_at).withColumn("kept_text", F.when(F.col("lost_lines").isNull(), text).otherwise(F.array_join(rest, "\n")))
    return out.drop("lost_at").withColumn("lost_lines", F.coalesce("lost_lines", F.array().cast("array<int>")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_chars and kept_sha256 of the text that is left."""
    d = without_recurring(docs.select("doc_id", "text"))
    return d.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.size("lost_lines").cast("long").alias("n_dropped"),
        F.char_length("kept_text").cast("long").alias("kept_chars"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def rewrite(docs: DataFrame) -> DataFrame:
    """docs with the text that is left (n_chars follows it); a document that lost lines and has no word left goes."""
    # the columns travel in a struct, so that their names meet no others
    d = without_recurring(docs.select("doc_id", "text", F.struct("*").alias("whole")))
    own = F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    d = d.filter((F.size("lost_lines") == 0) | own)
    changed = {"text": F.when(F.size("lost_lines") > 0, F.col("kept_text")).otherwise(F.col("text")).alias("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("lost_lines") > 0, F.char_length("kept_text")).otherwise(F.col("whole.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return d.select(*[changed.get(c, F.col(f"whole.`{c}`")) for c in docs.columns])
