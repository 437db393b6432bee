"""Exact Jaccard join on sets of word shingles, with prefix filters under several global orders.

Two sets with Jaccard 0.8 or more share a token among the first n - ceil(0.8 n) + 1 tokens of each, under any global
order of tokens. Candidates must share one under each of three orders. Order 1 puts very common tokens last, the most
common ones at the very end, and goes by hash otherwise; orders 2 and 3 go by other hashes. Steps:

1. One pass hashes every text's shingles; equal sets (copies) become one representative, the smallest doc_id.
2. Stars, in rounds, on the first tokens of order 2: at each the smallest component has up to HUBS members drawn by hash
   as hubs, and those of other components that share half of these tokens with a hub are candidates. This merges groups of
   near copies, whatever their size, by a few pairs a member and round; it may miss links. Rounds end when they link few
   of their candidates.
3. Order 1, complete: of the prefixes only tokens that several representatives have are kept (counted before they are
   joined back, so a token of very many documents is summed early and its rows are split over tasks).
4. Tokens of several components give the candidates across components, by the sizes and the token's places. Links inside
   a component change nothing, so pairs inside one are never formed.
5. Candidates of 2 and 4 must share a token under all three orders, whose prefixes are computed again for documents with
   candidates only; whole texts verify what is left.
6. Components of the links; every document gets its component's smallest doc_id.

Any order gives the same result, so the list of common tokens may be bounded: it only keeps passages that many
documents share from meeting in the prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch, checked_broadcast
from skerry.llm.components import connected

WIDTH = 5
#: A token counts as common from so many documents on (counted where HEAVY_HELD tokens of a task have it HEAVY_LOCAL times or more); the most common ones are listed.
HEAVY, HEAVY_HELD, HEAVY_LOCAL, HEAVY_LISTED = 16, 2_000_000, 2, 100_000
#: First tokens of order 2 that stars look at; hubs of a component in a round; the share of a round's candidates that must be links for another round.
STAR_TOKENS, HUBS, STAR_YIELD = 8, 4, 0.1
#: Words hashed at a time, so a text of any length takes bounded memory.
CHUNK_WORDS = 200_000

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_UNDO = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        m = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _UNDO)):
            p = np.full(m, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x + np.uint64((seed * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(words: list[bytes], width: int) -> np.ndarray:
    """A hash of each run of width words: the polynomial hash of its bytes, mixed."""
    raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
    forth, back = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[raw] * forth[:-1], out=sums[1:])
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(raw)]))
    starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's 5-word shingles; of the whole sequence with fewer words; empty without words."""
    words = text.lower().split() if text else []  # bytes: A-Z only, and the six white space characters of ASCII
    if not words:
        return np.empty(0, dtype=np.uint64)
    width = min(WIDTH, len(words))
    parts = [_hashed(words[k : k + CHUNK_WORDS + width - 1], width) for k in range(0, len(words) - width + 1, CHUNK_WORDS)]
    return np.unique(np.concatenate(parts))


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def _batches(frames: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for at in range(0, frame.num_rows, rows):
            yield frame.slice(at, rows)


def common_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most common tokens, HEAVY_LISTED at most, from counts over all documents; and their places by rising count."""

    def often(sets: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate([*sets, np.empty(0, dtype=np.uint64)]), return_counts=True)
        some = n >= HEAVY_LOCAL
        return pa.record_batch({"token": found[some].view(np.int64), "n": n[some].astype(np.int64)})

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held = [], 0
        for frame in _batches(frames):
            for text in frame.column(0).to_pylist():
                sets.append(shingles(text))
                held += len(sets[-1])
                if held >= HEAVY_HELD:
                    yield often(sets)
                    sets, held = [], 0
        yield often(sets)

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(counted, "token long, n long")
    listed = counts.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY).orderBy(F.desc("n"), "token").limit(HEAVY_LISTED)
    found = listed.select("token").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)
    by_hash = np.argsort(found)
    return found[by_hash], (len(found) - by_hash).astype(np.int32)


def _lists(values: list[np.ndarray], kind: type, arrow: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.empty(0, kind)]).astype(kind), arrow))


class Orders:
    """The prefixes of a set under the three orders; common: the tokens that order 1 puts last, and their places."""

    def __init__(self, common: tuple[np.ndarray, np.ndarray]):
        self.hot, self.place = common

    def first(self, s: np.ndarray, k: int) -> np.ndarray:
        """The prefix under order 1, in order; of each token 48 bits, as equal tokens only have to stay equal."""
        if k and len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, s), len(self.hot) - 1)
            hot = self.hot[at] == s
            if hot.any():
                s = np.concatenate((s[~hot], s[hot][np.argsort(self.place[at[hot]])]))
        return (s[:k] & np.uint64((1 << 48) - 1)).view(np.int64)

    @staticmethod
    def hashed(s: np.ndarray, k: int, seed: int) -> np.ndarray:
        """The k first tokens under an order by another hash, in no order; of each token 32 bits."""
        least = np.argpartition(mixed(s, seed), k - 1)[:k] if k else np.empty(0, dtype=np.int64)
        return s[least].astype(np.uint32).view(np.int32)

    def of(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k = prefix_length(len(s)) if len(s) else 0
        return self.first(s, k), self.hashed(s, k, 3), self.hashed(s, k, 4)


def signatures(docs: DataFrame, sent) -> DataFrame:
    """doc_id, n, s1, s2 (hashes of the set), p1 (order-1 prefix), t2 (the STAR_TOKENS first tokens under order 2, as full hashes); sent: the common tokens."""

    def signed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = Orders(sent.value)
        for frame in _batches(frames):
            n, s1, s2, p1, t2 = [], [], [], [], []
            for text in frame.column(1).to_pylist():
                s = shingles(text)
                n.append(len(s))
                s1.append(int(np.add.reduce(mixed(s, 1)).astype(np.int64)) if len(s) else 0)
                s2.append(int(np.add.reduce(mixed(s, 2)).astype(np.int64)) if len(s) else 0)
                p1.append(orders.first(s, prefix_length(len(s)) if len(s) else 0))
                few = min(STAR_TOKENS, len(s))
                t2.append(s[np.argpartition(mixed(s, 3), few - 1)[:few]].view(np.int64) if few else np.empty(0, dtype=np.int64))
            yield pa.record_batch(
                {
                    "doc_id": frame.column(0), "n": pa.array(n, pa.int64()), "s1": pa.array(s1, pa.int64()), "s2": pa.array(s2, pa.int64()),
                    "p1": _lists(p1, np.int64, pa.int64()), "t2": _lists(t2, np.int64, pa.int64()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(signed, "doc_id long, n long, s1 long, s2 long, p1 array<long>, t2 array<long>")


def prefixes(texts: DataFrame, sent) -> DataFrame:
    """texts(id, text: binary) -> id, p1, p2, p3: the prefixes under the three orders."""

    def listed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = Orders(sent.value)
        for frame in _batches(frames):
            p1, p2, p3 = zip(*[orders.of(shingles(t)) for t in frame.column(1).to_pylist()])
            yield pa.record_batch({"id": frame.column(0), "p1": _lists(p1, np.int64, pa.int64()), "p2": _lists(p2, np.int32, pa.int32()), "p3": _lists(p3, np.int32, pa.int32())})

    return texts.select("id", "text").mapInArrow(listed, "id long, p1 array<long>, p2 array<int>, p3 array<int>")


def _linked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, left, right: texts) the a and b where 100 * intersection >= 80 * union."""
    before, of_before = None, None
    for frame in _batches(frames, 100):
        keep = []
        for a, b in zip(frame.column(2).to_pylist(), frame.column(3).to_pylist()):
            if a != before:
                before, of_before = a, shingles(a)
            other = shingles(b)
            both = len(np.intersect1d(of_before, other, assume_unique=True))
            keep.append(both > 0 and 100 * both >= 80 * (len(of_before) + len(other) - both))
        yield frame.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, docs: DataFrame, sent, scratch: Scratch) -> DataFrame:
    """The candidates (a, b) that share a token under every order and whose texts are linked. Only texts of candidates are moved, once per pair."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    # a document with several texts is linked if one of them is
    texts = scratch.put(texts.join(checked_broadcast(ids), "id", "left_semi"))
    found = scratch.put(prefixes(texts, sent))
    both = pairs.join(found.select(F.col("id").alias("a"), F.struct("p1", "p2", "p3").alias("of_a")), "a")
    both = both.join(found.select(F.col("id").alias("b"), F.struct("p1", "p2", "p3").alias("of_b")), "b")
    for p in ("p1", "p2", "p3"):
        both = both.filter(F.arrays_overlap(f"of_a.{p}", f"of_b.{p}"))
    both = scratch.put(both.select("a", "b").distinct())
    d = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    d = d.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    links = scratch.put(d.select("a", "b", "left", "right").mapInArrow(_linked, "a long, b long").distinct())
    scratch.drop(texts, found, both)
    return links


def _fits(n_a: str, n_b: str, most_a: str, most_b: str) -> Column:
    """What sizes and places allow: most is how many tokens of a set stand from the shared one on, so this many may be common at most."""
    a, b = F.col(n_a), F.col(n_b)
    return (5 * F.least(a, b) >= 4 * F.greatest(a, b)) & (9 * F.least(most_a, most_b) >= 4 * (a + b))


def _live(tokens: DataFrame, roots: DataFrame | None, scratch: Scratch) -> DataFrame:
    """tokens(token, id, ..) with root and lo, of the tokens that several components have; lo is the smallest of them."""
    rows = tokens.withColumn("root", F.col("id"))
    if roots is not None:
        rows = tokens.join(checked_broadcast(roots), "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token", "lo")
    return scratch.put(rows.join(several, "token"))


def _stars(live: DataFrame, number: int) -> DataFrame:
    """a, b: representatives with the hubs of the smallest component at their tokens, where they share half of the tokens in that way."""
    middle = live.filter("root = lo")
    drawn = [F.min(F.struct(F.xxhash64("id", F.lit(HUBS * number + k)), "id"))["id"] for k in range(HUBS)]
    ids = middle.groupBy("root").agg(F.array_distinct(F.array(*drawn)).alias("ids")).select(F.explode("ids").alias("id"))
    hubs = middle.join(checked_broadcast(ids), "id", "left_semi").select("token", F.col("id").alias("a"), F.col("n").alias("n_a"))
    rows = live.filter("root <> lo").select("token", F.col("id").alias("b"), F.col("n").alias("n_b"))
    pairs = rows.join(hubs, "token").filter(5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b"))
    pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("tokens"), F.first("n_b").alias("n"))
    return pairs.filter(2 * F.col("tokens") >= F.least("n", F.lit(STAR_TOKENS))).select("a", "b")


def _star_roots(tokens: DataFrame, docs: DataFrame, sent, scratch: Scratch) -> DataFrame:
    """id, root of the components that stars merge; tokens(token, id, n)."""
    roots, number, live = None, 0, _live(tokens, None, scratch)
    while True:
        pairs = scratch.put(_stars(live, number))
        tried = pairs.count()
        links = verified(pairs, docs, sent, scratch)
        found = links.count()
        known = links if roots is None else links.unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b")))
        roots = connected(known, scratch) if found or roots is None else roots
        number += 1
        scratch.drop(pairs)
        if found <= STAR_YIELD * tried:
            return roots
        before, live = live, _live(live.select("token", "id", "n"), roots, scratch)
        scratch.drop(before)


def _across(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """a, b: all pairs of representatives of different components that share a token and whose sizes and places fit; rows as _live gives them."""
    # which components meet at a token, then their members: no pair inside a component is made
    parts = scratch.put(rows.groupBy("token", "root").agg(F.min("n").alias("n"), F.max("n").alias("n_max"), F.max("most").alias("most")))
    left = parts.select("token", *[F.col(c).alias(f"{c}_a") for c in ("root", "n", "n_max", "most")])
    right = parts.select("token", *[F.col(c).alias(f"{c}_b") for c in ("root", "n", "n_max", "most")])
    fit = (5 * F.col("n_max_b") >= 4 * F.col("n_a")) & (5 * F.col("n_max_a") >= 4 * F.col("n_b")) & (9 * F.least("most_a", "most_b") >= 4 * (F.col("n_a") + F.col("n_b")))
    meet = left.join(right, "token").filter((F.col("root_a") < F.col("root_b")) & fit).select("token", "root_a", "root_b")
    of_a = rows.select("token", F.col("root").alias("root_a"), F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("most").alias("most_a"))
    of_b = rows.select("token", F.col("root").alias("root_b"), F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("most").alias("most_b"))
    pairs = meet.join(of_a, ["token", "root_a"]).join(of_b, ["token", "root_b"]).filter(_fits("n_a", "n_b", "most_a", "most_b"))
    pairs = scratch.put(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    scratch.drop(parts)
    return pairs


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) for every row of docs(doc_id, text).

    Null and empty texts, and texts without words, have no shingles and no links. Rows with a null doc_id take part in
    no link; their component is that of an equal text with an id, else null. Rows with one doc_id are one document: equal
    ones give equal rows; with different texts all of them hold its links. Other columns are ignored, whatever their
    names; an empty table gives no rows. doc_id must be a whole number.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    sent = docs.sparkSession.sparkContext.broadcast(common_tokens(docs))
    signed = scratch.put(signatures(docs, sent))
    sets = signed.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    sets = scratch.put(sets.filter(F.col("id").isNotNull()))
    # representatives: one row of each set; only sets with copies need a look-up
    copied = checked_broadcast(sets.filter("copies > 1").select("n", "s1", "s2", "id"))
    reps = signed.filter("n > 0 AND doc_id IS NOT NULL").join(copied, ["n", "s1", "s2"], "left").filter("id IS NULL OR id = doc_id")
    reps = reps.select(F.col("doc_id").alias("id"), F.col("n").cast("int").alias("n"), "p1", "t2")
    roots = _star_roots(reps.select(F.explode("t2").alias("token"), "id", "n"), docs, sent, scratch)

    tokens = reps.select("id", "n", F.posexplode("p1").alias("place", "token")).select("token", "id", "n", (F.col("n") - F.col("place")).alias("most"))
    several = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("token")
    shared = scratch.put(tokens.join(several, "token"))
    slim = scratch.put(signed.select("doc_id", "n", "s1", "s2"))
    scratch.drop(signed)
    live = _live(shared, roots, scratch)
    scratch.drop(shared)
    links = verified(_across(live, scratch), docs, sent, scratch)
    # stars stand for the links that they merged
    links = links.unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))).unionByName(_same_document(slim, sets))
    roots = connected(links, scratch)

    # sets with copies or links; all other documents are their own component
    groups = sets.join(roots, "id", "left").filter("copies > 1 OR root IS NOT NULL")
    groups = scratch.put(groups.select("n", "s1", "s2", F.coalesce("root", "id").alias("component_id")))
    out = slim.join(checked_broadcast(groups), ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _same_document(slim: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: representatives of the sets of one doc_id that has several texts."""
    rows = slim.filter("n > 0 AND doc_id IS NOT NULL")
    several = rows.groupBy("doc_id").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).filter("lo < hi").select("doc_id")
    ids = rows.join(several, "doc_id").join(sets.select("n", "s1", "s2", "id"), ["n", "s1", "s2"]).select("doc_id", "id").distinct()
    return ids.join(ids.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").filter("a <> id").select("a", F.col("id").alias("b"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, the one with the smallest doc_id; rows with a null doc_id and equal rows stay."""
    from skerry.llm.common import without_ids

    return without_ids(docs, components(docs).filter(F.col("doc_id") > F.col("component_id")))
