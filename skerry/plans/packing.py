"""Batches and chunks, review loops over boundary labels, stage reuse, configuration layers."""

from __future__ import annotations

import bisect
import dataclasses
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skerry.operators import sequences
from skerry.operators.folds import folded

#: Videos of a manifest at most.
MANIFEST_ROWS = 1_000_000


def least_loaded(videos: DataFrame, batches: int) -> DataFrame:
    """Longest-processing-time batches: by falling cost then id, each to the least loaded batch (the lower number on ties).

    videos(video_id, cost) is a batch manifest, one row per video file and MANIFEST_ROWS at most; more is an error. The rule
    is sequential: the manifest is sorted by Spark and streams through a heap of the batches' loads.
    """
    if videos.limit(MANIFEST_ROWS + 1).count() > MANIFEST_ROWS:
        raise ValueError(f"a manifest has {MANIFEST_ROWS} videos at most")

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heap = [(0.0, k) for k in range(batches)]
        for pdf in frames:
            out = []
            for c in pdf["cost"]:
                load, k = heap[0]
                out.append(k)
                heapq.heapreplace(heap, (load + float(c), k))
            yield pdf.assign(batch=out)

    d = videos.select("video_id", F.col("cost").cast("double").alias("cost")).coalesce(1).sortWithinPartitions(F.desc("cost"), "video_id")
    kind = videos.schema["video_id"].dataType.simpleString()
    return d.mapInPandas(assign, f"video_id {kind}, cost double, batch int")


#: Fixed values of a chunk policy: settings, and whether they must be above zero (else not below it).
POLICY = {
    "max_chunk_videos": True, "low_disk_max_chunk_videos": True, "medium_max_chunk_videos": True, "ram_low_max_chunk_videos": True, "ram_medium_max_chunk_videos": True,
    "min_free_disk_gb": False, "medium_free_disk_gb": False, "minimum_available_gb": False, "medium_available_gb": False,
}


def checked_policy(policy: Mapping[str, float]) -> Mapping[str, float]:
    """The policy, or an error that names what is wrong with it."""
    for name, positive in POLICY.items():
        if policy[name] < (1 if positive else 0):
            raise ValueError(f"{name} must be {'a whole number above' if positive else 'no less than'} zero")
    for low, high in (("min_free_disk_gb", "medium_free_disk_gb"), ("minimum_available_gb", "medium_available_gb")):
        if policy[high] < policy[low]:
            raise ValueError(f"{high} must be no less than {low}")
    return policy


#: Fixed values of a chunk policy, per resource: what counts as low (below it) and as medium (up to it), each with its limit.
TIERS = {
    "disk": (("min_free_disk_gb", "low_disk_max_chunk_videos"), ("medium_free_disk_gb", "medium_max_chunk_videos")),
    "ram": (("minimum_available_gb", "ram_low_max_chunk_videos"), ("medium_available_gb", "ram_medium_max_chunk_videos")),
}


def chunk_limit(free_disk_gb: float, ram_gb: float, policy: Mapping[str, float]) -> int:
    """The most videos of a chunk: the smallest limit among the tiers that the resources are in; low hides medium."""
    checked_policy(policy)
    limits = [policy["max_chunk_videos"]]
    for resource, free in (("disk", free_disk_gb), ("ram", ram_gb)):
        (low, at_low), (medium, at_medium) = TIERS[resource]
        limits += [policy[at_low]] if free < policy[low] else [policy[at_medium]] if free <= policy[medium] else []
    return int(min(limits))


#: Rows of a block of greedy_chunks at most.
BLOCK = 4096


def _next_chunks(sizes: np.ndarray, most: int, most_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunk ends that starts at each row of a block (the block's length: not within it), and the sums of sizes before each row."""
    before = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(len(sizes))
    full = np.searchsorted(before, before[:-1] + most_bytes, side="right") - 1
    return np.minimum(np.maximum(np.minimum(at + most, full), at + 1), len(sizes)), before


def _block_facts(sizes: np.ndarray, most: int, most_bytes: int) -> dict[str, Any]:
    """What a block does to an open chunk: for each row at which the first new chunk may start, the chunks started and what the last leaves open."""
    ends, before = _next_chunks(sizes, most, most_bytes)
    n = len(sizes)
    count, rows, size = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        to = int(ends[i])
        count[i], rows[i], size[i] = (1, n - i, int(before[n] - before[i])) if to >= n else (count[to] + 1, rows[to], size[to])
    heads = min(most, n)
    return {"n": n, "total": int(before[n]), "head": before[1 : heads + 1].tolist(), "started": count[:heads], "left_rows": rows[:heads], "left_bytes": size[:heads]}


def _entered(facts: Any, rows: int, size: int, most: int, most_bytes: int) -> int:
    """The first row of the block that an open chunk of so many rows and bytes can't take."""
    if not rows:
        return 0
    return min(bisect.bisect_right(facts.head, most_bytes - size), max(most - rows, 0))


def greedy_chunks(videos: DataFrame, group: str, most: int, most_bytes: int) -> DataFrame:
    """videos(group, pos, video_id, bytes) -> chunk per row: in order of pos (whole numbers, nulls first), then video_id, a new chunk where the count or the bytes would be exceeded.

    Unknown sizes count as the limit, negative ones as none; a video above the limit is a chunk by itself. A group is one
    sequence, but no task reads all of it: rows are dealt by group and block of BLOCK positions. A block is summed up
    by what it makes of an open chunk, for each row at which its first new chunk may start (the first `most` rows); these
    summaries, one row per block, are chained per group; then every block is numbered from the state that it is entered with.
    """
    size = F.when(F.col("bytes").isNull(), F.lit(most_bytes)).otherwise(F.greatest("bytes", F.lit(0))).cast("long")
    rows = videos.select(group, "pos", "video_id", "bytes")
    keyed = rows.withColumn("group_key", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))).withColumn("block_key", F.coalesce(F.floor(F.col("pos") / BLOCK), F.lit(-(1 << 62)))).withColumn("size_", size)
    order = ["group_key", "block_key", "pos", "video_id", "size_"]

    def sum_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a block in order, BLOCK of them at a time: repeated positions may be more."""
        key, part, held = None, 0, []

        def closed() -> pd.DataFrame:
            return pd.DataFrame([{"group_key": key[0], "block_key": key[1], "part": part, **_block_facts(np.concatenate(held), most, most_bytes)}])

        for pdf in frames:
            for k, rows_ in pdf.groupby(["group_key", "block_key"], sort=False):
                if key != k:
                    if held:
                        yield closed()
                    key, part, held = k, 0, []
                sizes = rows_["size_"].to_numpy()
                while len(sizes):
                    room = BLOCK - sum(map(len, held))
                    held.append(sizes[:room])
                    sizes = sizes[room:]
                    if len(sizes):
                        yield closed()
                        part, held = part + 1, []
        if held:
            yield closed()

    facts_schema = "group_key string, block_key long, part int, n long, total long, head array<long>, started array<long>, left_rows array<long>, left_bytes array<long>"
    dealt = keyed.select(*order).repartition("group_key", "block_key").sortWithinPartitions(*order)
    facts = dealt.mapInPandas(sum_up, facts_schema)

    def chain(open_: list[int], block: Any) -> list[int]:
        """The state before the block: the number of the open chunk, its rows and bytes."""
        before = list(open_)
        chunk, rows_, size_ = open_
        at = _entered(block, rows_, size_, most, most_bytes)
        open_[:] = [chunk + block.started[at], block.left_rows[at], block.left_bytes[at]] if at < len(block.head) else [chunk, rows_ + block.n, size_ + block.total]
        return before

    entered = folded(facts, "group_key", ["block_key", "part"], lambda: [-1, 0, 0], chain, "entry array<long>")
    entered = entered.filter("part = 0").select("group_key", "block_key", "entry")

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A block's entry stands before its rows."""
        chunk, n, used = 0, 0, 0
        for pdf in frames:
            out = []
            for s, entry in zip(pdf["size_"], pdf["entry"]):
                if entry is not None:
                    chunk, n, used = map(int, entry)
                    continue
                if not n or n >= most or used + s > most_bytes:
                    chunk, n, used = chunk + 1, 0, 0
                n, used = n + 1, used + int(s)
                out.append(chunk)
            yield pdf[pdf["entry"].isna()].drop(columns=["size_", "entry"]).assign(chunk=out)

    # entries come as rows of their own, not by a join: of a join, Spark drops the repartition that follows it as done
    # already, and may then turn it into a broadcast that leaves a block's rows in the tasks that have read them
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    marked = keyed.withColumn("entry", F.lit(None).cast("array<long>")).unionByName(entered.withColumn("size_", F.lit(0).cast("long")), allowMissingColumns=True)
    d = marked.repartition("group_key", "block_key").sortWithinPartitions("group_key", "block_key", F.col("entry").isNull(), *order[2:])
    return d.select(group, "pos", "video_id", "bytes", "size_", "entry").mapInPandas(number, f"{schema}, chunk int")


def consistency_reviews(gaps: DataFrame, votes: DataFrame, counts: DataFrame, judge: Callable[[DataFrame], DataFrame], rounds: int = 3, padding: int = 1) -> DataFrame:
    """Bounded loop: look for inconsistent gaps, pad and merge them to regions, ask the judge for their labels, until nothing changes.

    judge: regions(video_id, gap) -> video_id, gap, boundary. Rounds are checkpointed, so lineage stays short.
    """
    for _ in range(rounds):
        again = sequences.review_regions(sequences.triggered(gaps, votes), counts, padding)
        asked = again.select("video_id", F.explode(F.sequence("start", "end")).alias("gap"))
        new = judge(asked).select("video_id", "gap", F.col("boundary").alias("new"))
        changed = gaps.join(new, ["video_id", "gap"], "left")
        flips = changed.filter(F.col("new").isNotNull() & (F.col("new") != F.col("boundary")))
        if flips.isEmpty():
            break
        gaps = changed.select("video_id", "gap", F.coalesce("new", "boundary").alias("boundary")).checkpoint()
    return gaps


def degenerate_reviews(gaps: DataFrame, quality: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Gaps of videos whose partition is suspicious get the judge's labels anew."""
    bad = quality.filter("suspicious").select("video_id")
    new = judge(gaps.join(bad, "video_id", "left_semi").select("video_id", "gap")).select("video_id", "gap", F.col("boundary").alias("new"))
    return gaps.join(new, ["video_id", "gap"], "left").select("video_id", "gap", F.coalesce("new", "boundary").alias("boundary"))


def reuse(stages: DataFrame, done: DataFrame, edges: DataFrame) -> DataFrame:
    """stage, reuse: a stage whose fingerprint is as before and whose upstream stages are all reused.

    stages and done(stage, fingerprint), edges(stage, downstream). The graph has a fixed handful of stages.
    """
    same = stages.join(done.withColumnRenamed("fingerprint", "before"), "stage", "left").select("stage", (F.col("fingerprint").eqNullSafe(F.col("before"))).alias("same"))
    stale = closure(edges, same.filter("NOT same").select("stage"))
    return same.join(stale.withColumn("stale", F.lit(True)), "stage", "left").select("stage", (F.col("same") & F.col("stale").isNull()).alias("reuse"))


def closure(edges: DataFrame, start: DataFrame) -> DataFrame:
    """The stages reachable from the given ones (themselves included), by a recursive query."""
    spark = edges.sparkSession
    return spark.sql(
        """WITH RECURSIVE reach(stage, depth) AS (
             SELECT stage, 0 FROM {start} UNION ALL SELECT e.downstream, depth + 1 FROM reach r JOIN {edges} e ON e.stage = r.stage WHERE depth < 50
           ) SELECT DISTINCT stage FROM reach""",
        start=start, edges=edges,
    )


#: Words in a key that mark a secret.
SECRET_WORDS = ("token", "secret", "password", "api_key", "apikey")


@dataclasses.dataclass(frozen=True)
class Config:
    values: dict[str, Any]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(json.dumps(self.values, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def layered(*layers: Mapping[str, Any]) -> Config:
    """Layers merged, later ones first in rank, mappings key by key; keys that look like secrets are refused."""

    def merge(a: Mapping[str, Any], b: Mapping[str, Any]) -> dict[str, Any]:
        return {**a, **{k: merge(a[k], v) if isinstance(v, Mapping) and isinstance(a.get(k), Mapping) else v for k, v in b.items()}}

    def refuse(m: Mapping[str, Any], at: str = "") -> None:
        for k, v in m.items():
            if any(w in str(k).lower() for w in SECRET_WORDS):
                raise ValueError(f"secret in configuration: {at}{k}")
            if isinstance(v, Mapping):
                refuse(v, f"{at}{k}.")

    out: dict[str, Any] = {}
    for layer in layers:
        refuse(layer)
        out = merge(out, layer)
    return Config(out)


def retry_delay(attempt: int, retry_after: float | None = None, most: float = 60.0) -> float:
    return retry_after if retry_after is not None else min(most, 2.0 ** (attempt - 1))


def retry_delays(attempt: Column, retry_after: Column | None = None, most: float = 60.0) -> Column:
    """The same for columns: the wait that was asked for, else a doubling one, at most so long."""
    doubled = F.least(F.pow(F.lit(2.0), attempt - 1), F.lit(most))
    return doubled if retry_after is None else F.coalesce(retry_after.cast("double"), doubled)


def split_batches(rows: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    """Rows numbered into batches of at most size within a group."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1) / size))
