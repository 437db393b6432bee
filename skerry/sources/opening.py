"""Opening a release: the READY marker, checksums of all artifacts, and a content-addressed copy of what is not there yet.

The copy is a Parquet table of (sha256, size, content): Spark's committer makes each added batch whole or absent, on any
file system, and no artifact passes through the driver. An artifact is found by its sum, so releases share what they have
in common. The marker of an opened release is written last.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.sources import release
from skerry.sources.shared import hadoop_path

MANIFEST, READY = "manifest.json", "READY.json"
BLOBS = "sha256 string, size bigint, content binary"


def _read(spark: SparkSession, path: str) -> str:
    """A small file's text; FileNotFoundError if there is none."""
    at, system = hadoop_path(spark, path)
    if not system.exists(at):
        raise FileNotFoundError(path)
    return spark.read.text(path, wholetext=True).first()[0]


def _write(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: it gets its name when it is complete."""
    at, system = hadoop_path(spark, path)
    part, _ = hadoop_path(spark, f"{path}.part")
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.delete(at, False)
    if not system.rename(part, at):
        raise OSError(f"{path} can't be written")


def artifacts(spark: SparkSession, root: str) -> DataFrame:
    """path (below root), size, sha256 of the files of a release, without manifest and marker."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    below = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), F.lit("^" + _escaped(root) + "/"), F.lit(""))
    d = d.select(below.alias("path"), F.col("length").alias("size"), "content")
    return d.filter(~F.col("path").isin(MANIFEST, READY)).select("path", "size", F.sha2("content", 256).alias("sha256"), "content")


def _escaped(root: str) -> str:
    import re

    return re.escape(re.sub("^[a-z0-9]+:/*", "/", root.rstrip("/")))


def publish(spark: SparkSession, root: str, release_id: str) -> str:
    """Writes manifest and READY marker for the files below root; returns the manifest."""
    rows = artifacts(spark, root).select("path", "size", "sha256").toLocalIterator()
    listed = {r["path"]: {"size": r["size"], "sha256": r["sha256"]} for r in rows}
    text = json.dumps({"schema_version": 1, "release_id": release_id, "artifacts": dict(sorted(listed.items()))}, sort_keys=True)
    _write(spark, f"{root}/{MANIFEST}", text)
    _write(spark, f"{root}/{READY}", release.ready(text, release_id))
    return text


def manifest_rows(spark: SparkSession, root: str) -> tuple[dict, DataFrame]:
    """The manifest that the marker vouches for, and its artifacts: path, size, sha256. An artifact without a sum is an error."""
    text = _read(spark, f"{root}/{MANIFEST}")
    ready = _read(spark, f"{root}/{READY}")
    if not json.loads(ready).get("manifest_sha256"):
        raise ValueError(f"{READY} has no manifest_sha256")
    found = release.opened(text, ready)
    if not isinstance(found.get("artifacts"), dict):
        raise ValueError("the manifest has no artifacts")
    unsigned = sorted(k for k, v in found["artifacts"].items() if not isinstance(v, dict) or not v.get("sha256"))
    if unsigned:
        raise ValueError(f"the manifest has no checksum for {unsigned[0]}")
    rows = spark.read.text(f"{root}/{MANIFEST}", wholetext=True).select(F.from_json("value", "artifacts map<string, struct<size: bigint, sha256: string>>").alias("m"))
    return found, rows.select(F.explode("m.artifacts").alias("path", "a")).select("path", "a.size", "a.sha256")


def faults(listed: DataFrame, found: DataFrame) -> DataFrame:
    """path, fault (missing, size, sha256, unlisted) where manifest and files differ."""
    d = listed.select("path", F.col("size").alias("want_size"), F.col("sha256").alias("want")).join(found.select("path", "size", "sha256"), "path", "full")
    fault = (
        F.when(F.col("sha256").isNull(), "missing")
        .when(F.col("want").isNull(), "unlisted")
        .when(F.col("want_size") != F.col("size"), "size")
        .when(F.col("want") != F.col("sha256"), "sha256")
    )
    return d.select("path", fault.alias("fault")).filter("fault IS NOT NULL")


class Opened(NamedTuple):
    """manifest; files(path, size, sha256, content) as of the copy; copied: artifacts that this opening has added to it."""

    manifest: dict
    files: DataFrame
    copied: int


def _blobs(spark: SparkSession, cache: str) -> DataFrame:
    """The copy as it is: sha256, size, content, and the row's place (file and number)."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("place")
    at, system = hadoop_path(spark, f"{cache}/blobs")
    if not system.exists(at):
        return spark.createDataFrame([], f"{BLOBS}, place struct<file: string, row: bigint>")
    return spark.read.schema(BLOBS).parquet(f"{cache}/blobs").select("sha256", "size", "content", place)


def intact(spark: SparkSession, cache: str) -> DataFrame:
    """Artifacts of the copy whose content has the sum that it is stored under, with their places."""
    return _blobs(spark, cache).filter(F.sha2("content", 256) == F.col("sha256"))


def _files(spark: SparkSession, cache: str, listed: DataFrame) -> DataFrame:
    """path, size, sha256, content of the listed artifacts. Sums and places are joined, one intact row each; then only the rows of those places are read, so no content is shuffled."""
    places = intact(spark, cache).groupBy("sha256").agg(F.min("place").alias("place"))
    wanted = listed.join(places, "sha256", "left").select("path", "size", "sha256", "place")
    found = _blobs(spark, cache).select("place", "content").join(F.broadcast(wanted.filter("place IS NOT NULL")), "place")
    lost = wanted.filter("place IS NULL").withColumn("content", F.lit(None).cast("binary"))
    columns = ["path", "size", "sha256", "content"]
    return found.select(columns).unionAll(lost.select(columns))


def _whole(content: Column, sum_: Column) -> Column:
    """The content, or an error if it no longer has the sum."""
    return F.when(F.sha2(content, 256) == sum_, content).otherwise(F.raise_error(F.concat(F.lit("checksum mismatch while copying "), sum_)).cast("binary"))


def opened(spark: SparkSession, root: str, cache: str, needed: list[str] | None = None) -> Opened:
    """Opens the release at root: marker, manifest, sums of all artifacts (of the needed ones, if named), and the copy.

    Any difference is a ValueError and nothing is copied. Opening again copies only what the copy lacks or holds damaged.
    Files that the manifest doesn't list are left alone.
    """
    manifest, listed = manifest_rows(spark, root)
    if needed is not None:
        lacking = sorted(set(needed) - set(manifest["artifacts"]))
        if lacking:
            raise ValueError(f"the manifest has no checksum for {lacking[0]}")
        listed = listed.filter(F.col("path").isin(*needed))
    source = artifacts(spark, root)
    wrong = faults(listed, source).filter("fault <> 'unlisted'").orderBy("path").limit(5).collect()
    if wrong:
        raise ValueError("release differs from its manifest: " + "; ".join(f"{r.path}: {r.fault}" for r in wrong))
    have = intact(spark, cache).select("sha256").distinct()
    new = listed.join(have, "sha256", "left_anti").groupBy(F.col("sha256").alias("want")).agg(F.min("path").alias("path"))
    copied = new.count()
    if copied:
        d = source.join(F.broadcast(new), "path")
        d.select(F.col("want").alias("sha256"), "size", _whole(F.col("content"), F.col("want")).alias("content")).write.mode("append").parquet(f"{cache}/blobs")
    _write(spark, f"{cache}/{manifest['release_id']}.json", json.dumps(manifest, sort_keys=True))
    return Opened(manifest, _files(spark, cache, listed), copied)
