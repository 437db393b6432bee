"""Packages: one ZIP per key with its payload, a manifest and checksums; a sink with a commit protocol, and a three-way check.

The sink is a Python data source. Each task streams its keys' files, one at a time, into ZIPs below a staging folder; the
commit gives all of them their names, and a failed job leaves none. File systems are pyarrow's (local, HDFS, S3), so
executors need nothing of the driver's. The check reads every ZIP in a task and meets the three listings of a path in one
aggregation.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Names of a package's own files, and the fields that its manifest must have.
MANIFEST, CHECKSUMS = "artifact_manifest.json", "checksums.json"
REQUIRED = ("artifact_id", "video_id", "artifact_type", "files")
SCHEMA = "video_id string, path string, content binary"


def _system(root: str):
    """pyarrow's file system of a folder, and the folder's name in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")


def _checked(path: str) -> str:
    """A payload's name below its package, or ValueError."""
    if not path or path.startswith("/") or ".." in path.split("/") or path.rsplit("/", 1)[-1] in (MANIFEST, CHECKSUMS):
        raise ValueError(f"not a payload's name: {path!r}")
    return path


@dataclass
class _Staged(WriterCommitMessage):
    names: tuple[tuple[str, str], ...]
    folder: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.root, self.kind, self.facts, self.overwrite = options["path"].rstrip("/"), options["artifact_type"], json.loads(options.get("facts", "{}")), overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _system(self.root)
        folder = f"{root}/{self.staging}/{uuid.uuid4().hex}"  # an attempt's own
        system.create_dir(folder, recursive=True)
        names, zipped, listed, open_id = [], None, {}, None

        def finish() -> None:
            if zipped is None:
                return
            manifest = {"artifact_id": f"{open_id}_{self.kind}", "video_id": open_id, "artifact_type": self.kind, **self.facts, "files": [{"path": k, **v} for k, v in listed.items()]}
            for name, value in ((CHECKSUMS, listed), (MANIFEST, manifest)):
                zipped.writestr(zipfile.ZipInfo(f"{open_id}/{name}"), json.dumps(value, sort_keys=True), zipfile.ZIP_DEFLATED)
            zipped.close()
            stream.close()

        for batch in iterator:
            for row in batch.to_pylist():
                if row["video_id"] != open_id:
                    finish()
                    open_id, listed = row["video_id"], {}
                    if not open_id or "/" in open_id:
                        raise ValueError(f"not a package's name: {open_id!r}")
                    name = f"{open_id}_{self.kind}.zip"
                    names.append((f"{folder}/{name}", f"{root}/{name}"))
                    stream = system.open_output_stream(names[-1][0])
                    zipped = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
                path, content = f"{open_id}/{_checked(row['path'])}", row["content"] or b""
                if path in listed:
                    raise ValueError(f"{path} is there twice")
                listed[path] = {"size_bytes": len(content), "sha256": hashlib.sha256(content).hexdigest()}
                zipped.writestr(zipfile.ZipInfo(path), content, zipfile.ZIP_DEFLATED)
        finish()
        return _Staged(tuple(names), f"{root}/{self.staging}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, root = _system(self.root)
        staged = [x for m in messages if m for x in m.names]
        there = [] if self.overwrite else [f.path for f in system.get_file_info([new for _, new in staged]) if f.type != fs.FileType.NotFound]
        if there:
            self.abort(messages)
            raise FileExistsError(f"{len(there)} packages are there already, such as {there[0]}")
        for old, new in staged:
            system.move(old, new)
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, root = _system(self.root)
        if system.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/{self.staging}")


class Packages(DataSource):
    """write.format("packages").option("artifact_type", ..).save(path); rows as of SCHEMA, each key's rows together."""

    @classmethod
    def name(cls) -> str:
        return "packages"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def write_packages(payload: DataFrame, path: str, artifact_type: str, overwrite: bool = False, **facts: str) -> None:
    """One package per video_id of payload(video_id, path, content); facts (batch_id, status, schema_version ..) go into each manifest.

    Packages that are there already are an error, unless they are to be overwritten. A key's files stream through one task,
    so a package is bounded by what a ZIP of a video holds, a task's memory by its largest file.
    """
    spark = payload.sparkSession
    spark.dataSource.register(Packages)
    rows = payload.select(*[F.col(c).cast(k).alias(c) for c, k in (x.split() for x in SCHEMA.split(", "))])
    rows = rows.repartition("video_id").sortWithinPartitions("video_id", "path")
    rows.write.format("packages").option("artifact_type", artifact_type).option("facts", json.dumps(facts)).mode("overwrite" if overwrite else "append").save(path)


def _zips(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return d.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("package"), "content")


LISTING = "package string, part string, path string, size long, sha256 string"


def listings(spark: SparkSession, path: str) -> DataFrame:
    """What each package says and holds: package, part (manifest, checksums, payload, or fault with its text in path), path, size, sha256."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = _listed(content.as_buffer())
                columns = list(zip(*[(name, *r) for r in rows])) or [()] * 5
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()))], names=[x.split()[0] for x in LISTING.split(", ")])

    return _zips(spark, path).mapInArrow(read, LISTING)


def _listed(content) -> list[tuple[str, str, int | None, str | None]]:
    rows: list[tuple[str, str, int | None, str | None]] = []
    fault = lambda text: rows.append(("fault", text, None, None))
    try:
        archive = zipfile.ZipFile(io.BufferedReader(pa.BufferReader(content)))
    except zipfile.BadZipFile:
        return [("fault", "not a ZIP", None, None)]
    with archive:
        names = [n for n in archive.namelist() if not n.endswith("/")]
        own = {k: [n for n in names if n.rsplit("/", 1)[-1] == k] for k in (MANIFEST, CHECKSUMS)}
        read = {}
        for k, found in own.items():
            if len(found) != 1:
                fault(f"{len(found)} files {k}")
                continue
            try:
                read[k] = json.loads(archive.read(found[0]))
            except (ValueError, zipfile.BadZipFile):
                fault(f"{k} is broken")
        manifest, sums = read.get(MANIFEST, {}), read.get(CHECKSUMS, {})
        if MANIFEST in read:
            lacking = [k for k in REQUIRED if k not in manifest]
            if lacking:
                fault("manifest lacks " + ", ".join(lacking))
            root = f"{manifest.get('video_id')}/"
            for k, found in own.items():
                if len(found) == 1 and found[0] != root + k:
                    fault(f"{k} is not directly below {root}")
            for n in names:
                if not n.startswith(root):
                    fault(f"outside {root}: {n}")
            if not manifest.get("files"):
                fault("manifest lists no files")
        if CHECKSUMS in read and not sums:
            fault("no checksums")
        rows += [("manifest", str(x.get("path")), x.get("size_bytes"), x.get("sha256")) for x in manifest.get("files") or []]
        rows += [("checksums", k, v.get("size_bytes"), v.get("sha256")) for k, v in sums.items()]
        for n in names:
            if n in own[MANIFEST] or n in own[CHECKSUMS]:
                continue
            digest, size = hashlib.sha256(), 0
            try:
                with archive.open(n) as member:
                    while block := member.read(1 << 20):
                        digest.update(block)
                        size += len(block)
                rows.append(("payload", n, size, digest.hexdigest()))
            except zipfile.BadZipFile:
                rows.append(("payload", n, size, "unreadable"))
    return rows


def package_faults(listed: DataFrame) -> DataFrame:
    """package, path, fault of listings(..): what manifest, checksums and payload don't agree on, file by file, and broken packages."""
    at = lambda part, c: F.max(F.when(F.col("part") == part, F.col(c)))
    # one pass: listings are made by reading every package
    d = listed.groupBy("package", "path", (F.col("part") == "fault").alias("broken")).agg(F.count(F.lit(1)).alias("n"), *[f.alias(f"{part}_{c}") for part in ("manifest", "checksums", "payload") for c, f in (("size", at(part, "size")), ("sha256", at(part, "sha256")), ("n", F.count_if(F.col("part") == part)))])
    metadata = F.regexp_extract("path", r"([^/]*)$", 1).isin(MANIFEST, CHECKSUMS)
    differs = lambda a: ~F.col(f"{a}_sha256").eqNullSafe(F.col("payload_sha256")) | ~F.col(f"{a}_size").eqNullSafe(F.col("payload_size"))
    fault = (
        F.when(F.col("broken"), F.col("path"))
        .when(F.greatest("manifest_n", "checksums_n", "payload_n") > 1, "listed twice")
        .when(metadata, "package file is checksummed")
        .when(F.col("checksums_n") == 0, F.when(F.col("payload_n") == 0, "only in manifest").otherwise("no checksum"))
        .when(F.col("manifest_n") == 0, "not in manifest")
        .when(F.col("payload_n") == 0, "missing")
        .when(differs("checksums"), "altered")
        .when(differs("manifest"), "manifest differs")
    )
    times = F.explode(F.array_repeat(F.when(~F.col("broken"), F.col("path")), F.when(F.col("broken"), F.col("n")).otherwise(1).cast("int"))).alias("path")
    return d.withColumn("fault", fault).filter("fault IS NOT NULL").select("package", times, "fault")


def payload(spark: SparkSession, path: str) -> DataFrame:
    """video_id, path (below the package), content of the packages' files; a package that fails the check is an error."""
    wrong = package_faults(listings(spark, path)).orderBy("package", "path").limit(3).collect()
    if wrong:
        raise ValueError("; ".join(f"{r.package}: {r.path or ''} {r.fault}" for r in wrong))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                with zipfile.ZipFile(io.BufferedReader(pa.BufferReader(content.as_buffer()))) as archive:
                    for n in archive.namelist():
                        top, _, name = n.partition("/")
                        if name not in (MANIFEST, CHECKSUMS):
                            yield pa.record_batch([pa.array([top]), pa.array([name]), pa.array([archive.read(n)], pa.binary())], ["video_id", "path", "content"])

    return _zips(spark, path).mapInArrow(read, SCHEMA)
