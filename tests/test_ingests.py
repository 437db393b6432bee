"""Manifest ingest, release opening, probe rows and packages on small inputs with every fault."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from skerry.sources import ingest, opening, packages, probes, shared

FACTS = "organizer_metadata_present boolean, metadata_generated boolean, duration_sec double, fps double, frame_count long, width int, height int, is_vfr boolean, file_size_bytes long, probe_status string"
PLAIN = (True, False, 10.0, 25.0, 250, 640, 360, False, 1000, "pass")


@pytest.fixture
def folder(spark):
    path = shared.new_path(spark, "case")
    yield path
    shared.removed(spark, path)


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def _canonical(spark, folder, lines, inventory, records):
    import os

    os.makedirs(local(folder), exist_ok=True)
    with open(f"{local(folder)}/m.jsonl", "w") as f:
        f.write("\n\n".join(json.dumps(x) for x in lines) + "\n")
    columns = FACTS.split(", ")
    extra = "canonical_frame_timeline_path string, frame_timeline_status string, frame_timeline_row_count long"
    i = spark.createDataFrame(inventory, ", ".join(["video_id string, canonical_video_path string, canonical_metadata_path string, metadata_schema_version string", *columns, extra]))
    r = spark.createDataFrame(records, ", ".join(["video_id string, filename string", *columns]))
    return ingest.manifest_rows(spark, f"{folder}/m.jsonl", "top/"), i, r


def _line(k, **more):
    return {"video_id": k, "video_path": f"/top/v/{k}.mp4", "metadata_path": f"top/m/{k}.json", **more}


def _stored(k, facts=PLAIN, video=None, version="1", timeline=(None, None, None)):
    return (k, video or f"v/{k}.mp4", f"m/{k}.json", version, *facts, *timeline)


def test_every_reason(spark, folder):
    def turned(k, value):
        return (*PLAIN[:k], value, *PLAIN[k + 1 :])

    lines = [_line(k) for k in ("ok", "noinv", "dupinv", "old", "nometa", "path", "name", "width", "warn", "near")] + [_line("dup"), _line("dup"), {"video_id": "nopath", "video_path": " ", "metadata_path": "m"}, _line("fail", status="failed"), _line("skip", status="skipped")]
    lines += [_line("tl", frame_timeline_path="top/t/tl"), _line("tlx", frame_timeline_path="t/a"), _line("tlrows", frame_timeline_path="t/tlrows"), _line("tlgone", frame_timeline_path="t/tlgone")]
    inventory = [_stored(k) for k in ("ok", "dup", "dupinv", "dupinv", "nopath", "nometa", "name", "skip", "extra", "tlgone")] + [_stored("old", version="0"), _stored("path", video="v/else.mp4"), _stored("width", turned(5, None)), _stored("warn", turned(9, "partial")), _stored("near", turned(3, 25.0 + 1e-10))]
    inventory += [_stored("tl", timeline=("t/tl", "pass", 7)), _stored("tlx", timeline=("t/b", "pass", 7)), _stored("tlrows", timeline=(None, "pass", 8))]
    records = [(k, f"{k}.mp4", *PLAIN) for k in ("ok", "dup", "dupinv", "noinv", "old", "path", "width", "near", "skip", "tl", "tlx", "tlrows", "tlgone", "nopath")] + [("name", "other.mp4", *PLAIN), ("warn", "warn.mp4", *turned(9, "partial"))]
    timelines = spark.createDataFrame([("tl", 7), ("tlx", 7), ("tlrows", 7)], "video_id string, rows long")
    m, i, r = _canonical(spark, folder, lines, inventory, records)
    got = ingest.ingested(m, i, r, timelines)
    want = {
        "ok": ("pass", None), "skip": ("pass", None), "near": ("pass", None), "tl": ("pass", None), "warn": ("warning", "probe partial"), "noinv": ("conflict", "not in inventory"), "extra": ("conflict", "not in manifest"), "dup": ("conflict", "manifest row repeats"),
        "dupinv": ("conflict", "inventory row repeats"), "nopath": ("conflict", "manifest row lacks a path"), "old": ("conflict", "schema version"), "nometa": ("conflict", "no metadata record"), "path": ("conflict", "video path"), "name": ("conflict", "filename"),
        "width": ("conflict", "field width"), "tlx": ("conflict", "timeline path"), "tlrows": ("conflict", "timeline rows"), "tlgone": ("conflict", "timeline is not stored"),
    }
    assert {r.video_id: (r.status, r.reason) for r in got.verdicts.collect()} == want
    fine = sorted(k for k, v in want.items() if v[0] != "conflict")
    assert sorted(r.video_id for r in got.videos.collect()) == sorted(r.video_id for r in got.media.collect()) == fine
    one = got.videos.filter("video_id = 'tl'").first()
    assert (one.video_ref, one.source_extension, one.has_frame_timeline, one.frame_timeline_ref, one.estimated_compute_cost) == ("media://raw_videos/tl.mp4", ".mp4", True, "frame_timeline/tl.parquet", 10.0)
    assert {r.video_id: r.row_count for r in got.timelines.collect()} == {k: 7 if k == "tl" else 0 for k in fine}
    counts = ingest.report(got).first()
    assert (counts.videos, counts.warnings, counts.conflicts, counts.timelines, counts.timeline_rows) == (len(fine), 1, len(want) - len(fine), 1, 7)
    with pytest.raises(ValueError, match="disagree"):
        ingest.agreed(got)
    needed = {r.video_id: r.reason for r in ingest.ingested(m, i, r, timelines, policy="required").verdicts.collect()}
    assert needed["ok"] == "no timeline" and needed["tl"] is None
    off = {r.video_id: r.reason for r in ingest.ingested(m, i, r, policy="disabled").verdicts.collect()}
    assert off["tlx"] is None and off["tlgone"] is None
    with pytest.raises(ValueError, match="policy"):
        ingest.ingested(m, i, r, policy="maybe")


def test_newest_revision_and_empty(spark, folder):
    a, b = spark.createDataFrame([("x", 1), ("x", 2)], "k string, v int"), spark.createDataFrame([("x", 3), ("y", 4)], "k string, v int")
    assert sorted(tuple(r) for r in ingest.newest({"a": a, "b": b}, "k").collect()) == [("x", 1, "a"), ("x", 2, "a"), ("y", 4, "b")]
    m, i, r = _canonical(spark, folder, [_line("bad", status="failed")], [], [])
    with pytest.raises(ValueError, match="no successful"):
        ingest.agreed(ingest.ingested(m, i, r))


# ---- releases


def _files(folder, texts):
    import os

    for name, text in texts.items():
        at, last = os.path.split(f"{local(folder)}/{name}")
        os.makedirs(at, exist_ok=True)
        if os.path.exists(f"{at}/.{last}.crc"):  # Hadoop's own sum of what it wrote
            os.remove(f"{at}/.{last}.crc")
        with open(f"{local(folder)}/{name}", "w") as f:
            f.write(text)


def test_opening_copies_what_differs(spark, folder):
    root, cache = f"{folder}/r1", f"{folder}/cache"
    _files(root, {"a.txt": "one", "b/c.bin": "two", "b/same": "one"})
    opening.publish(spark, root, "r1")
    done = opening.opened(spark, root, cache)
    assert done.copied == 2 and {r.path: bytes(r.content) for r in done.files.collect()} == {"a.txt": b"one", "b/c.bin": b"two", "b/same": b"one"}
    assert opening.opened(spark, root, cache).copied == 0
    other = f"{folder}/r2"
    _files(other, {"a.txt": "one", "b/c.bin": "2wo"})
    opening.publish(spark, other, "r2")
    assert opening.opened(spark, other, cache).copied == 1
    # a changed byte of the same length
    _files(root, {"b/c.bin": "twO"})
    listed, found = opening.manifest_rows(spark, root)[1], opening.artifacts(spark, root)
    assert [tuple(r) for r in opening.faults(listed, found).collect()] == [("b/c.bin", "sha256")]
    with pytest.raises(ValueError, match="b/c.bin: sha256"):
        opening.opened(spark, root, cache)
    assert opening.opened(spark, root, cache, ["a.txt"]).copied == 0  # only what is needed is checked
    _files(root, {"b/c.bin": "two", "new": "x"})
    assert opening.opened(spark, root, cache).copied == 0  # unlisted files are left alone


def test_damaged_copy_is_made_again(spark, folder):
    root, cache = f"{folder}/r", f"{folder}/cache"
    _files(root, {"a": "one", "b": "two"})
    opening.publish(spark, root, "r")
    opening.opened(spark, root, cache)
    bad = spark.read.parquet(f"{cache}/blobs").withColumn("content", F.when(F.col("content") == F.lit("one").cast("binary"), F.lit("ONE").cast("binary")).otherwise(F.col("content")))
    rows = [tuple(r) for r in bad.collect()]
    spark.createDataFrame(rows, opening.BLOBS).write.mode("overwrite").parquet(f"{cache}/blobs")
    done = opening.opened(spark, root, cache)
    assert done.copied == 1 and sorted(bytes(r.content) for r in done.files.collect()) == [b"one", b"two"]


def test_marker_and_manifest_must_hold(spark, folder):
    root = f"{folder}/r"
    with pytest.raises(FileNotFoundError):
        opening.manifest_rows(spark, root)
    _files(root, {"a": "one"})
    text = opening.publish(spark, root, "r")
    _files(root, {"manifest.json": text.replace("one", "two") + " "})
    with pytest.raises(ValueError, match="READY"):
        opening.manifest_rows(spark, root)
    for broken, why in ({"schema_version": 1, "release_id": "r"}, "no artifacts"), ({"schema_version": 1, "release_id": "r", "artifacts": {"a": {"size": 3}}}, "no checksum for a"), ({"schema_version": 2, "release_id": "r", "artifacts": {}}, "schema"):
        text = json.dumps(broken)
        _files(root, {"manifest.json": text, "READY.json": opening.release.ready(text, "r")})
        with pytest.raises(ValueError, match=why):
            opening.manifest_rows(spark, root)
    _files(root, {"READY.json": json.dumps({"release_id": "r"})})
    with pytest.raises(ValueError, match="manifest_sha256"):
        opening.manifest_rows(spark, root)


# ---- probe rows


def _plain_rows(lines):
    def number(fields, *places):
        for k in places:
            try:
                return float(fields[k])
            except (ValueError, IndexError):
                pass
        return None

    rows = [(number(x.split(","), 0), number(x.split(","), 1, 2)) for x in lines]
    return [(i, *r) for i, r in enumerate(r for r in rows if r[0] is not None)]


@pytest.mark.parametrize("splits", [1, 2, 50])
def test_frames_are_numbered_across_splits(spark, folder, splits):
    rng, want = random.Random(splits), {}
    for name in ("a", "long", "empty", "none"):
        n = {"a": 40, "long": 3000, "empty": 0, "none": 5}[name]
        lines = [rng.choice([f"{i * 0.04:.3f},0.04,0.5", f"{i * 0.04:.3f},N/A,0.05", f"{i * 0.04:.3f}", "N/A,0.04", "", f" {i}.5 ,N/A,N/A"]) if name != "none" else "N/A,N/A" for i in range(n)]
        _files(folder, {f"{name}.csv": "\n".join(lines)})
        want[name] = _plain_rows(lines)
    size = max(1, len(open(f"{local(folder)}/long.csv").read()) // splits + 1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(before, (size, size)):
            spark.conf.set(k, v)
        lines = probes.frame_lines(spark, folder)
        assert lines.filter(F.col("file").endswith("long.csv")).select("block").distinct().count() == splits
        got = {}
        for r in probes.frame_rows(spark, folder).collect():
            got.setdefault(r.video_id, []).append((r.frame_id, r.pts_time, r.duration_time))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_probe_facts(spark):
    frames = spark.createDataFrame([("a", i, t, None) for i, t in enumerate((0.0, 0.04, 0.08, 0.2))] + [("b", i, i * 0.5, None) for i in range(2)], "video_id string, frame_id long, pts_time double, duration_time double")
    rows = [("a", "30000/1001", "25/1", "1.5", "9", "8", "640", "x"), ("b", "0/0", "25/1", "N/A", "7", None, None, None), ("c", "0/1", "50", "2.0", "7", "8", "1", "2"), ("d", None, "25/1", "1.5", None, "8", None, None), ("e", "25/1", None, "1.1", "", None, None, None), ("f", None, None, None, None, None, None, None)]
    streams = spark.createDataFrame(rows, "video_id string, avg_frame_rate string, r_frame_rate string, duration string, nb_read_packets string, nb_frames string, width string, height string")
    got = {r.video_id: r for r in probes.probe_facts(frames, streams).collect()}
    assert [(got[k].frame_count, got[k].frame_count_method, got[k].frame_count_estimated, got[k].is_vfr) for k in "abcdef"] == [
        (4, "decoded_frame_timeline", False, True), (2, "decoded_frame_timeline", False, None), (7, "ffprobe_nb_read_packets", False, None), (8, "ffprobe_nb_frames", False, None), (28, "estimated_from_duration_and_fps", True, None), (None, "unavailable", True, None),
    ]
    assert got["a"].fps_detected == 30000 / 1001 and got["b"].fps_detected == 25 and got["c"].fps_detected == 50 and got["f"].fps_source == "unavailable" and (got["a"].width, got["a"].height) == (640, None)


# ---- packages


def _written(spark, folder, rows=None):
    rows = rows or [(v, f"d/{k}.txt", (f"{v}{k}" * 50).encode()) for v in ("v1", "v2", "v3", "v4", "v5", "v6") for k in range(3)]
    packages.write_packages(spark.createDataFrame(rows, packages.SCHEMA), folder, "kind", batch_id="b", status="pass")
    return rows


def _changed(path, change):
    with zipfile.ZipFile(path) as z:
        files = {n: z.read(n) for n in z.namelist()}
    change(files)
    with zipfile.ZipFile(path, "w") as z:
        for n, c in files.items():
            z.writestr(n, c)


def test_packages_round_trip_and_are_not_overwritten(spark, folder):
    import os

    rows = _written(spark, folder)
    assert sorted(os.listdir(local(folder))) == [f"v{k}_kind.zip" for k in range(1, 7)]
    assert sorted((r.video_id, r.path, bytes(r.content)) for r in packages.payload(spark, folder).collect()) == rows
    with zipfile.ZipFile(f"{local(folder)}/v1_kind.zip") as z:
        manifest = json.loads(z.read("v1/artifact_manifest.json"))
    assert manifest["artifact_id"] == "v1_kind" and manifest["batch_id"] == "b" and len(manifest["files"]) == 3
    with pytest.raises(Exception, match="there already"):
        _written(spark, folder, [("v0", "a", b"0"), ("v2", "a", b"x")])
    assert sorted(os.listdir(local(folder))) == [f"v{k}_kind.zip" for k in range(1, 7)]  # nothing of the failed job stays
    packages.write_packages(spark.createDataFrame([("v2", "a", b"x")], packages.SCHEMA), folder, "kind", overwrite=True)
    assert packages.payload(spark, folder).filter("video_id = 'v2'").count() == 1


@pytest.mark.parametrize("row", [("v1", "../up", b""), ("v1", "/abs", b""), ("v1", "x/checksums.json", b""), ("a/b", "x", b""), ("v1", "", b"")])
def test_names_stay_inside(spark, folder, row):
    import os

    with pytest.raises(Exception, match="not a p"):
        _written(spark, folder, [row])
    assert not [n for n in os.listdir(local(folder)) if n.endswith(".zip")]


def test_each_fault_is_reported(spark, folder):
    _written(spark, folder)
    at = f"{local(folder)}/v%d_kind.zip"

    def unlisted(files):
        m = json.loads(files["v5/artifact_manifest.json"])
        m["files"] = m["files"][1:]
        del m["artifact_id"]
        files["v5/artifact_manifest.json"] = json.dumps(m).encode()

    _changed(at % 1, lambda f: f.pop("v1/d/0.txt"))
    _changed(at % 2, lambda f: f.update({"v2/d/extra": b"x", "else/where": b"y"}))
    _changed(at % 3, lambda f: f.update({"v3/d/1.txt": f["v3/d/1.txt"][:-1] + b"#"}))
    _changed(at % 4, lambda f: f.pop("v4/checksums.json"))
    _changed(at % 5, unlisted)
    with open(at % 6, "wb") as f:
        f.write(b"PK not a zip")
    got = {(r.package[:2], r.path, r.fault) for r in packages.package_faults(packages.listings(spark, folder)).collect()}
    want = {
        ("v1", "v1/d/0.txt", "missing"), ("v2", "v2/d/extra", "no checksum"), ("v2", "else/where", "no checksum"), ("v2", None, "outside v2/: else/where"), ("v3", "v3/d/1.txt", "altered"), ("v4", None, "0 files checksums.json"),
        *{("v4", f"v4/d/{k}.txt", "no checksum") for k in range(3)}, ("v5", "v5/d/0.txt", "not in manifest"), ("v5", None, "manifest lacks artifact_id"), ("v6", None, "not a ZIP"),
    }
    assert got == want
    with pytest.raises(ValueError, match="missing"):
        packages.payload(spark, folder)


def test_probe_files_need_no_folder_each(spark):
    path = shared.new_path(spark, "probes")
    d = spark.range(900).select((F.col("id") % 300).alias("video_id"), (F.col("id") / 300).cast("int").alias("frame_id"), F.col("id").cast("string").alias("value"))
    assert probes.write_lines(d, path) == 300
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("f")).distinct()
    assert files.count() == 300
    assert files.select(F.regexp_extract("f", "part=([0-9]+)/", 1)).distinct().count() <= probes.FOLDERS
    got = {(r.video_id, r.frame_id): r.pts_time for r in probes.frame_rows(spark, path).collect()}
    assert got == {(str(k % 300), k // 300): float(k) for k in range(900)}


@pytest.mark.parametrize("name", [None, "", "a/b", "_a", ".a"])
def test_probe_files_that_no_reader_would_find_are_errors(spark, name):
    with pytest.raises(Exception, match="not a file's name"):
        probes.write_lines(spark.createDataFrame([(name, 0, "1.0")], "video_id string, frame_id int, value string"), shared.new_path(spark, "probes"))


def test_packages_are_read_once_for_their_faults(spark):
    rows = [("a", "fault", "no checksums", None, None)] * 2 + [("a", "payload", "a/x", 1, "s"), ("b", "manifest", "b/y", 1, "s"), ("c", "payload", "c/z", 1, "s"), ("c", "manifest", "c/z", 1, "s"), ("c", "checksums", "c/z", 1, "s")]
    found = packages.package_faults(spark.createDataFrame(rows, packages.LISTING))
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    assert sorted(tuple(r) for r in found.filter("path IS NOT NULL").collect()) == [("a", "a/x", "no checksum"), ("b", "b/y", "only in manifest")]
    assert [tuple(r) for r in found.filter("path IS NULL").collect()] == [("a", None, "no checksums")] * 2


def test_contents_are_not_shuffled(spark, folder):
    """files of an opened release come from their places in the copy; repeated and damaged rows there don't matter."""
    root, cache = f"{folder}/shop", f"{folder}/cache"
    _files(root, {"a.txt": "one", "b/c.bin": "two", "d.txt": "one"})
    opening.publish(spark, root, "r")
    opening.opened(spark, root, cache)
    rows = spark.read.schema(opening.BLOBS).parquet(f"{cache}/blobs").collect()
    again = [tuple(r) for r in rows] + [(r.sha256, r.size, bytearray(b"damaged")) for r in rows]
    spark.createDataFrame(again, opening.BLOBS).write.mode("append").parquet(f"{cache}/blobs")
    done = opening.opened(spark, root, cache)
    assert done.copied == 0
    assert sorted((r.path, bytes(r.content)) for r in done.files.collect()) == [("a.txt", b"one"), ("b/c.bin", b"two"), ("d.txt", b"one")]
    plan = done.files._jdf.queryExecution().executedPlan().toString()
    assert "first(content" not in plan and "BroadcastHashJoin" in plan
