import json

import pytest
from pyspark.sql import functions as F

from skerry.operators import aggregates
from skerry.plans import checks, fusion, packing
from skerry.sources import release, tables
from skerry.streaming import windows


def test_longest_first(spark):
    d = spark.createDataFrame([("a", 5.0), ("b", 4.0), ("c", 3.0), ("d", 3.0), ("e", 0.0)], "video_id string, cost double")
    assert {r.video_id: r.batch for r in packing.least_loaded(d, 2).collect()} == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_chunks(spark):
    d = spark.createDataFrame([("g", 0, "a", 60), ("g", 1, "b", 50), ("g", 2, "c", 1), ("g", 3, "d", None), ("g", 4, "e", 1), ("g", 5, "f", 1), ("g", 6, "h", 1)], "g string, pos int, video_id string, bytes long")
    got = [r.chunk for r in packing.greedy_chunks(d, "g", 3, 100).orderBy("pos").collect()]
    assert got == [0, 1, 1, 2, 3, 3, 3]


def test_tiers():
    policy = {"max_chunk_videos": 8, "min_free_disk_gb": 10, "low_disk_max_chunk_videos": 1, "medium_free_disk_gb": 30, "medium_max_chunk_videos": 4, "minimum_available_gb": 4, "ram_low_max_chunk_videos": 2, "medium_available_gb": 8, "ram_medium_max_chunk_videos": 3}
    assert [packing.chunk_limit(d, r, policy) for d, r in ((5, 99), (20, 99), (99, 99), (99, 6), (99, 1), (20, 6))] == [1, 4, 8, 3, 2, 3]


def test_review_loop(spark):
    gaps = spark.createDataFrame([("v", i, i in (2, 3)) for i in range(8)], "video_id string, gap long, boundary boolean")
    votes = spark.createDataFrame([("v", 0, True)], "video_id string, gap long, boundary boolean")
    counts = spark.createDataFrame([("v", 9)], "video_id string, shots long")
    got = packing.consistency_reviews(gaps, votes, counts, lambda r: r.withColumn("boundary", F.col("gap") == 2))
    assert [r.boundary for r in got.orderBy("gap").collect()] == [i == 2 for i in range(8)]


def test_degenerate_review(spark):
    gaps = spark.createDataFrame([("a", 0, True), ("b", 0, True)], "video_id string, gap long, boundary boolean")
    quality = spark.createDataFrame([("a", True), ("b", False)], "video_id string, suspicious boolean")
    got = packing.degenerate_reviews(gaps, quality, lambda g: g.withColumn("boundary", F.lit(False)))
    assert {r.video_id: r.boundary for r in got.collect()} == {"a": False, "b": True}


def test_configuration():
    c = packing.layered({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"x": 3}})
    assert c.values == {"a": {"x": 3, "y": 2}, "b": 1}
    assert c.sha256 == packing.layered({"b": 1, "a": {"y": 2, "x": 3}}).sha256
    with pytest.raises(ValueError, match="secret"):
        packing.layered({"hub": {"api_key": "x"}})


def test_retry(spark):
    d = spark.createDataFrame([(1, None), (3, None), (9, None), (5000, None), (2, 7.5)], "n int, asked double")
    assert [r.x for r in d.select(packing.retry_delays(F.col("n"), F.col("asked")).alias("x")).collect()] == [1.0, 4.0, 60.0, 60.0, 7.5]
    assert [packing.retry_delay(n) for n in (1, 3, 9)] == [1.0, 4.0, 60.0] and packing.retry_delay(2, 7.5) == 7.5


@pytest.mark.parametrize("break_it,check", [
    (lambda d: d.drop("text"), "missing:text"), (lambda d: d.unionByName(d.limit(1)), "unique:id"), (lambda d: d.withColumn("id", F.when(F.col("id") > 1, F.col("id"))), "null:id"),
    (lambda d: d.withColumn("text", F.lit(" ")), "blank:text"), (lambda d: d.withColumn("kind", F.lit("z")), "domain:kind"), (lambda d: d.withColumn("id", F.col("id").cast("string")), "type:id"),
])
def test_one_defect_at_a_time(spark, break_it, check):
    d = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, text string, kind string")
    spec = checks.TableSpec("t", required=("id", "text"), non_null=("id",), unique=(("id",),), non_empty=("text",), domains={"kind": ("x", "y")}, integer=("id",), text=("text",))
    assert checks.verdicts(checks.check_table(d, spec)).filter("table = 'release'").first().status == "pass"
    bad = {r.check for r in checks.check_table(break_it(d), spec).filter("violations > 0").collect()}
    assert check in bad


def test_scores(spark):
    a = spark.createDataFrame([("q", 1, 0.0), ("q", 4, 0.5), ("q", 60, 1.0)], "query_id string, rank int, rscore double")
    assert abs(fusion.recall_score(a).first().score - (0 + 0.5 + 0.5 + 0.5 + 1) / 5) < 1e-12
    assert all(abs(sum(w.values()) - 1) < 1e-9 for w in fusion.PROFILES.values())


def test_clue_modes(spark):
    d = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b")], "session_id string, batch int, clue string")
    assert fusion.latest(d, "accumulated").count() == 2 and fusion.latest(d, "current_only").first().clue == "b"
    with pytest.raises(ValueError):
        fusion.latest(d, "some")


def test_release_round_trip(spark, tmp_path):
    (tmp_path / "maps").mkdir()
    (tmp_path / "maps/V1.csv").write_text("n,pts_time,fps,frame_idx\n1,0.0,25,0\n2,2.0,25,50\n")
    (tmp_path / "maps/V2.csv").write_text("n,pts_time,fps,frame_idx\n1,0.0,25,0\n3,2.0,25,50\n")
    maps = release.read_maps(spark, f"{tmp_path}/maps")
    assert [r.video_id for r in release.map_faults(maps).collect()] == ["V2"]
    release.write_table(maps, f"{tmp_path}/out", partition_by=("video_id",))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4
    with pytest.raises(Exception, match="already exists"):
        release.write_table(maps, f"{tmp_path}/out")
    listing = release.files(spark, f"{tmp_path}/maps")
    text = release.manifest(listing, "r1")
    assert [f["name"] for f in json.loads(text)["files"]] == ["V1.csv", "V2.csv"]
    assert release.opened(text, release.ready(text, "r1"))["release_id"] == "r1"
    with pytest.raises(ValueError):
        release.opened(text.replace("r1", "r2"), release.ready(text, "r1"))
    assert release.listed(spark, f"{tmp_path}/maps", "V1*").first().stem == "V1"


def test_json_rows_fail_fast(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{broken\n')
    assert release.read_json_rows(spark, f"{tmp_path}/a.jsonl", "a int").count() == 2
    with pytest.raises(Exception):
        release.read_json_rows(spark, f"{tmp_path}/b.jsonl", "a int").collect()


def test_answer_files_are_never_overwritten(spark, tmp_path):
    d = spark.createDataFrame([("V1,3",)], "line string")
    release.write_lines(d, f"{tmp_path}/answers")
    with pytest.raises(Exception, match="already exists"):
        release.write_lines(d, f"{tmp_path}/answers")


def test_detections(spark):
    raw = spark.createDataFrame(
        [("k", ["a", "b", "c", "d"], ["m"] * 4, ["1", "2", "x", "4"], ["0.9", "0.1", "0.8", "NaN"], [["0", "0", "1", "1"]] * 4)],
        "keyframe_id string, detection_class_entities array<string>, detection_class_names array<string>, detection_class_labels array<string>, detection_scores array<string>, detection_boxes array<array<string>>",
    )
    d = release.detections(raw, 0.3)
    assert [(r.rank, r.entity) for r in d.rows.collect()] == [(1, "a")]
    assert d.malformed.first().malformed == 2  # the label and the NaN; the low score goes before checks


def test_latest_release_must_be_unique(spark):
    d = lambda rows: release.latest_release(spark.createDataFrame(rows, "id string, created int")).collect()
    assert d([("a", 1), ("b", 2)])[0].id == "b"
    assert d([("a", 2), ("b", 2)]) == [] and d([("a", 2), ("b", None)]) == []


def test_stems_grow_until_they_differ(spark):
    d = spark.createDataFrame([("x/a/f.mp4",), ("x/b/f.mp4",), ("y/g h.mp4",)], "path string")
    assert sorted(r.stem for r in release.canonical_stems(d).collect()) == ["a__f", "b__f", "g_h"]
    deep = "/1/2/3/4/5/6/7/f.mp4"
    d = spark.createDataFrame([("x" + deep,), ("y" + deep,)], "path string")
    assert sorted(r.stem for r in release.canonical_stems(d).collect()) == ["x__1__2__3__4__5__6__7__f", "y__1__2__3__4__5__6__7__f"]
    assert release.canonical_stems(d.limit(0)).count() == 0


def test_null_group_keys_stay(spark):
    d = spark.createDataFrame([(None, "t", None, 1, "b", "x", "en"), (None, "t", None, 0, "a", "y", "vi"), ("v", "t", "e", 0, "", "x", "")], "video_id string, entity_type string, entity_id string, pos int, text string, source_type string, language string")
    got = {r.video_id: r for r in aggregates.text_documents(d).collect()}
    assert got[None].text == "a\nb" and got[None].language == "mul" and got[None].source_types == "x,y"
    assert got["v"].text == "" and got["v"].language == "und"


def test_views_expand():
    assert "{" not in tables.expand("SELECT * FROM {keyframes} JOIN {videos} USING (video_id)")


def test_streams_equal_batches(spark, tmp_path, sf_dir):
    """A file stream in three batches gives what the batch form gives, but for windows that are still open."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value").orderBy("ts")
    events.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    stream = windows.event_counts(source, "1 hour", "100 days")
    q = stream.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/state").start()
    q.awaitTermination()
    got = spark.table("counted").select("start", "event_type", "events").collect()
    want = windows.event_counts(events).select("start", "event_type", "events").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_policy_is_checked():
    policy = {k: 2 for k in packing.POLICY}
    assert packing.checked_policy(policy) is policy
    for name in packing.POLICY:
        with pytest.raises(ValueError, match=name):
            packing.checked_policy(policy | {name: -1})
    for name in ("medium_free_disk_gb", "medium_available_gb"):
        with pytest.raises(ValueError, match="no less than"):
            packing.checked_policy(policy | {name: 1})


def test_manifests_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(packing, "MANIFEST_ROWS", 3)
    with pytest.raises(ValueError, match="3 videos"):
        packing.least_loaded(spark.createDataFrame([(str(i), 1.0) for i in range(4)], "video_id string, cost double"), 2)
