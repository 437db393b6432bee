"""Data contracts: every rule is a count of violating rows; a table's column rules share one scan."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclasses.dataclass(frozen=True)
class TableSpec:
    """required: names, or tuples of alternatives of which one must be there; rules: SQL conditions that each row must fulfil."""

    name: str
    required: tuple[str | tuple[str, ...], ...] = ()
    non_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    non_empty: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = dataclasses.field(default_factory=dict)
    integer: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    rules: dict[str, str] = dataclasses.field(default_factory=dict)


def missing_columns(d: DataFrame, required: tuple[str | tuple[str, ...], ...]) -> list[str]:
    names = set(d.columns)
    return [r if isinstance(r, str) else "|".join(r) for r in required if not names & ({r} if isinstance(r, str) else set(r))]


def wrong_types(d: DataFrame, spec: TableSpec) -> list[str]:
    whole, number = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.NumericType,)
    wanted = [(c, whole) for c in spec.integer] + [(c, number) for c in spec.numeric] + [(c, (T.StringType,)) for c in spec.text]
    kinds = {f.name: f.dataType for f in d.schema.fields}
    return [c for c, kind in wanted if c in kinds and not isinstance(kinds[c], (*kind, T.NullType))]


def check_table(d: DataFrame, spec: TableSpec) -> DataFrame:
    """check, violations for every rule of a table."""
    spark = d.sparkSession
    static = [("missing:" + c, 1) for c in missing_columns(d, spec.required)] + [("type:" + c, 1) for c in wrong_types(d, spec)]
    counts: dict[str, Column] = {f"null:{c}": F.count_if(F.col(c).isNull()) for c in spec.non_null if c in d.columns}
    counts |= {f"blank:{c}": F.count_if(F.trim(F.coalesce(F.col(c), F.lit(""))) == "") for c in spec.non_empty if c in d.columns}
    counts |= {f"domain:{c}": F.count_if(~F.coalesce(F.col(c).cast("string").isin(list(v)), F.lit(False))) for c, v in spec.domains.items() if c in d.columns}
    counts |= {f"rule:{k}": F.count_if(~F.coalesce(F.expr(r), F.lit(False))) for k, r in spec.rules.items()}
    parts = []
    if counts:
        one = d.agg(*[c.alias(k) for k, c in counts.items()])
        parts.append(one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").cast("long").alias("violations")) for k in counts]))))
    for keys in spec.unique:
        groups = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").agg(F.count(F.lit(1)).alias("violations"))
        parts.append(groups.select(F.lit("unique:" + ",".join(keys)).alias("check"), "violations"))
    if static:
        parts.append(spark.createDataFrame(static, "check string, violations long"))
    out = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "check string, violations long")
    return out.select(F.lit(spec.name).alias("table"), "check", "violations")


def check_release(tables: dict[str, DataFrame], specs: list[TableSpec]) -> DataFrame:
    """All tables' checks; a table that is missing is one violation."""
    spark = next(iter(tables.values())).sparkSession
    found = [check_table(tables[s.name], s) for s in specs if s.name in tables]
    absent = [(s.name, "missing table", 1) for s in specs if s.name not in tables]
    if absent:
        found.append(spark.createDataFrame(absent, "table string, check string, violations long"))
    return reduce(DataFrame.unionByName, found)


def verdicts(checks: DataFrame) -> DataFrame:
    """table, failed checks, status; and a row 'release' for all."""
    bad = F.count_if(F.col("violations") > 0).alias("failed")
    d = checks.rollup("table").agg(bad)
    return d.select(F.coalesce("table", F.lit("release")).alias("table"), "failed", F.when(F.col("failed") == 0, "pass").otherwise("failed").alias("status"))


def invalid_values(d: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """The distinct values outside a domain."""
    return d.filter(~F.coalesce(F.col(column).isin(domain), F.lit(False))).select(F.col(column).alias("value")).distinct()


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    lost = child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")


def ordered_faults(rows: DataFrame, group: str, index: str, start: str, end: str, tolerance: float = 1e-9) -> DataFrame:
    """Per group: indexes that are not 0, 1, .., gaps, overlaps and empty intervals."""
    w = Window.partitionBy(group).orderBy(index)
    d = rows.withColumn("place", F.row_number().over(w) - 1).withColumn("before", F.lag(end).over(w))
    return d.groupBy(group).agg(
        F.count_if(F.col(index) != F.col("place")).alias("misnumbered"), F.count_if(F.col(start) > F.col("before") + tolerance).alias("gaps"),
        F.count_if(F.col(start) < F.col("before") - tolerance).alias("overlaps"), F.count_if(F.col(end) <= F.col(start)).alias("empty"),
    )


def membership_faults(shots: DataFrame, scenes: DataFrame) -> DataFrame:
    """video_id, scene_index of scenes whose shot count, range or time does not follow from their shots.

    shots(video_id, scene_index, shot_index, start_sec, end_sec), scenes(video_id, scene_index, start_shot, end_shot, shot_count, start_sec, end_sec).
    """
    real = shots.groupBy("video_id", "scene_index").agg(F.count(F.lit(1)).alias("n"), F.min("shot_index").alias("lo"), F.max("shot_index").alias("hi"), F.min("start_sec").alias("s"), F.max("end_sec").alias("e"))
    d = scenes.join(real, ["video_id", "scene_index"], "full_outer")
    fine = (F.col("n") == F.col("shot_count")) & (F.col("lo") == F.col("start_shot")) & (F.col("hi") == F.col("end_shot")) & (F.abs(F.col("s") - F.col("start_sec")) < 1e-6) & (F.abs(F.col("e") - F.col("end_sec")) < 1e-6)
    return d.filter(~F.coalesce(fine & (F.col("hi") - F.col("lo") + 1 == F.col("n")), F.lit(False))).select("video_id", "scene_index")


def link_faults(stored: DataFrame, recomputed: DataFrame, keys: list[str], values: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Links that are stored and not found, found and not stored, or whose values differ."""
    b = recomputed.select(*keys, F.struct(*values).alias("found"))
    d = stored.select(*keys, F.struct(*values).alias("stored")).join(b, keys, "full_outer")
    off = reduce(lambda x, y: x | y, [F.abs(F.col(f"stored.{v}") - F.col(f"found.{v}")) > tolerance for v in values])
    why = F.when(F.col("found").isNull(), "unexpected").when(F.col("stored").isNull(), "missing").when(off, "different")
    return d.withColumn("fault", why).filter("fault IS NOT NULL").select(*keys, "fault")


def word_faults(segments: DataFrame, words: DataFrame) -> DataFrame:
    """Per segment: words outside it, misnumbered, overlapping, and whether they don't rebuild its text."""
    w = Window.partitionBy("segment_id").orderBy("word_index")
    d = words.withColumn("place", F.row_number().over(w) - 1).withColumn("before", F.lag("end_sec").over(w))
    d = d.join(segments.select("segment_id", F.col("start_sec").alias("s"), F.col("end_sec").alias("e"), F.col("text").alias("whole")), "segment_id")
    rebuilt = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_index", "text"))), lambda x: x["text"]), " ")
    return d.groupBy("segment_id").agg(
        F.count_if((F.col("start_sec") < F.col("s") - 1e-9) | (F.col("end_sec") > F.col("e") + 1e-9)).alias("outside"), F.count_if(F.col("word_index") != F.col("place")).alias("misnumbered"),
        F.count_if(F.col("start_sec") < F.col("before") - 1e-9).alias("overlapping"), (rebuilt != F.first("whole")).alias("text_differs"),
    )


def attribution_faults(words: DataFrame, assigned: DataFrame, key: str) -> DataFrame:
    """Words that are assigned never or more than once: key, times."""
    times = assigned.groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    return words.select(key).join(times, key, "left").select(key, F.coalesce("times", F.lit(0)).alias("times")).filter("times <> 1")


def incomplete_provenance(rows: DataFrame, group: str, field: str, wanted: list[str]) -> DataFrame:
    """Groups that lack a field: group, missing."""
    d = rows.groupBy(group).agg(F.collect_set(field).alias("has"))
    return d.select(group, F.array_sort(F.array_except(F.array(*[F.lit(w) for w in wanted]), "has")).alias("missing")).filter(F.size("missing") > 0)


def mismatched(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Keys whose value a on the left is not value b on the right."""
    return left.join(right, key).filter(~F.col(a).eqNullSafe(F.col(b))).select(key, a, b)


def hex_fingerprint(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def files_differ(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """path, fault: files missing, unlisted, or of another size or sha256."""
    d = manifest.select("path", F.col("size").alias("size_m"), F.col("sha256").alias("sha_m")).join(files.select("path", F.col("size").alias("size_f"), F.col("sha256").alias("sha_f")), "path", "full_outer")
    why = F.when(F.col("size_f").isNull(), "missing").when(F.col("size_m").isNull(), "unlisted").when(F.col("size_m") != F.col("size_f"), "size").when(F.col("sha_m") != F.col("sha_f"), "sha256")
    return d.withColumn("fault", why).filter("fault IS NOT NULL").select("path", "fault")


#: Partitions of the packages' rows. A given number is not joined by adaptive execution, which would fill a task up to 64 MB of compressed rows: twenty times that in its sorts. Up to 200, rows are written without being sorted in memory first.
PACKAGE_PARTS = 200

#: Invariants of a video's package, in the order of the report.
INVARIANTS = (
    "shot range is empty", "shot ranges are not contiguous", "shot times are not contiguous", "shot_index is not 0, 1, ..", "shot_id does not follow the order", "scene range is empty", "scene ranges are not contiguous", "scene times are not contiguous",
    "scene_index is not 0, 1, ..", "scene_id does not follow the order", "shot without one representative", "supplemental representative", "keyframe_id does not name its frame", "keyframe_id repeats", "text of an unknown keyframe", "shot without one caption",
    "scene without one summary", "scene mapping is incomplete", "scene does not count its shots", "scene range differs from its shots", "keyframe of an unknown shot", "keyframe outside its shot", "keyframe of another scene", "caption of another representative",
)


def package_invariants(shots: DataFrame, scenes: DataFrame, keyframes: DataFrame, texts: DataFrame, captions: DataFrame, summaries: DataFrame) -> DataFrame:
    """video_id, check, violations of INVARIANTS, all from one shuffle: the six tables are dealt together by video.

    shots(video_id, shot_index, shot_id, scene_id, start_frame, end_frame, start_sec, end_sec), scenes(video_id, scene_index,
    scene_id, shot_count, start_frame, end_frame, start_sec, end_sec), keyframes(video_id, keyframe_id, frame_id, shot_id,
    scene_id, role, is_representative), texts(video_id, keyframe_id), captions(video_id, shot_id, keyframe_id),
    summaries(video_id, scene_id). Windows and groups within a video keep that dealing, so nothing is dealt again.
    """
    fields = {"idx": "bigint", "scene": "string", "lo": "bigint", "hi": "bigint", "s": "double", "e": "double", "frame": "bigint", "kf": "string", "flag": "boolean", "extra": "boolean", "n": "bigint"}

    def rows(d: DataFrame, part: str, about: str, key: str, **given: Column | str) -> DataFrame:
        values = [(F.col(given[c]) if isinstance(given.get(c), str) else given.get(c, F.lit(None))).cast(kind).alias(c) for c, kind in fields.items()]
        return d.select("video_id", F.lit(part).alias("part"), F.lit(about).alias("about"), F.col(key).cast("string").alias("key"), *values)

    span = {"lo": "start_frame", "hi": "end_frame", "s": "start_sec", "e": "end_sec"}
    supplemental = F.col("is_representative") & (F.col("role") == "supplemental")
    parts = [
        rows(shots, "shot", "shot", "shot_id", idx="shot_index", scene="scene_id", **span), rows(shots, "member", "scene", "scene_id", **span), rows(scenes, "scene", "scene", "scene_id", idx="scene_index", n="shot_count", **span),
        rows(keyframes, "keyframe", "shot", "shot_id", frame="frame_id", kf="keyframe_id", scene="scene_id", flag="is_representative", extra=supplemental), rows(keyframes, "named", "keyframe", "keyframe_id", frame="frame_id", scene="scene_id"),
        rows(texts, "text", "keyframe", "keyframe_id"), rows(captions, "caption", "shot", "shot_id", kf="keyframe_id"), rows(summaries, "summary", "scene", "scene_id"),
    ]
    d = reduce(DataFrame.unionByName, parts).repartition(PACKAGE_PARTS, "video_id")
    order, group = Window.partitionBy("video_id", "part").orderBy("idx", "key"), Window.partitionBy("video_id", "about", "key")
    ordered = F.col("part").isin("shot", "scene")
    before = lambda c: F.lag(c).over(order)
    of = lambda part, c: F.max(F.when(F.col("part") == part, F.col(c))).over(group)
    d = d.withColumns({"place": F.row_number().over(order) - 1, "last": before("hi"), "last_e": before("e"), "shot_lo": of("shot", "lo"), "shot_hi": of("shot", "hi"), "shot_scene": of("shot", "scene")})
    canonical = F.concat("video_id", F.when(F.col("part") == "shot", "_SH").otherwise("_SC"), F.lpad(F.col("place").cast("string"), 5, "0"))
    is_ = lambda part: F.col("part") == part
    either = {}
    for part in ("shot", "scene"):
        either |= {
            f"{part} range is empty": is_(part) & ((F.col("hi") <= F.col("lo")) | ~F.coalesce(F.col("e") > F.col("s"), F.lit(False))), f"{part} ranges are not contiguous": is_(part) & (F.col("lo") != F.coalesce("last", F.lit(0))),
            f"{part} times are not contiguous": is_(part) & (F.abs(F.col("s") - F.col("last_e")) > 1e-9), f"{part}_index is not 0, 1, ..": is_(part) & (F.col("idx") != F.col("place")), f"{part}_id does not follow the order": is_(part) & (F.col("key") != canonical),
        }
    single = either | {
        "supplemental representative": F.col("extra"), "keyframe_id does not name its frame": is_("named") & (F.col("key") != F.concat_ws(":", "video_id", "frame")),
        "scene mapping is incomplete": is_("shot") & F.col("scene").isNull() | is_("named") & F.col("scene").isNull(), "keyframe of an unknown shot": is_("keyframe") & F.col("shot_lo").isNull(),
        "keyframe outside its shot": is_("keyframe") & ~F.col("frame").between(F.col("shot_lo"), F.col("shot_hi") - 1), "keyframe of another scene": is_("keyframe") & (F.col("scene") != F.col("shot_scene")),
    }
    count = lambda part: F.count_if(F.col("part") == part)
    some = lambda part, f, c: f(F.when(F.col("part") == part, F.col(c)))
    shot, scene, keyframe = (F.col("about") == x for x in ("shot", "scene", "keyframe"))
    real = {"shots": count("shot"), "scenes": count("scene"), "members": count("member"), "captions": count("caption"), "summaries": count("summary"), "names": count("named"), "texts": count("text"), "representatives": F.count_if(is_("keyframe") & F.col("flag"))}
    real |= {"chosen": F.max(F.when(is_("keyframe") & F.col("flag"), F.col("kf"))), "captioned": some("caption", F.max, "kf"), "said": some("scene", F.max, "n"), "lo": some("scene", F.min, "lo"), "hi": some("scene", F.max, "hi"), "lo_m": some("member", F.min, "lo"), "hi_m": some("member", F.max, "hi")}
    each = d.groupBy("video_id", "about", "key").agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in single.items()], *[c.alias(f"{k}_") for k, c in real.items()])
    c = lambda k: F.col(f"{k}_")
    whole = {
        "shot without one representative": shot & (c("shots") > 0) & (c("representatives") != 1), "keyframe_id repeats": keyframe & (c("names") > 1), "text of an unknown keyframe": keyframe & (c("texts") > 0) & (c("names") == 0),
        "shot without one caption": shot & ((c("shots") > 0) | (c("captions") > 0)) & ((c("captions") != 1) | (c("shots") == 0)), "scene without one summary": scene & ((c("scenes") > 0) | (c("summaries") > 0)) & ((c("summaries") != 1) | (c("scenes") == 0)),
        "scene does not count its shots": scene & F.col("key").isNotNull() & ((c("scenes") == 0) | (c("said") != c("members"))), "scene range differs from its shots": scene & (c("scenes") > 0) & ((c("lo") != c("lo_m")) | (c("hi") != c("hi_m"))),
        "caption of another representative": shot & (c("captioned") != c("chosen")),
    }
    sums = [(F.sum(f"`{k}`") if k in single else F.count_if(F.coalesce(whole[k], F.lit(False)))).alias(k) for k in INVARIANTS]
    found = each.groupBy("video_id").agg(*sums)
    named = F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("violations")) for k in INVARIANTS])
    return found.select("video_id", F.inline(F.filter(named, lambda x: x["violations"] > 0)))
