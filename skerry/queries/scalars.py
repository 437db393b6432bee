"""Scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.functions import scalars
from skerry.queries.base import query


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN '' ELSE '' END AS iso FROM orders""")
def publish_dates(t):
    d, n = F.col("o_orderdate"), F.col("o_orderkey") % 4
    raw = F.when(n == 0, F.date_format(d, "d/M/yyyy")).when(n == 1, F.date_format(d, "yyyy-MM-dd")).when(n == 2, "31/02/2024").otherwise(F.date_format(d, "yyyy.MM.dd"))
    return t("orders").select("o_orderkey", scalars.iso_or_empty(raw).alias("iso"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""")
def publish_dates_strict(t):
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(" ")
    return t("orders").select("o_orderkey", scalars.iso_or_error(raw).alias("iso"))


#: The value's pts in sixty-fourths of a second has no decimal tie at six digits.
@query("SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN greatest(0, floor(printf('%.5e', event_id / 64.0::DOUBLE)::DOUBLE * (24 + event_id % 7))::BIGINT) END AS frame, CASE WHEN event_id % 5 = 0 THEN 3 ELSE event_id END AS chosen FROM events")
def frame_math(t):
    fps = F.when(F.col("event_id") % 19 == 0, 0).otherwise(24 + F.col("event_id") % 7).cast("double")
    text = F.when(F.col("event_id") % 10 == 0, "-4").when(F.col("event_id") % 5 == 0, "x").otherwise(F.col("event_id").cast("string"))
    return t("events").select("event_id", scalars.frame_of(F.col("event_id") / 64, fps).alias("frame"), scalars.frame_or(text, F.lit(3)).alias("chosen"))


@query("""
    WITH x AS (SELECT event_id, event_id * 3.125::DOUBLE AS s, round_even(event_id * 3125.0::DOUBLE, 0)::BIGINT AS ms FROM events)
    SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000, ms % 1000) AS clock, printf('%02d:%02d', floor(s)::BIGINT // 60, floor(s)::BIGINT % 60) AS short FROM x""")
def timecodes(t):
    s = F.col("event_id") * 3.125
    return t("events").select("event_id", scalars.clock(s).alias("clock"), scalars.short_clock(s).alias("short"))


@query("""
    SELECT event_id, round(CASE event_id % 4 WHEN 0 THEN 30000 / 1001.0::DOUBLE WHEN 1 THEN NULL WHEN 2 THEN 25.0 ELSE NULL END::DOUBLE, 6) AS fps, CASE WHEN event_id % 2 = 0 THEN 1.5 ELSE event_id END::DOUBLE AS first FROM events""")
def rates(t):
    n = F.col("event_id")
    raw = F.when(n % 4 == 0, "30000/1001").when(n % 4 == 1, "0/0").when(n % 4 == 2, " 25 ").otherwise("abc")
    return t("events").select("event_id", F.round(scalars.rate(raw), 6).alias("fps"), scalars.first_number(F.lit("n/a"), F.when(n % 2 == 0, "1.5"), n).alias("first"))


@query("""
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN event_id + 1 WHEN 2 THEN round_even(event_id * 0.5::DOUBLE * 25, 0)::BIGINT END AS frames,
           CASE event_id % 4 WHEN 0 THEN 'container' WHEN 1 THEN 'timeline' WHEN 2 THEN 'duration_x_fps' ELSE 'unknown' END AS method, event_id % 4 = 2 AS estimated FROM events""")
def frame_counts(t):
    n = F.col("event_id")
    found = scalars.frame_count(F.when(n % 4 == 0, n), F.when(n % 4 == 1, n + 1), F.when(n % 4 == 2, n * 0.5), F.lit(25.0))
    return t("events").select("event_id", found.alias("f")).select("event_id", F.col("f.count").alias("frames"), "f.method", "f.estimated")


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN least(1.0, greatest(0.0, (event_id % 40 - 10) / 20.0::DOUBLE)) END AS confidence, least(1.0, event_id / 5000.0::DOUBLE) AS share FROM events")
def confidences(t):
    n = F.col("event_id")
    raw = F.when(n % 3 == 0, "none").otherwise(((n % 40 - 10) / 20).cast("string"))
    return t("events").select("event_id", scalars.confidence(raw).alias("confidence"), scalars.bounded_ratio(n, F.lit(5000.0)).alias("share"))


@query("""
    WITH x AS (SELECT vec_id, vec_id + (vec_id % 90 + 10) * 0.25::DOUBLE AS a, vec_id + (vec_id % 90 + 10) * 0.75::DOUBLE AS b FROM embeddings),
    y AS (SELECT DISTINCT vec_id, round_even(a + (b - a) * i / 4, 0)::BIGINT AS f FROM x, range(0, 5) AS r(i))
    SELECT vec_id, string_agg(f::VARCHAR, ',' ORDER BY f) AS frames FROM y GROUP BY vec_id""")
def ratio_bands(t):
    n = F.col("vec_id")
    return t("embeddings").select("vec_id", F.array_join(scalars.band(n, n + n % 90 + 10, 0.25, 0.75, 5).cast("array<string>"), ",").alias("frames"))


@query("""
    WITH g AS (SELECT c, r, row_number() OVER (ORDER BY c, r) AS place FROM range(1, 7) AS a(c), range(1, 7) AS b(r) WHERE c * r <= 6),
    x AS (SELECT vec_id, (vec_id * 37 % 1900 + 100)::DOUBLE / (vec_id * 91 % 1000 + 100) AS ratio FROM embeddings),
    y AS (SELECT vec_id, c, r, row_number() OVER (PARTITION BY vec_id ORDER BY abs(c / r::DOUBLE - ratio), c * r DESC, place) AS n FROM x, g)
    SELECT vec_id, c AS columns, r AS rows FROM y WHERE n = 1""")
def tile_grids(t):
    n = F.col("vec_id")
    return t("embeddings").select("vec_id", scalars.tile_grid(n * 37 % 1900 + 100, n * 91 % 1000 + 100, 6).alias("g")).select("vec_id", "g.columns", "g.rows")


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events")
def json_objects(t):
    raw = F.when(F.col("event_id") % 4 == 0, "no object").otherwise(F.concat(F.lit("Answer:\n"), F.col("props"), F.lit("\nend")))
    return t("events").select("event_id", scalars.lenient_json(raw, "k bigint").alias("j")).select("event_id", "j.k")


@query("""SELECT event_id, sha256('{"id":' || event_id::VARCHAR || ',"type":"' || event_type || '"}') AS fingerprint FROM events""")
def fingerprints(t):
    return t("events").select("event_id", scalars.fingerprint(F.col("event_id").alias("id"), F.col("event_type").alias("type")).alias("fingerprint"))


@query("""
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 7.0 WHEN 2 THEN event_id ELSE 1.0 END::DOUBLE AS cost,
           CASE event_id % 4 WHEN 0 THEN 'no_speech' WHEN 1 THEN 'no_speech' WHEN 2 THEN 'unavailable' ELSE CASE WHEN event_id % 3 > 0 THEN 'available' ELSE 'unavailable' END END AS speech,
           CASE WHEN event_id % 2 = 0 AND event_id % 3 = 0 THEN 'pass' WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN 'partial' ELSE 'failed' END AS probe,
           CASE event_id % 4 WHEN 0 THEN 'audio' ELSE 'visual' END AS relation FROM events""")
def statuses(t):
    n = F.col("event_id")
    return t("events").select(
        "event_id", scalars.cost(F.when(n % 4 == 0, "0").when(n % 4 == 1, ""), F.when(n % 4 == 1, "7").when(n % 4 == 2, n.cast("string"))).alias("cost"),
        scalars.speech_status(F.when(n % 4 == 0, "no_audio").when(n % 4 == 1, " no_speech").when(n % 4 == 2, "low_confidence").otherwise("pass"), n % 3).alias("speech"),
        scalars.probe_status(F.when(n % 2 == 0, n), F.when(n % 3 == 0, n)).alias("probe"), scalars.domain_value(F.when(n % 4 == 0, " Audio").otherwise("VISUAL"), ["audio", "visual"]).alias("relation"),
    )


@query("""
    WITH x AS (SELECT vec_id, [vec_id % 7, vec_id % 5, vec_id % 3] AS a, [0, vec_id % 4, vec_id % 2] AS b FROM embeddings),
    r AS (SELECT vec_id, unnest([a, b]) AS row FROM x), e AS (SELECT vec_id, row, list_transform(row, lambda x: exp((x - list_max(row))::DOUBLE)) AS e FROM r),
    p AS (SELECT vec_id, list_position(row, list_max(row)) = 1 AS blank, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e)
    SELECT vec_id, avg(blank::INT) AS blank_argmax_ratio, round(avg(list_max(p)), 6) AS mean_posterior, round(avg(-list_sum(list_transform(p, lambda x: x * ln(x))) / ln(3)), 6) AS normalized_entropy FROM p GROUP BY vec_id""")
def acoustic_metrics(t):
    n = F.col("vec_id")
    row = lambda *c: F.array(*[x.cast("double") for x in c])
    d = t("embeddings").select("vec_id", scalars.acoustic_metrics(F.array(row(n % 7, n % 5, n % 3), row(F.lit(0), n % 4, n % 2)), 0).alias("m")).select("vec_id", "m.*")
    return d.withColumns({c: F.round(c, 6) for c in ("mean_posterior", "normalized_entropy")})


@query("SELECT doc_id, array_to_string(list_transform(range(0, 4), lambda i: printf('%.6f', round(('0x' || sha256(doc_id::VARCHAR)[i * 2 + 1 : i * 2 + 2])::BIGINT / 255.0::DOUBLE, 6))), ',') AS vector FROM documents")
def mock_vectors(t):
    return t("documents").select("doc_id", F.array_join(F.transform(scalars.mock_vector(F.col("doc_id").cast("string")), lambda x: F.format_string("%.6f", x)), ",").alias("vector"))
