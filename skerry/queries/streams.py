"""Batch forms of the streaming operators; tests run the same functions on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.queries.base import query
from skerry.streaming import windows


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(t):
    d = windows.event_counts(t("events"))
    return d.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")).withColumn("total", F.round("total", 4))


@query("""
    WITH f AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM f)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS events FROM r GROUP BY user_id, s""")
def event_sessions(t):
    d = windows.sessions(t("events"))
    return d.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start", "end")})


@query("SELECT DISTINCT user_id, event_type FROM events")
def event_first_seen(t):
    return windows.first_seen(t("events"), ["user_id", "event_type"]).select("user_id", "event_type")
