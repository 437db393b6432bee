"""Readers and the stand-in views that map the retrieval data model onto the driver's tables.

A view's text is SQL that both Spark and DuckDB read, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS: dict[str, str] = {
    # one video per label; frames are numbered in it by vec_id
    "keyframes": """
        SELECT vec_id AS vector_id, concat('V', lpad(CAST(label AS STRING), 3, '0')) AS video_id,
               CASE WHEN label % 2 = 0 THEN 'L00' ELSE 'L01' END AS collection_id,
               CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) AS INT) AS keyframe_no,
               25 * vec_id + label AS frame_idx, CAST(vec_id AS DOUBLE) * 2.04 AS pts_time_sec, CAST(25 AS DOUBLE) AS fps, embedding
        FROM {embeddings}""",
    "videos": """
        SELECT DISTINCT concat('V', lpad(CAST(label AS STRING), 3, '0')) AS video_id, CASE WHEN label % 2 = 0 THEN 'L00' ELSE 'L01' END AS collection_id,
               n_name AS author, CASE WHEN label % 3 = 0 THEN '' ELSE concat('2024-0', CAST(label % 9 + 1 AS STRING), '-15') END AS publish_date_iso,
               concat('https://example.org/watch?v=', CAST(label AS STRING)) AS watch_url
        FROM {embeddings} JOIN {nation} ON n_nationkey = label""",
    "detections": """
        SELECT l_orderkey % 500 AS vector_id, l_linenumber AS rank, concat(l_returnflag, l_linestatus) AS entity, l_discount * 10 AS score
        FROM {lineitem}""",
    # per user one video; every event is a frame of it
    "timeline": """
        SELECT user_id AS video_id, event_id, event_type, value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_id,
               CAST(floor(value * 1000) AS BIGINT) AS value_ms
        FROM {events}""",
    # intervals of 10 frames, and words at frame positions
    "shots": """
        SELECT user_id AS video_id, CAST(floor(frame / 10) AS BIGINT) AS shot_index, min(frame) * 1.0 AS start_sec, max(frame) * 1.0 + 1.0 AS end_sec, count(*) AS frames
        FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM {events})
        GROUP BY user_id, floor(frame / 10)""",
    "segments": """
        SELECT user_id AS video_id, event_id AS segment_id, frame + 0.25 AS start_sec, frame + 0.25 + (CAST(floor(value) AS BIGINT) % 7) * 0.5 + 0.5 AS end_sec
        FROM (SELECT user_id, event_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) * 1.0 AS frame FROM {events})""",
}


def expand(text: str) -> str:
    """SQL text with {view} replaced by the view's own text in brackets and {table} by the table's name."""

    def put(m: re.Match) -> str:
        name = m[1]
        return f"({expand(VIEWS[name])}) AS {name}" if name in VIEWS else name

    return re.sub(r"\{([a-z]\w*)\}", put, text)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or a view of the directory."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needed = sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))
    return spark.sql(VIEWS[name], **{t: read(spark, sf_dir, t) for t in needed})
