"""Metadata and object filters, refinement of a result, facets, exclusion."""

from __future__ import annotations

import dataclasses
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions import text as texts


def iso_date(value: str | None, field: str) -> str | None:
    """A strict YYYY-MM-DD bound, or None if blank."""
    if not value:
        return None
    try:
        if date.fromisoformat(value).isoformat() != value:
            raise ValueError
    except ValueError:
        raise ValueError(f"{field} must be YYYY-MM-DD: {value!r}") from None
    return value


@dataclasses.dataclass(frozen=True)
class SearchFilters:
    collections: tuple[str, ...] = ()
    video_ids: tuple[str, ...] = ()
    video_id: str | None = None
    author: str | None = None
    date_from: str | None = None
    date_to: str | None = None
    entities: tuple[str, ...] = ()
    entity_mode: str = "any"
    minimum_score: float = 0.0

    @property
    def active(self) -> bool:
        return any((self.collections, self.videos, self.author, self.date_from, self.date_to, self.entities))

    @property
    def videos(self) -> list[str]:
        """Order-preserving union of video_ids and video_id."""
        return list(dict.fromkeys([*self.video_ids, *([self.video_id] if self.video_id else [])]))

    def predicate(self) -> Column:
        """All metadata conditions. Dates compare as strings: unknown ('') fails a lower bound and passes an upper one."""
        low, high = iso_date(self.date_from, "date_from"), iso_date(self.date_to, "date_to")
        if low and high and low > high:
            raise ValueError("date_from is after date_to")
        terms = []
        if self.collections:
            terms.append(F.col("collection_id").isin(list(self.collections)))
        if self.videos:
            terms.append(F.col("video_id").isin(self.videos))
        if self.author:
            terms.append(F.col("author") == self.author)
        if low:
            terms.append(F.col("publish_date_iso") >= low)
        if high:
            terms.append(F.col("publish_date_iso") <= high)
        return reduce(lambda a, b: a & b, terms, F.lit(True))


def having_any(rows: DataFrame, detections: DataFrame, key: str, entities: list[str], minimum: float) -> DataFrame:
    """Rows with a detection of one of the entities at the score or above."""
    return rows.join(detections.filter(F.col("entity").isin(entities) & (F.col("score") >= minimum)), key, "left_semi")


def having_all(rows: DataFrame, detections: DataFrame, key: str, entities: list[str], minimum: float) -> DataFrame:
    """Rows with detections of all distinct entities; partial sets of at most that many values are merged per key."""
    wanted = list(dict.fromkeys(entities))
    found = detections.filter(F.col("entity").isin(wanted) & (F.col("score") >= minimum)).groupBy(key).agg(F.countDistinct("entity").alias("found"))
    return rows.join(found.filter(F.col("found") == len(wanted)), key, "left_semi")


def eligible(keyframes: DataFrame, videos: DataFrame, detections: DataFrame, filters: SearchFilters) -> DataFrame:
    """Keyframes that satisfy every filter."""
    rows = keyframes.join(videos.drop("collection_id"), "video_id").filter(filters.predicate())
    if filters.entities:
        having = {"any": having_any, "all": having_all}[filters.entity_mode]
        rows = having(rows, detections, "vector_id", list(filters.entities), filters.minimum_score)
    return rows


#: The fields that "all" looks into, and the labels of those that hold numbers.
TEXT_FIELDS = ("keyframe_id", "video_id", "collection_id", "title", "author")
NUMBER_FIELDS = {"keyframe_no": "Keyframe No.", "frame_idx": "Frame Index"}


def matches_within(query: str, field: str, columns: list[str]) -> Column:
    """Find-in-results: substring without case in one text field or all; equality for the two numeric fields."""
    needle = query.strip()
    if not needle:
        return F.lit(True)
    if field in NUMBER_FIELDS:
        try:
            return F.col(field) == int(needle)
        except ValueError as e:
            raise ValueError(f"{NUMBER_FIELDS[field]} must be an integer") from e
    fields = [c for c in (*TEXT_FIELDS, *NUMBER_FIELDS) if c in columns] if field == "all" else [field]

    def shown(c: str) -> Column:
        # zero shows as nothing
        return F.when(F.col(c) == 0, "").otherwise(F.col(c).cast("string")) if c in NUMBER_FIELDS else F.coalesce(F.col(c), F.lit(""))

    return reduce(lambda a, b: a | b, [texts.folded(shown(c)).contains(texts.folded(F.lit(needle))) for c in fields])


def refine(rows: DataFrame, query: str = "", field: str = "all", collections=(), videos=(), authors=(), minimum_score: float | None = None) -> DataFrame:
    """Post-filter of a result."""
    keep = matches_within(query, field, rows.columns)
    for column, values in (("collection_id", collections), ("video_id", videos), ("author", authors)):
        if values:
            keep = keep & F.col(column).isin(list(values))
    if minimum_score is not None:
        keep = keep & (F.col("score") >= minimum_score)
    return rows.filter(keep)


def facets(rows: DataFrame, columns: list[str]) -> DataFrame:
    """facet, value: the distinct non-empty values of each column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).select("p.*").filter("value <> ''").distinct()


def excluded(rows: DataFrame, ids: DataFrame, key: str, hide: bool) -> DataFrame:
    """Rows without the excluded ones, or all rows with a mark."""
    if hide:
        return rows.join(ids.select(key), key, "left_anti")
    marks = ids.select(key).distinct().withColumn("excluded", F.lit(True))
    return rows.join(marks, key, "left").withColumn("excluded", F.coalesce("excluded", F.lit(False)))


def toggled(ids: DataFrame, change: DataFrame, key: str) -> DataFrame:
    """Symmetric difference of two id sets."""
    a, b = ids.select(key).distinct(), change.select(key).distinct()
    return a.join(b, key, "left_anti").unionByName(b.join(a, key, "left_anti"))


def first_pairs(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keep-first of each key in input order (order: the position column)."""
    best = rows.groupBy(*keys).agg(F.min(order).alias(order))
    return best
