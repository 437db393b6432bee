"""The registered queries: every operator applied to the driver's tables, with DuckDB SQL where SQL can express it."""

from skerry.queries import checking, evidences, grouping, ingests, intervals, invariants, ranking, records, releases, reviews, scalars, sequences, stored, streams, texts
from skerry.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "checking", "evidences", "grouping", "ingests", "intervals", "invariants", "ranking", "records", "releases", "reviews", "scalars", "sequences", "stored", "streams", "texts"]
