"""Sequential rules over the sorted rows of a group, streamed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def folded(rows: DataFrame, group: str, order: list[str], start: Callable[[], Any], step: Callable[[Any, Any], Any], result: str) -> DataFrame:
    """rows with a column more: what a sequential rule gives each row of a group, in order.

    start makes a group's state, step(state, row) changes it and gives the row's value. A group's rows stand sorted in one
    partition and stream through in Arrow batches, so neither a group nor a partition is ever held as a whole.
    """
    name, kind = result.split()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = object(), None
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                key = getattr(row, "group_")
                if key != at:
                    at, state = key, start()
                out.append(step(state, row))
            yield pdf.drop(columns="group_").assign(**{name: out})

    d = rows.withColumn("group_", F.coalesce(F.col(group).cast("string"), F.lit("\0")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    # by the new column: a repartition by one that rows are joined by counts as done, and the join may become a broadcast
    return d.repartition("group_").sortWithinPartitions("group_", *order).mapInPandas(run, f"{schema}, {name} {kind}")
