"""One-row results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames with different columns into one row.

    A union and a global aggregate, so that independent aggregates run in one query without
    a product of the frames.
    """
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])
