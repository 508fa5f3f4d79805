"""Costly expressions that must run once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` whose value the optimizer does not copy into later filters and projections.

    A later filter on a plain computed column is pushed below the projection together with a
    copy of the expression, which doubles the work of regular expressions and Python
    functions. A one-element ``explode`` is a boundary for such copies and nothing else:
    filters on other columns still pass it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
