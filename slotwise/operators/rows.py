"""Putting one-row results next to each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Join aggregates of one row each into one row, by a union and an aggregate instead of a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def top(df: DataFrame, limit: int, *order) -> DataFrame:
    """The first `limit` rows in the given order, found without sorting the others.

    Spark moves a projection below the limit it follows. With a Python function in it, that separates the
    limit from its sort and turns a top-k into a full sort; coalesce keeps them together.
    """
    return df.orderBy(*order).limit(limit).coalesce(1)
