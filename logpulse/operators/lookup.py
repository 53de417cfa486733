"""Lookups in tables of the user's own: a dimension join with a default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.operators.keys import join_on_keys

#: Tables of up to so many rows are broadcast; larger ones are joined as Spark plans it.
BROADCAST_ROWS = 100_000


def with_lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], value: str, into: str,
                default: Column | None = None) -> DataFrame:
    """``rows`` with ``into``: ``table``'s ``value`` for the row's ``on`` columns, else ``default``.

    Every row stays, once: null keys match null keys, of several entries for one key the smallest
    value counts, and a null value is as no entry."""
    one = table.groupBy(*on).agg(F.min(value).alias("_value")).where(F.col("_value").isNotNull())
    if one.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        one = F.broadcast(one)
    found = join_on_keys(rows, one, list(on), "left")
    return found.withColumn(into, F.coalesce("_value", default) if default is not None else F.col("_value")).drop("_value")
