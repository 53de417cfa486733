"""Joining per-key aggregates back onto keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with NULL matching NULL (a NULL key is a group
    like any other in ``groupBy``); the right side's key columns are dropped."""
    r = right.select(*[right[k].alias(f"_rk_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_rk_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])
