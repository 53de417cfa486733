"""Connected components of a link table by alternating stars.

Each round hangs every node's larger neighbours on its smallest neighbour,
then the smaller ones; the table shrinks to stars in a logarithmic number of
rounds. Every round is written to the shared folder; only a row count and a
checksum reach the driver. A hub's rows are pre-aggregated before the
shuffle (``min``) and its join side may be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"),
                F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (u, v): each linked node u other than its component's
    smallest node v, once. Nodes of any orderable type; self-links and
    repeated links are ignored; no links give no rows."""
    e = written(links.where("a != b").select(F.greatest("a", "b").alias("u"),
                                             F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            return e
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m")))
                         .alias("p")).select(F.col("p.v").alias("u"), F.col("p.m").alias("v"))
                 .where("u != v").distinct())
        e = written(small, "links")
        before, state = state, _state(e)
        if state == before:
            return e
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
