"""Most frequent error prefixes (and the same ranking on any text column).

Counting is a ``groupBy(prefix)`` with map-side partial aggregation, so a
prefix holding most of the errors is merged per task before the shuffle.
The ranking is a top-n: unkeyed it plans as ``TakeOrderedAndProject`` (each
task keeps n rows, the merge sees n x tasks rows); keyed, it runs in two
window passes, the first over (key, salt) buckets, so a key with a huge
number of distinct prefixes is ranked by many tasks, not one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logpulse.functions.columns import is_error, message_prefix
from logpulse.operators.keys import join_on_keys

RANK_SALT_BUCKETS = 64


def _rank_top(grouped: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """Top ``n`` non-NULL prefixes per key of a (keys, prefix, count) frame.

    The NULL-prefix group stays in ``grouped`` (its count belongs in the
    totals) and is ordered last, then dropped after ranking; filtering it
    before would be pushed below the aggregate and give the totals a
    different plan than the ranking, defeating exchange reuse.
    """
    order = [F.col("prefix").isNull().asc(), F.col("count").desc(), F.col("prefix").asc()]
    if not keys:
        top = grouped.orderBy(*order).limit(n).where(F.col("prefix").isNotNull())
        # at most n rows reach this window
        return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    salt = (F.xxhash64("prefix") % RANK_SALT_BUCKETS).alias("salt")
    stage1 = (grouped.withColumn("salt", salt)
              .withColumn("r1", F.row_number().over(
                  Window.partitionBy(*keys, "salt").orderBy(*order)))
              .where((F.col("r1") <= n) & F.col("prefix").isNotNull()).drop("r1", "salt"))
    return (stage1.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .where(F.col("rank") <= n))


def top_prefixes(df: DataFrame, text_col: str = "text", n: int = 10,
                 prefix_length: int = 60, keys: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` first-``prefix_length``-code-point prefixes of ``text_col``:
    (keys, rank, prefix, count, share); ties by prefix ascending; share is of
    all rows (NULL texts count in the total but form no ranked group).

    The total is summed from the same grouped aggregate (scalar subquery
    unkeyed, join on keys otherwise), so the source is scanned once and the
    shuffle is reused.
    """
    grouped = (df.select(*keys, message_prefix(text_col, prefix_length).alias("prefix"))
               .groupBy(*keys, "prefix").agg(F.count(F.lit(1)).alias("count")))
    ranked = _rank_top(grouped, n, keys)
    if keys:
        totals = grouped.groupBy(*keys).agg(F.sum("count").alias("_total"))
        ranked = join_on_keys(ranked, totals, keys)
        total = F.col("_total")
    else:
        total = grouped.agg(F.sum("count")).scalar()
    return ranked.select(*keys, "rank", "prefix", "count",
                         (F.col("count") / total).alias("share"))


def top_errors(entries: DataFrame, n: int = 10, prefix_length: int = 60,
               keys: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` ERROR/CRITICAL message prefixes:
    (keys, rank, message_prefix, count, pct_of_errors), where the share is of
    **all** errors, not of the top n."""
    errors = entries.where(is_error("level"))
    return (top_prefixes(errors, "message", n, prefix_length, keys)
            .withColumnRenamed("prefix", "message_prefix")
            .withColumnRenamed("share", "pct_of_errors"))
