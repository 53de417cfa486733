"""Entry enrichment: hour of day, window floor and error flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logpulse.functions.columns import floor_time, is_error
from logpulse.session import shared_dir


def enrich_entries(entries: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Adds ``hour`` (0-23), ``minute_window`` (epoch-aligned floor) and
    ``is_error`` (non-null boolean). Narrow projection, no shuffle."""
    return entries.withColumns({
        "hour": F.hour("timestamp"),
        "minute_window": floor_time("timestamp", window),
        "is_error": is_error("level"),
    })


def sort_entries(entries: DataFrame) -> DataFrame:
    """Entries by timestamp, ties in file order (only when a caller needs
    an ordered result; no aggregate depends on it).

    Uses whichever of (file_path, file_block_start, line_seq) are present -
    see ``read_log_lines(with_position=True)``. A global sort: Spark samples
    the keys and range-partitions, so no task holds more than its range.
    """
    ties = [c for c in ("file_path", "file_block_start", "line_seq") if c in entries.columns]
    return entries.orderBy("timestamp", *ties)


def number_rows(rows: DataFrame, *order: str, name: str = "row_no", path: str | None = None) -> DataFrame:
    """``rows`` with their place in the total order by ``order`` (nulls first), from 1, without gaps.

    Rows are range-partitioned and sorted, so that no task holds more than its range, and written
    (to ``path``, default a new folder below the shared one); a row's number is its place
    in its partition and the rows of the partitions before. Equal rows may be numbered either
    way, so ``order`` should end in a column that tells rows apart."""
    spark = rows.sparkSession
    path = path or shared_dir(spark, "numbered", "rows")
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))  # the partition, and the place in it
    placed.write.mode("overwrite").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = parts.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")  # a row a partition
                                    - F.col("_first") + 1).alias("_shift"))
    return (placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_at") + F.col("_shift"))
            .drop("_part", "_at", "_shift"))


def number_entries(entries: DataFrame) -> DataFrame:
    """Entries with ``row_no``, their number by timestamp and then place in the files
    (``read_log_lines(with_position=True)``)."""
    ties = [c for c in ("file_path", "file_block_start", "line_seq") if c in entries.columns]
    return number_rows(entries, "timestamp", *ties)
