"""Structured Streaming: watermarked window rates.

:func:`stream_window_rates` emits a window once, after the watermark passes its
end (append mode); state is the open windows only. Rows later than the
watermark are dropped by Spark, so it fits streams whose lateness is bounded;
:func:`run_to_parquet` raises when rows were dropped, or when there were too many
batches to tell, unless told that they may be. Files in any order, a file limit, or any lateness: use
:mod:`logpulse.streaming.landing`, which has no watermark and loses no row.

Watermarks need a TIMESTAMP column; entries carry TIMESTAMP_NTZ. The stream
edge converts NTZ (read as UTC) to an instant and back, independent of the
session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.functions.columns import is_error, to_instant, to_wall_clock
from logpulse.session import shared_dir


def stream_window_rates(entries: DataFrame, window: str = "5 minutes",
                        watermark: str = "10 minutes", keys: Sequence[str] = ()) -> DataFrame:
    """Streaming (or batch) entries -> (keys, window_start, window_end,
    total_entries, error_count, error_rate) with a watermark on ``timestamp``."""
    ts = entries.withColumn("_event_time", to_instant("timestamp"))
    w = F.window("_event_time", window)
    agg = (ts.withWatermark("_event_time", watermark)
           .groupBy(*keys, w.alias("w"))
           .agg(F.count(F.lit(1)).alias("total_entries"),
                F.count_if(is_error("level")).alias("error_count")))
    return agg.select(*keys,
                      to_wall_clock("w.start").alias("window_start"),
                      to_wall_clock("w.end").alias("window_end"),
                      "total_entries", "error_count",
                      (F.col("error_count") / F.col("total_entries")).alias("error_rate"))


def start_to_parquet(df: DataFrame, name: str, output_mode: str = "append",
                     checkpoint: str | None = None, output: str | None = None,
                     processing_time: str | None = None):
    """Start a streaming query into a Parquet file sink (exactly-once through
    the sink's commit log). ``processing_time`` (e.g. '300 seconds', the
    polling interval) runs it continuously; without it the query processes
    what is available and stops (``availableNow``, the run-once mode).

    Returns (query, output path, checkpoint path); paths default to fresh
    folders under the session's shared checkpoint location.
    """
    spark = df.sparkSession
    output = output or shared_dir(spark, "streams", f"{name}-out")
    checkpoint = checkpoint or shared_dir(spark, "streams", f"{name}-ckpt")
    writer = (df.writeStream.format("parquet").outputMode(output_mode)
              .option("path", output).option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start(), output, checkpoint


def dropped_late_rows(query) -> int:
    """Late rows the watermark dropped, as far as the query's kept progress
    tells (partially aggregated rows: a lower bound; zero only if none, while
    :func:`progress_is_whole`)."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))


def progress_is_whole(query, spark: SparkSession) -> bool:
    """Whether Spark surely still keeps the progress of every batch of this run."""
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    return len(query.recentProgress) < kept - 1  # Spark keeps one less than the setting


def run_to_parquet(df: DataFrame, name: str, output_mode: str = "append",
                   checkpoint: str | None = None, output: str | None = None,
                   allow_late: bool = False) -> tuple[str, str]:
    """Run-once form of :func:`start_to_parquet`: process the available input,
    wait, re-raise a failure; returns (output path, checkpoint path). Raises
    if late rows were dropped, or may have been in batches whose progress is no
    longer kept, unless ``allow_late``."""
    q, output, checkpoint = start_to_parquet(df, name, output_mode, checkpoint, output)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    late = dropped_late_rows(q)
    if late and not allow_late:
        raise RuntimeError(f"{late} or more rows came later than the watermark and are not in {output}; "
                           "land the entries instead (logpulse.streaming.landing)")
    if not allow_late and not progress_is_whole(q, df.sparkSession):
        raise RuntimeError(f"more batches than Spark keeps the progress of: rows later than the watermark may be "
                           f"missing in {output}; raise spark.sql.streaming.numRecentProgressUpdates or land the "
                           "entries instead (logpulse.streaming.landing)")
    return output, checkpoint
