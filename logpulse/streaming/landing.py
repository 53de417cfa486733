"""Landed entries and the alert watcher: nothing is lost to a watermark.

* :func:`land_entries` - a stateless append stream: parsed entries go to
  Parquet partitioned by batch and date, with the level stored, so later
  analyses prune dates and push level filters. No state, so files may come in
  any order and any late. :func:`compact_landed` rewrites the many small files of
  past batches as one folder per date.
* :func:`watch_entries` - the alert state machine over any stream of entries
  (:mod:`logpulse.streaming.alert_state`): a batch costs what its own dates hold, a late
  row corrects its window, and alerts that do not hold any more are withdrawn.

Every write of a micro-batch has a path of its own, named after the checkpoint
folder and the batch number, or replaces whole dates, so a batch run again
after a failure leaves what one run leaves. Dates and windows belong to the
date of the window's start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.constants import HealthParams
from logpulse.session import shared_dir
from logpulse.sources.logs import ENTRY_COLUMNS
from logpulse.sources.published import publish, read_folder, read_published
from logpulse.streaming.alert_state import AlertState


def _batch_name(checkpoint: str, batch_id: int) -> str:
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:10]}-{batch_id:09d}"


def _entry_schema(entries: DataFrame, keys: Sequence[str]) -> T.StructType:
    fields = [entries.schema[c] for c in (*keys, *ENTRY_COLUMNS)]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields]
                        + [T.StructField("batch", T.StringType()), T.StructField("date", T.DateType())])


def _start(entries: DataFrame, checkpoint: str, interval: str | None, each_batch):
    writer = entries.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def _land(entries: DataFrame, landed: str, batch: str, keys: Sequence[str]) -> None:
    (entries.select(*keys, *ENTRY_COLUMNS, F.to_date("timestamp").alias("date"))
     .write.mode("overwrite").partitionBy("date").parquet(f"{landed}/batch={batch}"))


def land_entries(entries: DataFrame, landed: str | None = None, keys: Sequence[str] = (),
                 checkpoint: str | None = None, interval: str | None = None):
    """Start the stream that lands ``entries`` (streaming, of the entry shape,
    with ``keys`` if wanted). Returns (query, landed folder, checkpoint); read
    it with :func:`landed_entries`. ``interval`` None lands what is there and stops."""
    spark = entries.sparkSession
    checkpoint = checkpoint or shared_dir(spark, "streams", "landing-ckpt")
    landed = landed or shared_dir(spark, "streams", "landed")

    def each_batch(batch_df: DataFrame, batch_id: int) -> None:
        _land(batch_df, landed, _batch_name(checkpoint, batch_id), keys)

    return _start(entries, checkpoint, interval, each_batch), landed, checkpoint


def landed_entries(spark: SparkSession, landed: str, like: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The landed rows: keys, entry columns, ``batch`` and ``date``; types as in ``like``."""
    return read_folder(spark, landed, _entry_schema(like, keys))


def compact_landed(spark: SparkSession, landed: str, like: DataFrame, keys: Sequence[str] = (),
                   files_per_date: int = 1) -> int:
    """Publish the landed rows as one folder per date (``<landed>-dates``), a few files each, and return the
    publication's number; read them with :func:`compacted_entries`. The landed batches stay as they are."""
    rows = landed_entries(spark, landed, like, keys)
    spread = F.pmod(F.xxhash64("batch", "message"), F.lit(files_per_date))
    return publish(spark, f"{landed.rstrip('/')}-dates", {"entries": (
        lambda path: rows.repartition("date", spread).write.mode("overwrite").partitionBy("date").parquet(path))})


def compacted_entries(spark: SparkSession, landed: str, like: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of the last :func:`compact_landed`, pruned by ``date``."""
    return read_published(spark, f"{landed.rstrip('/')}-dates", "entries", _entry_schema(like, keys))


def watch_entries(entries: DataFrame, params: HealthParams = HealthParams(), keys: Sequence[str] = (),
                  interval: str | None = "300 seconds", output: str | None = None,
                  checkpoint: str | None = None, initial: str = "HEALTHY", lateness: str | None = None):
    """Start the alert watcher over streaming ``entries``. Returns (query,
    alert log folder, checkpoint folder); :func:`watcher_state` reads what holds.

    The state lies beside the checkpoint (``<checkpoint>-state``); it and the log
    belong to the checkpoint. Each batch scores every populated window of the dates it
    touches, the open one too, as the batch operators do."""
    spark = entries.sparkSession
    checkpoint = (checkpoint or shared_dir(spark, "streams", "watch-ckpt")).rstrip("/")
    output = output or shared_dir(spark, "streams", "alerts")
    schema = entries.select(*keys, *ENTRY_COLUMNS).schema

    def each_batch(batch_df: DataFrame, batch_id: int) -> None:
        AlertState(batch_df.sparkSession, f"{checkpoint}-state", output, schema, params, keys, initial,
                   lateness).apply(batch_df, batch_id)

    return _start(entries, checkpoint, interval, each_batch), output, checkpoint


def watcher_state(spark: SparkSession, output: str, checkpoint: str, like: DataFrame, params: HealthParams = HealthParams(),
                  keys: Sequence[str] = (), initial: str = "HEALTHY", lateness: str | None = None) -> AlertState:
    """The state that :func:`watch_entries` keeps, for reading: alerts that hold, windows, late rows."""
    schema = like.select(*keys, *ENTRY_COLUMNS).schema
    return AlertState(spark, f"{checkpoint.rstrip('/')}-state", output, schema, params, keys, initial, lateness)


def finished(query) -> None:
    """Wait for a run-once query; its failure is raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
