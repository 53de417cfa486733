"""The alert state machine over micro-batches, with work that follows the batch and not the history.

:class:`AlertState` keeps, below one folder,

* ``windows`` - per date, entries and errors by (keys, window, error prefix): what the
  windows' rates and top errors are rolled up from. A batch adds its own counts to the
  dates it touches and replaces those dates; raw entries are not kept and not read again.
* ``days`` - per (keys, date), the first window and the status after the last one: where the
  first window of the next date takes its previous status from. One row a key and date.
* ``clock`` - the latest timestamp seen, from which late rows are told.
* ``late`` - rows that came more than ``lateness`` behind that timestamp, as they came, if
  asked for. They count in their windows all the same.
* the alert log - rows of inserted, updated and withdrawn alerts per batch, written only by
  batches that change an alert. A late row that turns a window back withdraws the
  window's alert, and the alert after it where the previous status is another one then;
  :func:`current_alerts` gives what holds, equal to the batch operator over all rows.

A batch scores the windows of the dates it touches and, where a date ends with another
status than before, the first window of the key's next date: no other alert can change,
as a window's status is its own and an alert compares it with the window before.

Every batch has a version number. Its reads leave out what its own version wrote and its
writes replace that, so a batch that is run again leaves what one run leaves. Nothing
is held by one task: windows are aggregated with partial sums, and only dates and
(key, date) rows are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.constants import HealthParams
from logpulse.functions.columns import duration_micros
from logpulse.operators.keys import join_on_keys
from logpulse.operators.status import alert_events, rates_from_prefix_counts, window_prefix_counts
from logpulse.operators.windows import status_from_rates
from logpulse.sources.published import DatedTable, read_folder

INSERT, UPDATE, WITHDRAW = "insert", "update", "withdraw"

_EPOCH = date(1970, 1, 1)
_CLOCK = T.StructType([T.StructField("latest", T.TimestampNTZType()), T.StructField("date", T.DateType())])


def current_alerts(spark: SparkSession, log: str, schema: T.StructType, keys: Sequence[str] = (),
                   before: int | None = None) -> DataFrame:
    """The alerts that hold: the last row of each (keys, window, change) of the log, unless withdrawn."""
    rows = read_folder(spark, log, schema)
    if before is not None:
        rows = rows.where(F.col("version") < before)
    same = [*keys, "window_start", "prev_status", "status"]
    rest = [c for c in schema.names if c not in same]
    last = rows.groupBy(*same).agg(F.max_by(F.struct(*rest), "version").alias("r"))
    return last.where(F.col("r.op") != WITHDRAW).select(*same, *[F.col(f"r.{c}").alias(c) for c in rest])


class AlertState:
    def __init__(self, spark: SparkSession, folder: str, log: str, entry_schema: T.StructType,
                 params: HealthParams = HealthParams(), keys: Sequence[str] = (), initial: str = "HEALTHY",
                 lateness: str | None = None) -> None:
        """``folder`` and ``log`` belong together; ``entry_schema`` types the keys and the entry columns.

        ``lateness`` (say "2 hours") turns the output of late rows on."""
        self.spark, self.folder, self.log = spark, folder.rstrip("/"), log.rstrip("/")
        self.params, self.keys, self.initial, self.lateness = params, list(keys), initial, lateness
        none = spark.createDataFrame([], entry_schema)
        counts = self._counts(none)
        self.entry_schema = none.select(*self.keys, "timestamp", "level", "logger", "message").schema
        self.windows = DatedTable(spark, f"{self.folder}/windows", counts.schema)
        self.days = DatedTable(spark, f"{self.folder}/days", self._day_ends(self._scored(counts)).schema)
        self.clock = DatedTable(spark, f"{self.folder}/clock", _CLOCK)
        alerts = self._alerts(self._scored(counts), self._day_ends(self._scored(counts)))
        self.log_schema = T.StructType([f for f in alerts.schema.fields if f.name != "date"] + [
            T.StructField("op", T.StringType()), T.StructField("version", T.LongType()), T.StructField("date", T.DateType())])

    # ---- what the tables hold ------------------------------------------------

    def _counts(self, entries: DataFrame, seen: bool = False) -> DataFrame:
        counts = window_prefix_counts(entries.where(F.col("timestamp").isNotNull()), self.params, self.keys, seen)
        return counts.withColumn("date", F.to_date("window_start"))

    def _scored(self, counts: DataFrame) -> DataFrame:
        """Window rows (rates, top error, status) of base counts."""
        rates = rates_from_prefix_counts(counts.drop("date"), self.params, self.keys)
        return status_from_rates(rates, self.params).withColumn("date", F.to_date("window_start"))

    def _day_ends(self, scored: DataFrame) -> DataFrame:
        return scored.groupBy(*self.keys, "date").agg(
            F.min("window_start").alias("first_window"), F.max_by("status", "window_start").alias("last_status"))

    def _alerts(self, scored: DataFrame, before: DataFrame) -> DataFrame:
        """Alerts of window rows; ``before`` has (keys, date, last_status): the status a date begins after."""
        within = Window.partitionBy(*self.keys, "date").orderBy("window_start")
        lagged = scored.withColumn("_prev", F.lag("status").over(within))
        carried = before.select(*self.keys, "date", F.col("last_status").alias("_carried"))
        rows = join_on_keys(lagged, carried, [*self.keys, "date"], "left").withColumn(
            "prev_status", F.coalesce("_prev", "_carried", F.lit(self.initial)))
        changed = rows.where(F.col("prev_status") != F.col("status")).drop("_prev", "_carried")
        return alert_events(changed, self.params, self.keys)

    # ---- a batch ---------------------------------------------------------------

    def apply(self, entries: DataFrame, version: int) -> None:
        """Take a batch of entries as version number ``version`` (growing; the same again after a failure)."""
        spark, keys = self.spark, self.keys
        added = self._written(self._counts(entries, seen=True), "added", version)
        if self.lateness is not None:
            self._split_late(entries, added.agg(F.max("seen")).first()[0], version)
        added = added.drop("seen")
        dates = sorted(r[0] for r in added.select("date").distinct().collect())  # one value a date of the batch
        if not dates:
            return self._write_log(spark.createDataFrame([], self.log_schema), version)
        own = [*keys, "window_start", "p", "date"]
        both = self.windows.read(version, dates).unionByName(added)
        total = both.groupBy(*own).agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
        self.windows.replace(total, version, dates)
        scored = self._written(self._scored(self.windows.read(version + 1, dates)), "scored", version)

        # read before its turn is replaced
        old_days = self._written(self.days.read(version, dates), "days_before", version)
        ends = self._day_ends(scored)
        self.days.replace(ends, version, dates)
        days = self.days.read(version + 1)
        along = Window.partitionBy(*keys).orderBy("date")  # a row a date and key
        chain = days.select(*keys, "date", "first_window", F.lag("last_status").over(along).alias("last_status"),
                            F.lag("date").over(along).alias("after"))
        touched = F.col("date").isin([F.lit(d) for d in dates])
        was = old_days.select(*keys, F.col("date").alias("after"), F.col("last_status").alias("_was"))
        now = ends.select(*keys, F.col("date").alias("after"), F.col("last_status").alias("_now"))
        turned = join_on_keys(now, was, [*keys, "after"], "left").where(~F.col("_was").eqNullSafe(F.col("_now")))
        heirs = self._written(join_on_keys(chain.where(~touched & F.col("after").isNotNull()), turned.select(*keys, "after"),
                                           [*keys, "after"]).select(*keys, "date", "first_window", "last_status"),
                              "heirs", version)
        before = chain.select(*keys, "date", "last_status")
        new = self._alerts(scored, before)
        scope = touched
        later = sorted(r[0] for r in heirs.select("date").distinct().collect())
        if later:
            first = self._scored(self.windows.read(version + 1, later))
            first = join_on_keys(first, heirs.select(*keys, F.col("first_window").alias("window_start")), [*keys, "window_start"])
            new = new.unionByName(self._alerts(first, before))
        active = current_alerts(spark, self.log, self.log_schema, keys, version)
        in_scope = active.where(scope)
        if later:
            in_scope = in_scope.unionByName(join_on_keys(active.where(~scope), heirs.select(
                *keys, F.col("first_window").alias("window_start")), [*keys, "window_start"]))
        self._write_log(self._changes(new, in_scope), version)

    def _changes(self, new: DataFrame, old: DataFrame) -> DataFrame:
        """Rows for the log: what of ``new`` is not in ``old`` or is there with other numbers, and what of ``old`` is void."""
        same = [*self.keys, "window_start", "prev_status", "status"]
        content = [c for c in self.log_schema.names if c not in (*same, "op", "version", "date")]
        pack = lambda df, name: df.select(*same, "date", F.struct(*content).alias(name))
        a = pack(new, "_new")
        b = pack(old, "_old").select(*[F.col(c).alias(f"_o_{c}") for c in same], F.col("date").alias("_o_date"), "_old")
        both = a.join(b, [a[c].eqNullSafe(b[f"_o_{c}"]) for c in same], "full")
        op = (F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNull(), WITHDRAW)
              .when(F.to_json("_new") != F.to_json("_old"), UPDATE))
        pick = F.col("_new").isNotNull()
        rows = both.withColumn("op", op).where(F.col("op").isNotNull())
        return rows.select(*[F.when(pick, F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in same],
                           F.when(pick, F.col("date")).otherwise(F.col("_o_date")).alias("date"),
                           F.coalesce("_new", "_old").alias("r"), "op").select(*same, "r.*", "op", "date")

    def _write_log(self, rows: DataFrame, version: int) -> None:
        path = f"{self.log}/version={version}"
        schema = T.StructType([f for f in self.log_schema.fields if f.name != "version"])
        rows = rows.select(*schema.names)
        staged = self._written(rows, "changes", version)
        earlier = read_folder(self.spark, path, schema)
        if not (staged.isEmpty() and earlier.isEmpty()):  # a failed run of this version may have left rows
            staged.write.mode("overwrite").partitionBy("date").parquet(path)

    def _written(self, df: DataFrame, name: str, version: int) -> DataFrame:
        path = f"{self.folder}/{name}/turn={version % 2}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- late rows ---------------------------------------------------------------

    def _split_late(self, entries: DataFrame, here, version: int) -> None:
        latest = self.clock.read(version).agg(F.max("latest")).first()[0]
        if latest is not None:
            limit = F.timestamp_add("MICROSECOND", F.lit(-duration_micros(self.lateness)), F.lit(latest))
            late = entries.where(F.col("timestamp") < limit).select(*self.entry_schema.names)
            late.write.mode("overwrite").parquet(f"{self.folder}/late/version={version}")
        if here is not None and (latest is None or here > latest):
            self.clock.replace(self.spark.createDataFrame([(here, _EPOCH)], _CLOCK), version, [_EPOCH])

    # ---- what holds ----------------------------------------------------------------

    def alerts(self) -> DataFrame:
        """The alerts that hold, as the batch operator gives them over all rows so far."""
        names = [c for c in self.log_schema.names if c not in ("op", "version", "date")]
        return current_alerts(self.spark, self.log, self.log_schema, self.keys).select(*names)

    def window_rates(self) -> DataFrame:
        """Every populated window so far, late rows counted."""
        return self._scored(self.windows.read()).drop("date", "status")

    def late_rows(self) -> DataFrame:
        """Entries that came more than ``lateness`` behind, in batches after the first, with their ``version``."""
        schema = T.StructType([*self.entry_schema.fields, T.StructField("version", T.LongType())])
        return read_folder(self.spark, f"{self.folder}/late", schema)
