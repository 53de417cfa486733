"""Status layer: time range, overall health, worst spike, recommendations,
status transitions, incidents and alert events.

Inputs here are already aggregated (spikes or per-window status rows), so
they are bounded by keys x windows. Ordered computations over window rows
(previous status, run numbering) run inside (keys, time bucket) partitions
with a carry-in from earlier buckets, so neither the unkeyed case nor a hot
key lands in one task; window functions never run over raw entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logpulse.constants import (
    ERROR_COUNT_LABEL,
    ERROR_RATE_LABEL,
    REASON_CRITICAL,
    REASON_HEALTHY,
    REASON_WARNING,
    SPIKE_ADVICE,
    STATUS_RANK,
    THRESHOLD_NOTE,
    TITLE_JOINT,
    TOP_ERROR_ADVICE,
    TOP_ERROR_LABEL,
    WORST_WINDOW_LABEL,
    HealthParams,
)
from logpulse.functions.columns import (
    add_duration,
    covered_hours,
    duration_micros,
    epoch_micros,
    epoch_seconds,
    floor_time,
    is_error,
    message_prefix,
    minute_text,
    percent_text,
    second_text,
    status_colour,
    status_emoji,
    transition_text,
)
from logpulse.operators.keys import join_on_keys
from logpulse.operators.lookup import with_lookup
from logpulse.operators.windows import status_from_rates


def time_range(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, first_ts, last_ts, start, end, hours_analysed); start/end are
    'yyyy-MM-dd HH:mm' text; hours = max(1, whole hours covered)."""
    return (entries.groupBy(*keys)
            .agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
            .select(*keys, "first_ts", "last_ts",
                    minute_text("first_ts").alias("start"), minute_text("last_ts").alias("end"),
                    covered_hours("first_ts", "last_ts").alias("hours_analysed")))


def fmt_template(template: str, **fields) -> str:
    """A ``format_string`` pattern from a ``{field}`` template: literal ``%``
    doubled, fields replaced by the given conversions."""
    return template.replace("%", "%%").format(**fields)


def _pct(x: float) -> int:
    return round(x * 100)


def status_reason(status: Column, n_spikes: Column, p: HealthParams) -> Column:
    warning = fmt_template(REASON_WARNING, n="%d", threshold_pct=_pct(p.error_rate_threshold))
    return (F.when(status == "CRITICAL", F.lit(REASON_CRITICAL.format(critical_pct=_pct(p.critical_rate))))
            .when(status == "WARNING", F.format_string(warning, n_spikes))
            .otherwise(F.lit(REASON_HEALTHY)))


def status_from_spike_counts(n_spikes: Column, n_critical: Column) -> Column:
    return (F.when(n_critical > 0, "CRITICAL").when(n_spikes > 0, "WARNING")
            .otherwise("HEALTHY"))


def health_status(spikes: DataFrame, params: HealthParams = HealthParams(),
                  keys: Sequence[str] = (), known_keys: DataFrame | None = None) -> DataFrame:
    """CRITICAL if any critical spike, WARNING if any spike, else HEALTHY.

    Unkeyed, always one row (a global aggregate over zero spikes still yields
    a row). Keyed, a key without spikes has a HEALTHY row if it is among
    ``known_keys`` (any frame with the key columns, such as the window rates).
    """
    counted = spikes.select(*keys, F.lit(1).alias("spike"), "severity")
    if keys and known_keys is not None:
        counted = counted.unionByName(known_keys.select(*keys).distinct().select(
            *keys, F.lit(0).alias("spike"), F.lit(None).cast("string").alias("severity")))
    agg = counted.groupBy(*keys).agg(
        F.count_if(F.col("spike") == 1).alias("spike_count"),
        F.count_if(F.col("severity") == "critical").alias("critical_spike_count"))
    status = status_from_spike_counts(F.col("spike_count"), F.col("critical_spike_count"))
    return agg.select(*keys, status.alias("status"),
                      status_reason(status, F.col("spike_count"), params).alias("status_reason"),
                      "spike_count", "critical_spike_count")


def worst_spike(spikes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Highest-rate spike (earliest window on ties); no row without spikes."""
    if not keys:  # top-1: TakeOrderedAndProject, no row when there is no spike
        return spikes.orderBy(F.col("error_rate").desc(), F.col("window_start").asc()).limit(1)
    cols = [c for c in spikes.columns if c not in keys]
    # per key: rate desc, then window asc -> max of (rate, -epoch)
    order = F.struct(F.col("error_rate"), (-epoch_micros("window_start")).alias("neg_us"))
    best = spikes.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("s"))
    return best.select(*keys, "s.*")


def spike_advice_text(width: str) -> Column:
    tmpl = fmt_template(SPIKE_ADVICE, window="%s", errors="%d", width=width.replace("%", "%%"),
                        pct="%s")
    return F.format_string(tmpl, second_text("window_start"), F.col("error_count"),
                           percent_text("error_rate"))


def top_error_advice_text() -> Column:
    tmpl = fmt_template(TOP_ERROR_ADVICE, prefix="%s", count="%d")
    return F.format_string(tmpl, F.col("message_prefix"), F.col("count"))


def spike_recommendations(spikes: DataFrame, top_errors: DataFrame,
                          params: HealthParams = HealthParams()) -> DataFrame:
    """(rec_no, recommendation): advice for the ``spike_advice_n`` highest-rate
    spikes (earliest window first on ties), then one line for the top error.

    Both inputs are bounded by a top-n before anything is numbered.
    """
    n = params.spike_advice_n
    order = [F.col("error_rate").desc(), F.col("window_start").asc()]
    spike_recs = (spikes.orderBy(*order).limit(n)
                  .select(F.row_number().over(Window.orderBy(*order)).alias("rec_no"),
                          spike_advice_text(params.window).alias("recommendation")))
    n_spike_recs = spikes.select(F.least(F.count(F.lit(1)), F.lit(n))).scalar()
    top = (top_errors.where(F.col("rank") == 1)
           .select((n_spike_recs + 1).cast("int").alias("rec_no"),
                   top_error_advice_text().alias("recommendation")))
    return spike_recs.unionByName(top)


SCAN_BUCKET = "7 days"


def _bucketed_lag(df: DataFrame, keys: Sequence[str], lag_cols: dict[str, str],
                  bucket: str = SCAN_BUCKET) -> DataFrame:
    """Previous-row values (``lag_cols``: source -> output) per key ordered by
    window_start, without putting a whole key - or, unkeyed, the whole
    table - into one task.

    Rows are ordered inside (keys, time bucket) partitions; the last row of
    each bucket (``lead`` is NULL) feeds a small window over buckets that
    hands its values to the next bucket's first row, joined back on
    (keys, bucket). No aggregate, no extra shuffle of the window rows; AQE
    picks the join strategy from the carry table's measured size.
    """
    bsecs = duration_micros(bucket) // 1_000_000
    ws = "window_start"
    w_in = Window.partitionBy(*keys, "_b").orderBy(ws)
    inner = (df.withColumn("_b", F.floor(epoch_seconds(ws) / F.lit(bsecs)))
             .withColumns({**{f"_lag_{c}": F.lag(c).over(w_in) for c in lag_cols},
                           "_is_last": F.lead(ws).over(w_in).isNull()}))
    w_b = Window.partitionBy(*keys).orderBy("_b")
    carry = (inner.where(F.col("_is_last"))
             .select(*keys, "_b", *[F.lag(c).over(w_b).alias(f"_carry_{c}") for c in lag_cols]))
    out = join_on_keys(inner, carry, [*keys, "_b"]).withColumns(
        {o: F.coalesce(F.col(f"_lag_{c}"), F.col(f"_carry_{c}")) for c, o in lag_cols.items()})
    return out.drop("_b", "_is_last", *[f"_lag_{c}" for c in lag_cols], *[f"_carry_{c}" for c in lag_cols])


def status_transitions(window_status: DataFrame, keys: Sequence[str] = (),
                       initial: str = "HEALTHY", bucket: str = SCAN_BUCKET) -> DataFrame:
    """Windows whose status differs from the previous populated window's
    (the first window compares with ``initial``): alert de-duplication.
    The previous status comes from :func:`_bucketed_lag`, so no task holds
    more than one key's windows of one time bucket."""
    cols = [c for c in window_status.columns if c not in (*keys, "window_start", "status")]
    scanned = _bucketed_lag(window_status, keys, {"status": "_prev"}, bucket)
    return (scanned.withColumn("prev_status", F.coalesce(F.col("_prev"), F.lit(initial)))
            .where(F.col("prev_status") != F.col("status"))
            .select(*keys, "window_start", "prev_status", "status", *cols))


def incidents(window_status: DataFrame, keys: Sequence[str] = (),
              max_gap: str | None = None, bucket: str = SCAN_BUCKET) -> DataFrame:
    """Runs of consecutive non-HEALTHY windows collapsed to one row
    (gaps and islands). Consecutive = adjacent populated windows; with
    ``max_gap`` a larger gap between window starts also splits a run.

    (keys, incident_no, first_window, last_window, n_windows, total_entries,
    error_count, peak_error_rate, worst_status); ``incident_no`` counts the
    runs per key in time order.

    One pass inside (keys, time bucket) partitions marks run starts assuming
    an unknown predecessor for the bucket's first row and keeps a running
    count; the bucket's last row (its summary) then corrects that first row
    with the last window of the previous bucket (``_fix`` is 0 or -1) and
    adds the count of earlier buckets - a small window over buckets, joined
    back. No aggregate and no extra shuffle of the window rows.
    """
    ws = "window_start"
    gap_us = duration_micros(max_gap) if max_gap is not None else None

    def starts(is_bad, prev_bad, cur_ws, prev_ws):
        cond = ~F.coalesce(prev_bad, F.lit(False))
        if gap_us is not None:
            gap = epoch_micros(cur_ws) - epoch_micros(prev_ws)
            cond = cond | F.coalesce(gap > gap_us, F.lit(False))
        return is_bad & cond

    bsecs = duration_micros(bucket) // 1_000_000
    df = window_status.withColumns({
        "_b": F.floor(epoch_seconds(ws) / F.lit(bsecs)),
        "_bad": F.col("status") != "HEALTHY",
    })
    w_in = Window.partitionBy(*keys, "_b").orderBy(ws)
    whole = w_in.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inner = (df.withColumn("_s", starts(F.col("_bad"), F.lag("_bad").over(w_in),
                                        F.col(ws), F.lag(ws).over(w_in)).cast("bigint"))
             .withColumns({"_run": F.sum("_s").over(w_in.rowsBetween(Window.unboundedPreceding, 0)),
                           "_is_last": F.lead(ws).over(w_in).isNull(),
                           "_first_bad": F.first("_bad").over(whole),
                           "_first_ws": F.first(ws).over(whole)}))
    # the last row of each bucket summarises it: its run count is the bucket total
    w_b = Window.partitionBy(*keys).orderBy("_b")
    last = inner.where(F.col("_is_last")).select(
        *keys, "_b", "_first_bad", "_first_ws", F.col("_run").alias("_tot"),
        F.lag("_bad").over(w_b).alias("_carry_bad"), F.lag(ws).over(w_b).alias("_carry_ws"))
    true_first = starts(F.col("_first_bad"), F.col("_carry_bad"), F.col("_first_ws"), F.col("_carry_ws"))
    last = last.withColumn("_fix", true_first.cast("bigint") - F.col("_first_bad").cast("bigint"))
    carry = last.select(
        *keys, "_b", "_fix",
        F.coalesce(F.sum(F.col("_tot") + F.col("_fix")).over(w_b.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    numbered = (join_on_keys(inner.drop("_first_bad", "_first_ws", "_is_last"), carry, [*keys, "_b"])
                .withColumn("incident_no", F.col("_run") + F.col("_fix") + F.col("_off")))
    rank_expr = F.max(F.when(F.col("status") == "CRITICAL", STATUS_RANK["CRITICAL"])
                      .otherwise(STATUS_RANK["WARNING"]))
    return (numbered
            .where(F.col("_bad"))
            .groupBy(*keys, "incident_no")
            .agg(F.min(ws).alias("first_window"),
                 F.max(ws).alias("last_window"),
                 F.count(F.lit(1)).alias("n_windows"),
                 F.sum("total_entries").alias("total_entries"),
                 F.sum("error_count").alias("error_count"),
                 F.max("error_rate").alias("peak_error_rate"),
                 rank_expr.alias("_worst"))
            .withColumn("worst_status", F.when(F.col("_worst") == 2, "CRITICAL").otherwise("WARNING"))
            .drop("_worst"))


def _mrkdwn(text: Column) -> Column:
    return F.struct(F.lit("mrkdwn").alias("type"), text.alias("text"))


def alert_payload(params: HealthParams, sent_at: Column) -> Column:
    """Chat payload (JSON text) for one transition row: coloured attachment,
    header, transition text, worst-window fields when not HEALTHY, top error
    when a ``top_error`` column is non-null, and a time context line. The row has its ``colour``
    and ``emoji``."""
    thr = _pct(params.error_rate_threshold)
    not_ok = F.col("status") != "HEALTHY"
    spike_fields = F.array(
        _mrkdwn(F.concat(F.lit(WORST_WINDOW_LABEL), minute_text("window_start"))),
        _mrkdwn(F.concat(F.lit(ERROR_RATE_LABEL), percent_text("error_rate"),
                         F.lit(THRESHOLD_NOTE.format(pct=thr)))),
        _mrkdwn(F.format_string(ERROR_COUNT_LABEL,
                                F.col("error_count"), F.col("total_entries"))),
    )
    top_field = F.array(_mrkdwn(F.concat(F.lit(TOP_ERROR_LABEL), F.col("top_error"), F.lit("`"))))
    empty = F.array().cast("array<struct<type:string,text:string>>")
    fields = F.concat(F.when(not_ok, spike_fields).otherwise(empty),
                      F.when(F.col("top_error").isNotNull(), top_field).otherwise(empty))
    text_t = "struct<type:string,text:string,emoji:boolean>"
    el_t = "array<struct<type:string,text:string>>"

    def block(type_, text=None, flds=None, elements=None):
        return F.struct(F.lit(type_).alias("type"),
                        (text if text is not None else F.lit(None).cast(text_t)).alias("text"),
                        (flds if flds is not None else F.lit(None).cast(el_t)).alias("fields"),
                        (elements if elements is not None else F.lit(None).cast(el_t)).alias("elements"))

    header = block("header", F.struct(
        F.lit("plain_text").alias("type"),
        F.concat(F.col("emoji"), F.lit(" "), F.col("status"), F.lit(TITLE_JOINT + params.alert_title)).alias("text"),
        F.lit(True).alias("emoji")))
    section = block("section", F.struct(F.lit("mrkdwn").alias("type"), F.col("transition").alias("text"),
                                        F.lit(None).cast("boolean").alias("emoji")))
    field_block = block("section", flds=fields)
    context = block("context", elements=F.array(_mrkdwn(sent_at)))
    block_t = f"struct<type:string,text:{text_t},fields:{el_t},elements:{el_t}>"
    blocks = F.concat(F.array(header, section),
                      F.when(F.size(fields) > 0, F.array(field_block))
                      .otherwise(F.array().cast(f"array<{block_t}>")),
                      F.array(context))
    payload = F.struct(F.array(F.struct(F.col("colour").alias("color"),
                                        blocks.alias("blocks"))).alias("attachments"))
    return F.to_json(payload)


def alert_events(transitions: DataFrame, params: HealthParams = HealthParams(),
                 keys: Sequence[str] = (), top_errors_by_window: DataFrame | None = None,
                 texts: DataFrame | None = None, looks: DataFrame | None = None) -> DataFrame:
    """One alert per status change: transition text (with the ``PREV → NEW``
    default), colour, emoji and the JSON payload.

    Lookups are literal maps evaluated per row, or the user's own tables: ``texts``
    (prev_status, status, text) and ``looks`` (status, colour, emoji), joined with
    the built-in default for what they lack. The optional
    ``top_errors_by_window`` (keys, window_start, top_error) adds the top
    error field; both sides are window-level aggregates.
    """
    df = transitions.withColumns({
        "transition": transition_text("prev_status", "status"),
        "colour": status_colour("status"),
        "emoji": status_emoji("status"),
    })
    if texts is not None:
        df = with_lookup(df, texts, ["prev_status", "status"], "text", "transition",
                         F.concat("prev_status", F.lit(" → "), "status"))
    for name in ("colour", "emoji") if looks is not None else ():
        df = with_lookup(df, looks, ["status"], name, name, F.col(name))
    if top_errors_by_window is not None:
        # null-safe: a NULL key is a group like any other, and no inferred
        # isnotnull filter is pushed into one side only
        t = top_errors_by_window.select(*[F.col(c).alias(f"_t_{c}") for c in (*keys, "window_start")],
                                        "top_error")
        cond = [df[c].eqNullSafe(t[f"_t_{c}"]) for c in (*keys, "window_start")]
        df = df.join(t, cond, "left").drop(*[f"_t_{c}" for c in (*keys, "window_start")])
    elif "top_error" not in df.columns:
        df = df.withColumn("top_error", F.lit(None).cast("string"))
    sent_at = minute_text("window_start")
    return df.withColumn("payload", alert_payload(params, sent_at))


def top_error_by_window(entries: DataFrame, window: str, keys: Sequence[str] = (),
                        prefix_length: int = 60) -> DataFrame:
    """Most frequent error prefix per (keys, window): count desc, prefix asc.

    Two aggregates: counts per (keys, window, prefix) with map-side combine,
    then ``min_by`` per window over those counts (no per-group collection).
    """
    counts = (entries.where(is_error("level"))
              .select(*keys, floor_time("timestamp", window).alias("window_start"),
                      message_prefix("message", prefix_length).alias("p"))
              .where(F.col("window_start").isNotNull() & F.col("p").isNotNull())
              .groupBy(*keys, "window_start", "p").agg(F.count(F.lit(1)).alias("c")))
    return counts.groupBy(*keys, "window_start").agg(
        F.min_by("p", F.struct((-F.col("c")).alias("nc"), F.col("p"))).alias("top_error"))


def window_prefix_counts(entries: DataFrame, p: HealthParams, keys: Sequence[str] = (), seen: bool = False) -> DataFrame:
    """(keys, window_start, p, n, e): rows and errors per window and prefix of
    error rows (other rows share the NULL prefix), the base of window rates and
    top errors in one scan; with ``seen`` also their latest timestamp."""
    prefix = F.when(is_error("level"), message_prefix("message", p.prefix_length))
    return (entries
            .groupBy(*keys, floor_time("timestamp", p.window).alias("window_start"), prefix.alias("p"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_error("level")).alias("e"),
                 *([F.max("timestamp").alias("seen")] if seen else [])))


def window_rates_with_top(entries: DataFrame, p: HealthParams, keys: Sequence[str] = ()) -> DataFrame:
    """Window rates with each window's top error (count desc, prefix asc; NULL
    without errors): one row per (keys, window)."""
    return rates_from_prefix_counts(window_prefix_counts(entries.where(F.col("timestamp").isNotNull()), p, keys), p, keys)


def rates_from_prefix_counts(base: DataFrame, p: HealthParams, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`window_rates_with_top` from counts by (keys, window, prefix)."""
    order = F.when(F.col("p").isNotNull(), F.struct((-F.col("n")).alias("nn"), F.col("p")))
    return (base.groupBy(*keys, "window_start")
            .agg(F.sum("n").alias("total_entries"), F.sum("e").alias("error_count"),
                 F.min_by("p", order).alias("top_error"))
            .select(*keys, "window_start", add_duration("window_start", p.window).alias("window_end"),
                    "total_entries", "error_count",
                    (F.col("error_count") / F.col("total_entries")).alias("error_rate"), "top_error"))


def window_alerts(entries: DataFrame, params: HealthParams = HealthParams(),
                  keys: Sequence[str] = (), initial: str = "HEALTHY", texts: DataFrame | None = None,
                  looks: DataFrame | None = None) -> DataFrame:
    """Status-change alerts with each window's top error, from one scan and one
    base aggregate: the top error rides along with the window's rates, so no
    second roll-up and no join is needed for it."""
    rates = window_rates_with_top(entries, params, keys)
    return alerts_from_rates(rates, params, keys, initial, texts, looks)


def alerts_from_rates(rates: DataFrame, params: HealthParams = HealthParams(),
                      keys: Sequence[str] = (), initial: str = "HEALTHY", texts: DataFrame | None = None,
                      looks: DataFrame | None = None) -> DataFrame:
    """Status-change alerts from window rows that carry their ``top_error``."""
    changed = status_transitions(status_from_rates(rates, params), keys, initial)
    return alert_events(changed, params, keys, texts=texts, looks=looks)
