"""Column expressions shared by the operators.

All of them are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; none of them needs Python at run time.
"""

from __future__ import annotations

import re
from datetime import timedelta
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from logpulse.constants import (
    ERROR_LEVELS,
    HADOOP_LEVEL_MAP,
    STATUS_COLOUR,
    STATUS_EMOJI,
    TRANSITION_TEXT,
)


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_micros(width: str | timedelta) -> int:
    """'5 minutes' / '1 hour' / timedelta -> microseconds."""
    if isinstance(width, timedelta):
        return int(width / timedelta(microseconds=1))
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not m or m.group(2) not in _UNIT_MICROS:
        raise ValueError(f"unsupported duration: {width!r}")
    return int(m.group(1)) * _UNIT_MICROS[m.group(2)]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (floor).

    Zone-free and cheap: date part via ``unix_date``, time of day as the
    (non-negative) NTZ - NTZ interval cast to seconds. ``timestampdiff``
    is not used because it casts NTZ to a session-zone TIMESTAMP.
    """
    c = col_(ts)
    day = F.to_date(c)
    tod = (c - day.cast("timestamp_ntz")).cast("bigint")
    return F.unix_date(day).cast("bigint") * F.lit(86_400) + tod


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (zone-free)."""
    frac = (F.date_part(F.lit("SECOND"), col_(ts)) * F.lit(1_000_000)).cast("bigint") % F.lit(1_000_000)
    return epoch_seconds(ts) * F.lit(1_000_000) + frac


def from_epoch_micros(us: Column) -> Column:
    """Inverse of :func:`epoch_micros`, returns TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", us, epoch_ntz())


def floor_time(ts: str | Column, width: str | timedelta) -> Column:
    """Floor a TIMESTAMP_NTZ to an epoch-aligned bucket of ``width``.

    Same buckets as ``window(ts, width).start`` but null-preserving: ``window``
    in a projection adds an ``isnotnull`` filter, which would drop rows from
    the counts that must include them. Whole-second widths use second
    arithmetic only.
    """
    w = duration_micros(width)
    if w % 1_000_000 == 0:
        secs = epoch_seconds(ts)
        return F.timestamp_add("SECOND", secs - F.pmod(secs, F.lit(w // 1_000_000)), epoch_ntz())
    us = epoch_micros(ts)
    return from_epoch_micros(us - F.pmod(us, F.lit(w)))


def add_duration(ts: str | Column, width: str | timedelta) -> Column:
    return F.timestamp_add("MICROSECOND", F.lit(duration_micros(width)), col_(ts))


def to_instant(ts_ntz: str | Column) -> Column:
    """TIMESTAMP_NTZ read as UTC -> TIMESTAMP (for watermarks), any session zone."""
    return F.timestamp_micros(epoch_micros(ts_ntz))


def to_wall_clock(ts: str | Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ in UTC, any session zone."""
    return from_epoch_micros(F.unix_micros(col_(ts)))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` or 0.0 when ``den`` is 0 (ANSI division raises on 0)."""
    den = col_(den)
    return F.when(den > 0, col_(num).cast("double") / den).otherwise(F.lit(0.0))


def is_error(level: str | Column = "level") -> Column:
    return F.coalesce(col_(level).isin(*ERROR_LEVELS), F.lit(False))


def _literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def normalise_level(raw: str | Column) -> Column:
    """WARN -> WARNING, FATAL -> CRITICAL; INFO and ERROR unchanged."""
    return F.try_element_at(_literal_map(HADOOP_LEVEL_MAP), col_(raw))


def message_prefix(message: str | Column, n: int = 60) -> Column:
    """First ``n`` code points."""
    return F.substring(col_(message), 1, n)


def spike_severity(rate: str | Column, critical_rate: float) -> Column:
    return F.when(col_(rate) < F.lit(critical_rate), "warning").otherwise("critical")


def window_status(total: str | Column, rate: str | Column, threshold: float,
                  critical_rate: float, min_entries: int) -> Column:
    """Per-window status: too few rows or rate <= threshold -> HEALTHY,
    rate < critical -> WARNING, else CRITICAL."""
    total, rate = col_(total), col_(rate)
    return (F.when((total < min_entries) | (rate <= F.lit(threshold)), "HEALTHY")
            .when(rate < F.lit(critical_rate), "WARNING")
            .otherwise("CRITICAL"))


def percent_text(rate: str | Column) -> Column:
    """Whole-percent text, rounding half to even like Python's ``{:.0%}``; NULL stays NULL."""
    pct = F.bround(col_(rate) * F.lit(100.0), 0).cast("bigint")
    return F.when(col_(rate).isNotNull(), F.format_string("%d%%", pct))


def covered_hours(first_ts: str | Column, last_ts: str | Column) -> Column:
    """max(1, whole hours between first and last timestamp)."""
    us = epoch_micros(last_ts) - epoch_micros(first_ts)
    hours = F.coalesce(F.floor(us / F.lit(3_600_000_000)), F.lit(0))
    return F.greatest(F.lit(1), hours).cast("int")


def minute_text(ts: str | Column) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd HH:mm")


def second_text(ts: str | Column) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd HH:mm:ss")


def transition_text(prev: str | Column, new: str | Column) -> Column:
    """Alert text for a status change, default ``PREV → NEW``."""
    keyed = {f"{a}|{b}": t for (a, b), t in TRANSITION_TEXT.items()}
    prev, new = col_(prev), col_(new)
    return F.coalesce(
        F.try_element_at(_literal_map(keyed), F.concat_ws("|", prev, new)),
        F.concat(prev, F.lit(" → "), new),
    )


def status_colour(status: str | Column) -> Column:
    return F.try_element_at(_literal_map(STATUS_COLOUR), col_(status))


def status_emoji(status: str | Column) -> Column:
    return F.try_element_at(_literal_map(STATUS_EMOJI), col_(status))
