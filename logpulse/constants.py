"""Fixed values and default parameters.

Everything under "Fixed values" must stay exactly as written: result rows,
status texts and alert payloads are compared against them.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------

# Severity levels in ascending order (also the stacking order of the hourly
# chart series).
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
# Levels that count as errors.
ERROR_LEVELS = ("ERROR", "CRITICAL")
# Display order of the severity share table.
SHARE_ORDER = ("CRITICAL", "ERROR", "WARNING", "INFO", "DEBUG")

# Hadoop-style line: "2015-10-18 21:40:23,154 ERROR [thread] a.b.Component: message".
HADOOP_LINE_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),\d+ "
    r"(INFO|WARN|ERROR|FATAL) "
    r"\[([^\]]+)\] "
    r"(\S+): "
    r"(.+)$"
)
# Raw Hadoop level -> normalised level.
HADOOP_LEVEL_MAP = {
    "INFO": "INFO",
    "WARN": "WARNING",
    "ERROR": "ERROR",
    "FATAL": "CRITICAL",
}

# Application line: "2026-06-16T08:00:00 — ERROR — app.service — message"
# (anchored at the start only).
APP_LINE_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
    r" — (DEBUG|INFO|WARNING|ERROR|CRITICAL)"
    r" — (\S+)"
    r" — (.+)"
)

HEALTHY, WARNING, CRITICAL = "HEALTHY", "WARNING", "CRITICAL"
STATUS_RANK = {HEALTHY: 0, WARNING: 1, CRITICAL: 2}

# (previous status, new status) -> alert text; other pairs use "PREV → NEW".
TRANSITION_TEXT = {
    ("HEALTHY", "WARNING"): "Error rate elevated — anomaly spike detected.",
    ("HEALTHY", "CRITICAL"): "Critical anomaly detected — immediate attention required.",
    ("WARNING", "CRITICAL"): "Escalating — error rate crossed critical threshold.",
    ("CRITICAL", "WARNING"): "Partially recovered — still above warning threshold.",
    ("CRITICAL", "HEALTHY"): "System recovered — no anomaly spikes detected.",
    ("WARNING", "HEALTHY"): "System recovered — no anomaly spikes detected.",
}
STATUS_COLOUR = {
    "CRITICAL": "#EF4444",
    "WARNING": "#F59E0B",
    "HEALTHY": "#22C55E",
}
STATUS_EMOJI = {
    "CRITICAL": ":red_circle:",
    "WARNING": ":large_yellow_circle:",
    "HEALTHY": ":large_green_circle:",
}

# Status reasons and recommendation templates.
REASON_CRITICAL = "Anomaly spike with >{critical_pct}% error rate detected"
REASON_WARNING = "{n} anomaly spike(s) detected above {threshold_pct}% threshold"
REASON_HEALTHY = "No anomaly spikes detected"
SPIKE_ADVICE = (
    "Anomaly spike at {window}: {errors} errors in {width} "
    "({pct} error rate). Investigate what changed at this time."
)
TOP_ERROR_ADVICE = "'{prefix}' occurred {count} times — consider adding retry logic."

# Labels of the chat payload.
WORST_WINDOW_LABEL = "*Worst window:*\n"
ERROR_RATE_LABEL = "*Error rate:*\n"
THRESHOLD_NOTE = " (threshold: {pct}%)"
ERROR_COUNT_LABEL = "*Errors in window:*\n%,d / %,d entries"
TOP_ERROR_LABEL = "*Top error:*\n`"
TITLE_JOINT = " — "

# HTML to text: what is replaced, in this order.
HTML_TAG = r"<[^>]+>"
HTML_BLANKS = r"[ \t]+"
HTML_BREAKS = r"\n{3,}"


# --- Default parameters -------------------------------------------------------


@dataclass(frozen=True)
class HealthParams:
    """Analysis parameters; defaults are the product defaults."""

    window: str = "5 minutes"
    error_rate_threshold: float = 0.05
    critical_rate: float = 0.10
    min_window_entries: int = 10
    top_errors_n: int = 10
    prefix_length: int = 60
    spike_advice_n: int = 5
    alert_title: str = "logpulse"  # header of the chat payload

    def replace(self, **kw) -> "HealthParams":
        from dataclasses import replace

        return replace(self, **kw)
