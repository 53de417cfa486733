"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Same tables, same parameters as :mod:`logpulse.plans.catalog`; column names
and types are aligned with the Spark results (DuckDB ``hour`` and
``row_number`` are BIGINT and its sums HUGEINT, so they are cast).
"""

from __future__ import annotations

# Fixed values, written down here a second time so that a wrong constant in the
# engine shows as a difference.
HADOOP_LINE_PATTERN = (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),\d+ (INFO|WARN|ERROR|FATAL) "
                       r"\[([^\]]+)\] (\S+): (.+)$")
APP_LINE_PATTERN = (r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}) — (DEBUG|INFO|WARNING|ERROR|CRITICAL)"
                    r" — (\S+) — (.+)")
TRANSITION_TEXT = {
    "HEALTHY|WARNING": "Error rate elevated — anomaly spike detected.",
    "HEALTHY|CRITICAL": "Critical anomaly detected — immediate attention required.",
    "WARNING|CRITICAL": "Escalating — error rate crossed critical threshold.",
    "CRITICAL|WARNING": "Partially recovered — still above warning threshold.",
    "CRITICAL|HEALTHY": "System recovered — no anomaly spikes detected.",
    "WARNING|HEALTHY": "System recovered — no anomaly spikes detected.",
}
STATUS_COLOUR = {"CRITICAL": "#EF4444", "WARNING": "#F59E0B", "HEALTHY": "#22C55E"}
STATUS_EMOJI = {"CRITICAL": ":red_circle:", "WARNING": ":large_yellow_circle:", "HEALTHY": ":large_green_circle:"}
SPIKE_ADVICE = ("Anomaly spike at {window}: {errors} errors in {width} ({pct} error rate). "
                "Investigate what changed at this time.")
TOP_ERROR_ADVICE = "'{prefix}' occurred {count} times — consider adding retry logic."


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ENTRIES = """entries AS (
  SELECT event_id,
         date_trunc('second', ts) AS "timestamp",
         CASE WHEN event_type = 'error' THEN (CASE WHEN value >= 100 THEN 'CRITICAL' ELSE 'ERROR' END)
              WHEN event_type = 'purchase' THEN 'WARNING'
              WHEN event_type = 'view' THEN 'DEBUG'
              ELSE 'INFO' END AS level,
         event_type AS logger,
         event_type || ' ' || props AS message,
         CAST(((user_id % 8) + 8) % 8 AS INTEGER) AS svc
  FROM events)"""

HLINES = """hlines AS (
  SELECT event_id, event_type,
         strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || ' ' ||
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'FATAL'
              WHEN event_type = 'purchase' THEN 'WARN' WHEN event_type = 'view' THEN 'DEBUG'
              ELSE 'INFO' END
         || ' [user ' || CAST(user_id AS VARCHAR) || '] app.svc.' || event_type || ': '
         || event_type || ' ' || props AS line
  FROM events)"""

HP = _q(HADOOP_LINE_PATTERN)
HPARSED = f"""hparsed AS (
  SELECT event_id, event_type, m,
         CASE WHEN m THEN TRY_CAST(regexp_extract(line, {HP}, 1) AS TIMESTAMP) END AS "timestamp",
         CASE WHEN m THEN CASE regexp_extract(line, {HP}, 2) WHEN 'WARN' THEN 'WARNING'
                                WHEN 'FATAL' THEN 'CRITICAL' ELSE regexp_extract(line, {HP}, 2) END END AS level,
         CASE WHEN m THEN split_part(regexp_extract(line, {HP}, 4), '.', -1) END AS logger,
         CASE WHEN m THEN regexp_extract(line, {HP}, 5) END AS message
  FROM (SELECT *, coalesce(regexp_matches(line, {HP}), false) AS m FROM hlines))"""

ALINES = """alines AS (
  SELECT event_id, event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || ' — ' ||
         CASE WHEN event_type = 'error' THEN (CASE WHEN value >= 100 THEN 'CRITICAL' ELSE 'ERROR' END)
              WHEN event_type = 'purchase' THEN 'WARNING' WHEN event_type = 'view' THEN 'DEBUG'
              ELSE 'INFO' END
         || ' — app.' || event_type || ' — ' || event_type || ' ' || props AS line
  FROM events)"""

AP = _q(APP_LINE_PATTERN)
APARSED = f"""aparsed AS (
  SELECT event_id, event_type,
         CASE WHEN m THEN TRY_CAST(regexp_extract(line, {AP}, 1) AS TIMESTAMP) END AS "timestamp",
         CASE WHEN m THEN regexp_extract(line, {AP}, 2) END AS level,
         CASE WHEN m THEN regexp_extract(line, {AP}, 3) END AS logger,
         CASE WHEN m THEN regexp_extract(line, {AP}, 4) END AS message,
         m
  FROM (SELECT *, coalesce(regexp_matches(line, {AP}), false) AS m FROM alines))"""

HADOOP_OK = """hok AS (SELECT event_id, event_type, "timestamp", level, logger, message
                FROM hparsed WHERE m AND "timestamp" IS NOT NULL)"""
APP_OK = """aok AS (SELECT event_id, event_type, "timestamp", level, logger, message
             FROM aparsed WHERE m AND "timestamp" IS NOT NULL)"""

ERR = "level IN ('ERROR', 'CRITICAL')"


def _rates(unit: str, keyed: bool) -> str:
    k = "svc, " if keyed else ""
    return f"""rates AS (
  SELECT {k}window_start, window_end, total_entries, error_count,
         error_count / total_entries AS error_rate
  FROM (SELECT {k}date_trunc('{unit}', "timestamp") AS window_start,
               date_trunc('{unit}', "timestamp") + INTERVAL 1 {unit.upper()} AS window_end,
               count(*) AS total_entries,
               count(*) FILTER (WHERE {ERR}) AS error_count
        FROM entries WHERE "timestamp" IS NOT NULL
        GROUP BY ALL))"""


def _status(thr: float, crit: float, n: int) -> str:
    return f"""status AS (
  SELECT *, CASE WHEN total_entries < {n} OR error_rate <= CAST({thr} AS DOUBLE) THEN 'HEALTHY'
                 WHEN error_rate < CAST({crit} AS DOUBLE) THEN 'WARNING'
                 ELSE 'CRITICAL' END AS status
  FROM rates)"""


SPIKES = f"""spikes AS (
  SELECT *, CASE WHEN error_rate < CAST(0.1 AS DOUBLE) THEN 'warning' ELSE 'critical' END AS severity
  FROM rates WHERE error_rate > CAST(0.05 AS DOUBLE) AND total_entries >= 10)"""


def _transitions(keyed: bool) -> str:
    part = "PARTITION BY svc " if keyed else ""
    k = "svc, " if keyed else ""
    return f"""transitions AS (
  SELECT {k}window_start, prev_status, status, window_end, total_entries, error_count, error_rate
  FROM (SELECT *, lag(status, 1, 'HEALTHY') OVER ({part}ORDER BY window_start) AS prev_status
        FROM status)
  WHERE prev_status <> status)"""


def _incidents(keyed: bool) -> str:
    part = "PARTITION BY svc " if keyed else ""
    k = "svc, " if keyed else ""
    return f"""
  SELECT {k}incident_no,
         min(window_start) AS first_window, max(window_start) AS last_window,
         count(*) AS n_windows,
         CAST(sum(total_entries) AS BIGINT) AS total_entries,
         CAST(sum(error_count) AS BIGINT) AS error_count,
         max(error_rate) AS peak_error_rate,
         CASE WHEN max(CASE WHEN status = 'CRITICAL' THEN 2 ELSE 1 END) = 2
              THEN 'CRITICAL' ELSE 'WARNING' END AS worst_status
  FROM (SELECT *, CAST(sum(CASE WHEN bad AND NOT prev_bad THEN 1 ELSE 0 END)
                       OVER ({part}ORDER BY window_start
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS incident_no
        FROM (SELECT *, status <> 'HEALTHY' AS bad,
                     lag(status <> 'HEALTHY', 1, false) OVER ({part}ORDER BY window_start) AS prev_bad
              FROM status))
  WHERE bad
  GROUP BY ALL"""


def _case(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


#: The texts and looks of the query's own tables; what they lack has the default.
OWN_TEXT = {"HEALTHY|CRITICAL": "page the owner", "CRITICAL|WARNING": "keep watching"}
OWN_COLOUR = STATUS_COLOUR | {"CRITICAL": "#111111", "HEALTHY": "#222222"}
OWN_EMOJI = STATUS_EMOJI | {"CRITICAL": ":fire:", "HEALTHY": ":ok:"}

TRANSITION_CASE = _case("prev_status || '|' || status", TRANSITION_TEXT, "prev_status || ' → ' || status")


def _payload(threshold_pct: int, sent_at: str, change: str = TRANSITION_CASE, colour: dict = STATUS_COLOUR,
             emoji: dict = STATUS_EMOJI) -> str:
    """The chat payload as JSON text, from columns status, colour, emoji,
    transition, window_start, error_rate, error_count, total_entries, top_error."""
    def text(expr: str) -> str:
        return f"""'{{"type":"mrkdwn","text":' || CAST(to_json({expr}) AS VARCHAR) || '}}'"""

    worst = [text("'*Worst window:*' || chr(10) || strftime(window_start, '%Y-%m-%d %H:%M')"),
             text("'*Error rate:*' || chr(10) || CAST(CAST(round_even(error_rate * 100, 0) AS BIGINT) AS VARCHAR)"
                  f" || '% (threshold: {threshold_pct}%)'"),
             text("'*Errors in window:*' || chr(10) || format('{:,}', error_count) || ' / ' "
                  "|| format('{:,}', total_entries) || ' entries'")]
    top = text("'*Top error:*' || chr(10) || '`' || top_error || '`'")
    fields = (f"concat_ws(',', CASE WHEN status <> 'HEALTHY' THEN {' || chr(44) || '.join(worst)} END, "
              f"CASE WHEN top_error IS NOT NULL THEN {top} END)")
    return (f"""'{{"attachments":[{{"color":"' || {_case('status', colour)} || '","blocks":["""
            f"""{{"type":"header","text":{{"type":"plain_text","text":"' || {_case('status', emoji)} """
            f"""|| ' ' || status || ' — logpulse","emoji":true}}}},{{"type":"section","text":' """
            f"""|| {text(change)} || '}},' """
            f"""|| CASE WHEN status <> 'HEALTHY' OR top_error IS NOT NULL """
            f"""THEN '{{"type":"section","fields":[' || {fields} || ']}},' ELSE '' END """
            f"""|| '{{"type":"context","elements":[' || {text(sent_at)} || ']}}]}}]}}'""")


def _alerts(unit: str, keyed: bool, thr: float, crit: float, pct: int, texts: dict = TRANSITION_TEXT,
            colour: dict = STATUS_COLOUR, emoji: dict = STATUS_EMOJI) -> str:
    change = _case("prev_status || '|' || status", texts, "prev_status || ' → ' || status")
    k = "svc, " if keyed else ""
    part = "svc, " if keyed else ""
    return f"""WITH {ENTRIES}, {_rates(unit, keyed)}, {_status(thr, crit, 10)}, {_transitions(keyed)},
te AS (
  SELECT {k}window_start, p AS top_error
  FROM (SELECT *, row_number() OVER (PARTITION BY {part}window_start ORDER BY c DESC, p) AS rn
        FROM (SELECT {k}date_trunc('{unit}', "timestamp") AS window_start,
                     substr(message, 1, 60) AS p, count(*) AS c
              FROM entries
              WHERE {ERR} AND "timestamp" IS NOT NULL AND message IS NOT NULL
              GROUP BY ALL))
  WHERE rn = 1)
SELECT t.*, {change} AS transition,
       {_case('status', colour)} AS colour,
       {_case('status', emoji)} AS emoji,
       te.top_error,
       {_payload(pct, "strftime(window_start, '%Y-%m-%d %H:%M')", change, colour, emoji)} AS payload
FROM transitions t LEFT JOIN te USING ({k}window_start)"""


TOP_ERRORS = f"""WITH {ENTRIES},
e AS (SELECT substr(message, 1, 60) AS p FROM entries WHERE {ERR}),
g AS (SELECT p AS message_prefix, count(*) AS count FROM e WHERE p IS NOT NULL GROUP BY p)
SELECT CAST(row_number() OVER (ORDER BY count DESC, message_prefix) AS INTEGER) AS rank,
       message_prefix, count, count / (SELECT count(*) FROM e) AS pct_of_errors
FROM g ORDER BY count DESC, message_prefix LIMIT 10"""

_SPIKE_TEXT = (SPIKE_ADVICE.replace("'", "''")
               .replace("{window}", "' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || '")
               .replace("{errors}", "' || error_count || '")
               .replace("{width}", "1 hour")
               .replace("{pct}", "' || CAST(CAST(round_even(error_rate * 100, 0) AS BIGINT) AS VARCHAR) || '%"))
SPIKE_TEXT_SQL = f"'{_SPIKE_TEXT}'"
_TOP_TEXT = (TOP_ERROR_ADVICE.replace("'", "''")
             .replace("{prefix}", "' || message_prefix || '")
             .replace("{count}", "' || count || '"))
TOP_TEXT_SQL = f"'{_TOP_TEXT}'"

TOP1 = f"""top1 AS (
  SELECT p AS message_prefix, count(*) AS count
  FROM (SELECT substr(message, 1, 60) AS p FROM entries WHERE {ERR}) WHERE p IS NOT NULL
  GROUP BY p ORDER BY count DESC, message_prefix LIMIT 1)"""

SEVERITY = f"""
SELECT count(*) FILTER (WHERE level = 'DEBUG') AS "DEBUG",
       count(*) FILTER (WHERE level = 'INFO') AS "INFO",
       count(*) FILTER (WHERE level = 'WARNING') AS "WARNING",
       count(*) FILTER (WHERE level = 'ERROR') AS "ERROR",
       count(*) FILTER (WHERE level = 'CRITICAL') AS "CRITICAL",
       count(*) AS total,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {ERR}) / count(*) ELSE 0.0 END AS error_rate,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE level = 'WARNING') / count(*) ELSE 0.0 END AS warning_rate
FROM entries"""

HOURLY = """hourly AS (
  SELECT CAST(hour("timestamp") AS INTEGER) AS hour,
         count(*) FILTER (WHERE level = 'DEBUG') AS "DEBUG",
         count(*) FILTER (WHERE level = 'INFO') AS "INFO",
         count(*) FILTER (WHERE level = 'WARNING') AS "WARNING",
         count(*) FILTER (WHERE level = 'ERROR') AS "ERROR",
         count(*) FILTER (WHERE level = 'CRITICAL') AS "CRITICAL",
         count(*) FILTER (WHERE level IN ('DEBUG', 'INFO', 'WARNING', 'ERROR', 'CRITICAL')) AS total
  FROM entries WHERE "timestamp" IS NOT NULL AND level IS NOT NULL
  GROUP BY 1)"""

H1 = _rates("hour", False)
D1 = _rates("day", True)
ST_H = _status(0.05, 0.10, 10)
ST_D = _status(0.20, 0.25, 10)

HTML_TEXT = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), "
    "'[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), "
    "'^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$', '', 'g')"
)

REPORT = f"""WITH {ENTRIES}, {H1}, {SPIKES}, {TOP1},
sev AS ({SEVERITY}),
sp AS (SELECT count(*) AS spike_count,
              count(*) FILTER (WHERE severity = 'critical') AS n_crit FROM spikes),
worst AS (SELECT {SPIKE_TEXT_SQL} AS rec FROM spikes ORDER BY error_rate DESC, window_start LIMIT 1),
tr AS (SELECT min("timestamp") AS a, max("timestamp") AS b FROM entries),
ntop AS (SELECT count(*) AS n FROM (SELECT DISTINCT substr(message, 1, 60) AS p FROM entries
                                    WHERE {ERR} AND message IS NOT NULL))
SELECT CASE WHEN n_crit > 0 THEN 'CRITICAL' WHEN spike_count > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS status,
       CASE WHEN n_crit > 0 THEN 'Anomaly spike with >10% error rate detected'
            WHEN spike_count > 0 THEN spike_count || ' anomaly spike(s) detected above 5% threshold'
            ELSE 'No anomaly spikes detected' END AS status_reason,
       total AS total_entries,
       strftime(a, '%Y-%m-%d %H:%M') AS time_start, strftime(b, '%Y-%m-%d %H:%M') AS time_end,
       "DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL", error_rate, warning_rate,
       round(error_rate * 100, 2) AS error_rate_pct,
       CAST(least(ntop.n, 10) AS INTEGER) AS n_top_errors,
       (SELECT message_prefix FROM top1) AS top_error_prefix,
       (SELECT count FROM top1) AS top_error_count,
       (SELECT count FROM top1) / (SELECT count(*) FROM entries WHERE {ERR}) AS top_error_share,
       spike_count,
       CAST(least(spike_count, 5) + (SELECT count(*) FROM top1) AS INTEGER) AS n_recommendations,
       coalesce((SELECT rec FROM worst), (SELECT {TOP_TEXT_SQL} FROM top1)) AS first_recommendation,
       '2024-01-29 00:00:00' AS generated_at,
       CAST(greatest(1, coalesce(floor((epoch_us(b) - epoch_us(a)) / 3600000000), 0)) AS INTEGER) AS hours_analysed
FROM sev, sp, tr, ntop"""


FIRED_AT = "2024-01-29 00:00:00"


def _check(name: str, as_of: str) -> str:
    """A check that finds no earlier one: previous status HEALTHY."""
    return f"""{name} AS (
  SELECT TIMESTAMP '{as_of}' AS checked_at, 'HEALTHY' AS prev_status,
         CASE WHEN n_crit > 0 THEN 'CRITICAL' WHEN spike_count > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS status,
         spike_count, w.window_start, w.total_entries, w.error_count, w.error_rate,
         (SELECT message_prefix FROM top1) AS top_error
  FROM (SELECT count(*) AS spike_count, count(*) FILTER (WHERE severity = 'critical') AS n_crit FROM spikes)
  LEFT JOIN (SELECT * FROM spikes ORDER BY error_rate DESC, window_start LIMIT 1) w ON true)"""


def _check_alert(name: str, pct: int) -> str:
    return f"""SELECT *, {TRANSITION_CASE} AS transition,
       strftime(window_start, '%Y-%m-%d %H:%M') AS worst_window,
       CAST(CAST(round_even(error_rate * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS worst_rate_text,
       {_payload(pct, "strftime(checked_at, '%Y-%m-%d %H:%M')")} AS payload
FROM {name} WHERE prev_status <> status"""


ORACLE_SQL: dict[str, str] = {
    "parse_hadoop_logs": f"WITH {HLINES}, {HPARSED}, {HADOOP_OK} SELECT * FROM hok",
    "parse_app_logs": f"WITH {ALINES}, {APARSED}, {APP_OK} SELECT * FROM aok",
    "parse_rejects": f"""WITH {HLINES}, {HPARSED}
SELECT event_type, reject_reason, count(*) AS n_rejected
FROM (SELECT event_type, CASE WHEN NOT m THEN 'no_match' WHEN "timestamp" IS NULL THEN 'bad_timestamp' END
             AS reject_reason FROM hparsed)
WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    "parse_rejects_by_reason": f"""WITH {HLINES}, feb AS (
  SELECT event_id, event_type, regexp_replace(line, '^(\\d{{4}})-\\d{{2}}-', '\\1-02-') AS line FROM hlines),
{HPARSED.replace('FROM hlines', 'FROM feb')}
SELECT event_type, CASE WHEN NOT m THEN 'no_match' ELSE 'bad_timestamp' END AS reject_reason, count(*) AS n_rejected
FROM hparsed WHERE NOT m OR "timestamp" IS NULL GROUP BY ALL""",
    "normalise_levels": f"""WITH {HLINES}
SELECT raw_level, count(*) AS n,
       CASE raw_level WHEN 'INFO' THEN 'INFO' WHEN 'WARN' THEN 'WARNING' WHEN 'ERROR' THEN 'ERROR'
                      WHEN 'FATAL' THEN 'CRITICAL' END AS level
FROM (SELECT regexp_extract(line, {HP}, 2) AS raw_level FROM hlines WHERE regexp_matches(line, {HP}))
GROUP BY raw_level""",
    "recent_entries": f"""WITH {ALINES}, {APARSED}, {APP_OK}
SELECT * FROM aok WHERE "timestamp" >= TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 24 HOUR""",
    "union_sources": f"""WITH {HLINES}, {HPARSED}, {HADOOP_OK}, {ALINES}, {APARSED}, {APP_OK}
SELECT source, level, count(*) AS n FROM (
  SELECT 'hadoop' AS source, level FROM hok UNION ALL SELECT 'app' AS source, level FROM aok)
GROUP BY ALL""",
    "enrich_entries": f"""WITH {ENTRIES}
SELECT event_id, "timestamp", level, logger, message,
       CAST(hour("timestamp") AS INTEGER) AS hour,
       date_trunc('hour', "timestamp") AS minute_window,
       coalesce({ERR}, false) AS is_error
FROM entries""",
    "severity_counts": f"WITH {ENTRIES} {SEVERITY}",
    "severity_share": f"""WITH {ENTRIES}, s AS ({SEVERITY})
SELECT 1 AS level_order, 'CRITICAL' AS level, "CRITICAL" AS count, "CRITICAL" / greatest(total, 1) AS share FROM s
UNION ALL SELECT 2, 'ERROR', "ERROR", "ERROR" / greatest(total, 1) FROM s
UNION ALL SELECT 3, 'WARNING', "WARNING", "WARNING" / greatest(total, 1) FROM s
UNION ALL SELECT 4, 'INFO', "INFO", "INFO" / greatest(total, 1) FROM s
UNION ALL SELECT 5, 'DEBUG', "DEBUG", "DEBUG" / greatest(total, 1) FROM s""",
    "top_errors": TOP_ERRORS,
    "top_prefixes": """WITH d AS (SELECT substr(text, 1, 60) AS p FROM documents),
g AS (SELECT p AS prefix, count(*) AS count FROM d WHERE p IS NOT NULL GROUP BY p)
SELECT CAST(row_number() OVER (ORDER BY count DESC, prefix) AS INTEGER) AS rank,
       prefix, count, count / (SELECT count(*) FROM d) AS share
FROM g ORDER BY count DESC, prefix LIMIT 10""",
    "top_errors_by_svc": f"""WITH {ENTRIES},
e AS (SELECT svc, substr(message, 1, 60) AS p FROM entries WHERE {ERR}),
g AS (SELECT svc, p AS message_prefix, count(*) AS count FROM e WHERE p IS NOT NULL GROUP BY ALL),
t AS (SELECT svc, count(*) AS n FROM e GROUP BY svc),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY svc ORDER BY count DESC, message_prefix) AS INTEGER) AS rank
      FROM g)
SELECT r.svc, rank, message_prefix, count, count / n AS pct_of_errors
FROM r JOIN t USING (svc) WHERE rank <= 3""",
    "window_error_rate": f"WITH {ENTRIES}, {H1} SELECT * FROM rates",
    "detect_spikes": f"WITH {ENTRIES}, {H1}, {SPIKES} SELECT * FROM spikes",
    "error_timeline": f"""WITH {ENTRIES}, {H1}
SELECT *, error_rate >= CAST(0.05 AS DOUBLE) AS above_threshold FROM rates WHERE total_entries >= 10""",
    "hourly_breakdown": f"WITH {ENTRIES}, {HOURLY} SELECT * FROM hourly",
    "hourly_stacked": f"""WITH {ENTRIES}, {HOURLY}
SELECT hour, 'DEBUG' AS level, 1 AS level_order, "DEBUG" AS count, CAST(0 AS BIGINT) AS bottom FROM hourly
UNION ALL SELECT hour, 'INFO', 2, "INFO", "DEBUG" FROM hourly
UNION ALL SELECT hour, 'WARNING', 3, "WARNING", "DEBUG" + "INFO" FROM hourly
UNION ALL SELECT hour, 'ERROR', 4, "ERROR", "DEBUG" + "INFO" + "WARNING" FROM hourly
UNION ALL SELECT hour, 'CRITICAL', 5, "CRITICAL", "DEBUG" + "INFO" + "WARNING" + "ERROR" FROM hourly""",
    "time_range": f"""WITH {ENTRIES}
SELECT min("timestamp") AS first_ts, max("timestamp") AS last_ts,
       strftime(min("timestamp"), '%Y-%m-%d %H:%M') AS start,
       strftime(max("timestamp"), '%Y-%m-%d %H:%M') AS "end",
       CAST(greatest(1, coalesce(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 3600000000), 0))
            AS INTEGER) AS hours_analysed
FROM entries""",
    "health_status": f"""WITH {ENTRIES}, {H1}, {SPIKES},
c AS (SELECT count(*) AS spike_count, count(*) FILTER (WHERE severity = 'critical') AS critical_spike_count
      FROM spikes)
SELECT CASE WHEN critical_spike_count > 0 THEN 'CRITICAL' WHEN spike_count > 0 THEN 'WARNING'
            ELSE 'HEALTHY' END AS status,
       CASE WHEN critical_spike_count > 0 THEN 'Anomaly spike with >10% error rate detected'
            WHEN spike_count > 0 THEN spike_count || ' anomaly spike(s) detected above 5% threshold'
            ELSE 'No anomaly spikes detected' END AS status_reason,
       spike_count, critical_spike_count
FROM c""",
    "health_status_by_svc": f"""WITH {ENTRIES}, {D1},
c AS (SELECT svc, count(*) FILTER (WHERE spike) AS spike_count,
             count(*) FILTER (WHERE spike AND error_rate >= CAST(0.34 AS DOUBLE)) AS critical_spike_count
      FROM (SELECT *, error_rate > CAST(0.32 AS DOUBLE) AND total_entries >= 10 AS spike FROM rates) GROUP BY svc)
SELECT svc, CASE WHEN critical_spike_count > 0 THEN 'CRITICAL' WHEN spike_count > 0 THEN 'WARNING'
                 ELSE 'HEALTHY' END AS status,
       CASE WHEN critical_spike_count > 0 THEN 'Anomaly spike with >34% error rate detected'
            WHEN spike_count > 0 THEN spike_count || ' anomaly spike(s) detected above 32% threshold'
            ELSE 'No anomaly spikes detected' END AS status_reason,
       spike_count, critical_spike_count
FROM c""",
    "worst_spike": f"""WITH {ENTRIES}, {H1}, {SPIKES}
SELECT * FROM spikes ORDER BY error_rate DESC, window_start LIMIT 1""",
    "spike_recommendations": f"""WITH {ENTRIES}, {H1}, {SPIKES}, {TOP1},
r AS (SELECT CAST(row_number() OVER (ORDER BY error_rate DESC, window_start) AS INTEGER) AS rec_no,
             {SPIKE_TEXT_SQL} AS recommendation
      FROM spikes ORDER BY error_rate DESC, window_start LIMIT 5)
SELECT * FROM r
UNION ALL
SELECT CAST((SELECT least(count(*), 5) FROM spikes) + 1 AS INTEGER) AS rec_no,
       {TOP_TEXT_SQL} AS recommendation
FROM top1""",
    "spike_lift": f"""WITH {ENTRIES}, {H1}, {SPIKES},
o AS (SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {ERR}) / count(*) ELSE 0.0 END
             AS overall_error_rate FROM entries)
SELECT window_start, total_entries, error_count, error_rate, severity, overall_error_rate,
       CASE WHEN overall_error_rate > 0 THEN error_rate / overall_error_rate END AS lift
FROM spikes, o""",
    "window_status": f"WITH {ENTRIES}, {H1}, {ST_H} SELECT * FROM status",
    "window_status_by_svc": f"WITH {ENTRIES}, {D1}, {ST_D} SELECT * FROM status",
    "status_transitions": f"WITH {ENTRIES}, {H1}, {ST_H}, {_transitions(False)} SELECT * FROM transitions",
    "status_transitions_by_svc":
        f"WITH {ENTRIES}, {D1}, {ST_D}, {_transitions(True)} SELECT * FROM transitions",
    "incidents": f"WITH {ENTRIES}, {H1}, {ST_H} {_incidents(False)}",
    "incidents_by_svc": f"WITH {ENTRIES}, {D1}, {ST_D} {_incidents(True)}",
    "alert_events": _alerts("hour", False, 0.05, 0.10, 5),
    "alert_events_by_svc": _alerts("day", True, 0.20, 0.25, 20),
    "status_check": f"WITH {ENTRIES}, {H1}, {SPIKES}, {TOP1}, {_check('a', FIRED_AT)} {_check_alert('a', 5)}",
    "status_check_history": f"""WITH {ENTRIES}, {H1}, {SPIKES}, {TOP1}, {_check('a', FIRED_AT)},
{_check('b', '2024-01-28 00:00:00')},
calm AS (SELECT TIMESTAMP '2024-01-29 00:10:00' AS checked_at, status AS prev_status, 'HEALTHY' AS status,
                CAST(0 AS BIGINT) AS spike_count, CAST(NULL AS TIMESTAMP) AS window_start,
                CAST(NULL AS BIGINT) AS total_entries, CAST(NULL AS BIGINT) AS error_count,
                CAST(NULL AS DOUBLE) AS error_rate, top_error FROM a)
{_check_alert('a', 5)} UNION ALL {_check_alert('b', 5)} UNION ALL {_check_alert('calm', 100)}""",
    "health_report": REPORT,
    "report_fields": TOP_ERRORS,
    "report_spikes": f"""WITH {ENTRIES}, {H1}, {SPIKES}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS "window", total_entries, error_count, error_rate, severity
FROM spikes""",
    "html_to_text": f"SELECT page_id, {HTML_TEXT} AS text FROM pages",
    "stream_window_rates": f"WITH {ENTRIES}, {H1} SELECT * FROM rates",
    "stream_status_alerts": _alerts("day", True, 0.20, 0.25, 20),
    "read_log_files": f"""WITH {HLINES}, {HPARSED}, {HADOOP_OK}
SELECT "timestamp", level, logger,
       CASE WHEN event_id % 5 = 0 THEN message || chr(65533) || chr(65533) ELSE message END AS message FROM hok""",
    "poll_log_files": f"""WITH {HLINES}, {HPARSED}, {HADOOP_OK}, entries AS (SELECT * FROM hok), {H1} SELECT * FROM rates""",
    "late_rows_by_window": f"""WITH {ENTRIES}, {H1},
b AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN 3 WHEN day("timestamp") <= 8 THEN 2 WHEN day("timestamp") <= 16 THEN 0
                     WHEN day("timestamp") <= 24 THEN 1 ELSE 3 END AS batch FROM entries),
ends AS (SELECT n AS batch, (SELECT max("timestamp") FROM b WHERE b.batch < n) AS latest FROM range(4) AS r(n)),
late AS (SELECT date_trunc('hour', "timestamp") AS window_start, count(*) AS late_rows
         FROM b JOIN ends USING (batch) WHERE "timestamp" < latest - INTERVAL 36 HOUR GROUP BY 1)
SELECT window_start, total_entries, error_count, coalesce(late_rows, 0) AS late_rows
FROM rates LEFT JOIN late USING (window_start)""",
    "numbered_entries": f"""WITH {ENTRIES}
SELECT event_id, row_number() OVER (ORDER BY "timestamp", event_id) AS row_no FROM entries""",
    "alert_events_own_texts": _alerts("hour", False, 0.05, 0.10, 5, OWN_TEXT, OWN_COLOUR, OWN_EMOJI),
}
