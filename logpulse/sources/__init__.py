from logpulse.sources.events import (  # noqa: F401
    app_lines_from_events,
    entries_from_events,
    hadoop_lines_from_events,
    read_table,
)
from logpulse.sources.logs import (  # noqa: F401
    load_app_logs,
    load_hadoop_logs,
    parse_app_lines,
    parse_hadoop_lines,
    parse_rejects,
    read_log_lines,
    recent,
    reject_summary,
    stream_log_lines,
    union_sources,
)
from logpulse.sources.report_io import (  # noqa: F401
    HEALTH_REPORT_SCHEMA,
    read_report,
    read_report_spikes,
    report_section,
    write_report,
)
