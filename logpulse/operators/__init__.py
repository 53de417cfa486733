from logpulse.operators.checks import status_check  # noqa: F401
from logpulse.operators.enrich import enrich_entries, number_entries, number_rows, sort_entries  # noqa: F401
from logpulse.operators.hourly import hourly_breakdown, hourly_stacked  # noqa: F401
from logpulse.operators.lookup import with_lookup  # noqa: F401
from logpulse.operators.report import (  # noqa: F401
    base_series,
    base_recommendations,
    flatten_report,
    health_report,
    report_aggregate,
    report_header,
    report_spikes,
)
from logpulse.operators.severity import severity_counts, severity_share  # noqa: F401
from logpulse.operators.status import (  # noqa: F401
    alert_events,
    health_status,
    incidents,
    spike_recommendations,
    status_transitions,
    time_range,
    top_error_by_window,
    window_alerts,
    worst_spike,
)
from logpulse.operators.text import pages_to_text  # noqa: F401
from logpulse.operators.top_errors import top_errors, top_prefixes  # noqa: F401
from logpulse.operators.windows import (  # noqa: F401
    detect_spikes,
    error_timeline,
    spike_lift,
    window_cube,
    window_error_rate,
    window_status_frame,
)
