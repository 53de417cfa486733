from logpulse.streaming.alert_state import AlertState, current_alerts  # noqa: F401
from logpulse.streaming.landing import (  # noqa: F401
    compact_landed,
    compacted_entries,
    finished,
    land_entries,
    landed_entries,
    watch_entries,
    watcher_state,
)
from logpulse.streaming.windows import (  # noqa: F401
    dropped_late_rows,
    run_to_parquet,
    start_to_parquet,
    stream_window_rates,
)
