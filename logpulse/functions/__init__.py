from logpulse.functions.columns import (  # noqa: F401
    add_duration,
    covered_hours,
    duration_micros,
    epoch_micros,
    epoch_seconds,
    floor_time,
    is_error,
    message_prefix,
    minute_text,
    normalise_level,
    percent_text,
    safe_ratio,
    second_text,
    spike_severity,
    status_colour,
    status_emoji,
    to_instant,
    to_wall_clock,
    transition_text,
    window_status,
)
from logpulse.functions.text import html_to_text, repaired  # noqa: F401
