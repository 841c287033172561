from cauce.functions.scalars import (
    count_line,
    is_missing,
    parse_event_time,
    rate_per_100k,
    safe_ratio,
    timestamp_text,
    to_code,
    to_count,
    to_key,
    to_name,
)

__all__ = [
    "count_line",
    "is_missing",
    "parse_event_time",
    "rate_per_100k",
    "safe_ratio",
    "timestamp_text",
    "to_code",
    "to_count",
    "to_key",
    "to_name",
]
