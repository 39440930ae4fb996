from fabflow.functions.scalar import (  # noqa: F401
    archive_day, format_wafer_id, iso_format, parse_event_time, safe_percentage,
)
