"""Sources: table scans and the projection of the test ``events`` table."""

from .fixture import events_as_clickstream, events_as_video_log
from .readers import (
    ATTRIBUTION_COLUMNS,
    CLICKSTREAM_COLUMNS,
    VIDEO_LOG_COLUMNS,
    conform,
    read_attribution,
    read_clickstream,
    read_table,
    read_video_log,
)

__all__ = [
    "events_as_clickstream",
    "events_as_video_log",
    "ATTRIBUTION_COLUMNS",
    "CLICKSTREAM_COLUMNS",
    "VIDEO_LOG_COLUMNS",
    "conform",
    "read_attribution",
    "read_clickstream",
    "read_table",
    "read_video_log",
]
