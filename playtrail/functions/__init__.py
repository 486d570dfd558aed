"""Column functions (D1-D16) and rule sets."""

from . import columns
from .columns import (
    binge_kind,
    extract_click_title,
    first_match,
    first_segment,
    in_range,
    is_linear_channel,
    local_date,
    local_ts,
    normalize_click_device,
    normalize_title,
    normalize_video_device,
    shift_seconds,
    video_action,
    video_title,
)
from .rules import R1, R2, R3, R4, RULE_SETS, RuleSet, rule_set

__all__ = [
    "columns",
    "binge_kind",
    "extract_click_title",
    "first_match",
    "first_segment",
    "in_range",
    "is_linear_channel",
    "local_date",
    "local_ts",
    "normalize_click_device",
    "normalize_title",
    "normalize_video_device",
    "shift_seconds",
    "video_action",
    "video_title",
    "R1",
    "R2",
    "R3",
    "R4",
    "RULE_SETS",
    "RuleSet",
    "rule_set",
]
