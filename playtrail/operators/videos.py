"""Video side of the timeline (C4 without the feeder, which the sequence
stage computes on the merged, partitioned timeline)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import RuleSet, rule_set


def clean_videos(videos: DataFrame, from_date, to_date) -> DataFrame:
    """Plays of known accounts in the period that really played."""
    return videos.where(
        F.col("account_id").isNotNull()
        & C.in_range("event_date", F.lit(str(from_date)).cast("date"), F.lit(str(to_date)).cast("date"))
        & (F.col("media_load") == F.lit(False))
        & (F.col("seconds_with_ads") > 0)
    )


def prepare_videos(videos: DataFrame, rules: RuleSet | str, from_date, to_date) -> DataFrame:
    """C4: title fallback, trailer action, clock shift and device, in timeline columns."""
    r = rule_set(rules)
    device = C.normalize_video_device("device") if r.video_device == "normalized" else F.col("device")
    staged = clean_videos(videos, from_date, to_date).select(
        "account_id",
        "event_date",
        C.shift_seconds("event_ts", r.video_shift_seconds).alias("event_ts"),
        F.lit("").alias("player_event"),
        F.lit("").alias("click_details"),
        F.lit("").alias("binge_type"),
        C.video_action("display_name").alias("action"),
        device.alias("device"),
        C.video_title("display_name", "program").alias("raw_title"),
        "video_id",
        "seconds_no_ads",
    )
    return staged.where(F.col("raw_title").isNotNull()).select(
        "account_id",
        "event_date",
        "event_ts",
        "player_event",
        "click_details",
        "binge_type",
        "action",
        "device",
        C.normalize_title("raw_title").alias("title"),
        "video_id",
        "seconds_no_ads",
        F.lit(True).alias("is_video"),
    )


def video_times(videos: DataFrame, rules: RuleSet | str, from_date, to_date) -> DataFrame:
    """(account, day, time) of every cleaned play, for hot-key detection."""
    r = rule_set(rules)
    return clean_videos(videos, from_date, to_date).select(
        "account_id", "event_date", C.shift_seconds("event_ts", r.video_shift_seconds).alias("event_ts")
    )
