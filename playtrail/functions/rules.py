"""Rule sets R1..R4: one pipeline, four parameter tables.

The four historical versions of the attribution differ only in switches
(which click day, which classifier, which window keys, which label ladder).
A ``RuleSet`` holds those switches; ``R4`` is the default.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import columns as C


def _classify_r4(details: Column, player_event: Column, binge_type: Column) -> list[tuple[Column, str]]:
    # D6, on lower-cased details.
    d = details
    return [
        (d.like("%series%cue%up%auto%play%"), C.AUTO_PLAY),
        (F.lower(binge_type).like("%sle%binge%"), C.AUTO_PLAY),
        (d.like("%programme%cue%up%auto%play%"), C.AUTO_PLAY),
        (d.like("%series%cue%up%click%"), C.CLICKED_UP_NEXT),
        (d.like("%programme%cue%up%click%"), C.CLICKED_UP_NEXT),
        (player_event.like("%details:%") & d.isNotNull(), C.MANUAL),
        (d.like("%deeplink%"), C.MANUAL),
        (d.like("%rail%click%"), C.MANUAL),
    ]


def _classify_r2(details: Column, player_event: Column, binge_type: Column) -> list[tuple[Column, str]]:
    # D7, on raw (case-sensitive) details.
    d = details
    return [
        (d.like("%Series-cue-up%auto-play"), C.AUTO_PLAY),
        (d.like("%Programme-cue-up%auto-play"), C.AUTO_PLAY),
        (d.like("%cue%up%click"), C.CLICKED_UP_NEXT),
        (d.like("%dismiss"), C.DISMISS),
        (player_event.like("%details:%") & d.isNotNull(), C.MANUAL),
        (d.like("%deeplink%"), C.MANUAL),
        (d.like("rail%click"), C.MANUAL),
    ]


def _classify_r1(details: Column, player_event: Column, binge_type: Column) -> list[tuple[Column, str]]:
    # D8, on raw details.
    d = details
    return [
        (d.like("%auto-play"), C.AUTO_PLAY),
        (d.like("%cue%up%click"), C.CLICKED_UP_NEXT),
        (d.like("%dismiss"), C.DISMISS),
        (player_event.like("%details:%") & d.isNotNull(), C.MANUAL),
        (d.like("%deeplink%"), C.MANUAL),
        (d.like("rail%click"), C.MANUAL),
    ]


_CLASSIFIERS = {"r1": _classify_r1, "r2": _classify_r2, "r4": _classify_r4}


@C.reusable
def _classify_named(classifier: str, details: str, player_event: str, binge_type: str) -> Column:
    return C.first_match(_CLASSIFIERS[classifier](F.col(details), F.col(player_event), F.col(binge_type)))


@dataclass(frozen=True)
class RuleSet:
    name: str
    # Clicks.
    click_day_from_upstream: bool  # R4: day column of the clickstream, revised time
    lower_details: bool
    display_filter_contains: bool  # drop "%display%" (else only "%display")
    drop_episode_cue_up: bool
    with_binge_type: bool
    click_device: str  # "normalized" | "raw" | "blank"
    classifier: str  # "r1" | "r2" | "r4"
    drop_empty_titles: bool
    # Episode -> series map.
    stop_episodes: tuple[str, ...]
    post_map_exclusions: tuple[str, ...]
    linear_channel_names: tuple[str, ...]
    # Videos.
    video_shift_seconds: int
    video_device: str  # "normalized" | "raw"
    # Sequence.
    device_in_keys: bool
    popular_filter: bool
    # Labels and watch time.
    ladder: str  # "r1" | "r3" | "r4"
    split_watch_time: bool
    positive_only: bool
    output_columns: tuple[str, ...] = field(default=())
    # Page-name prefix of the app's details pages, e.g. "<app>:details:".
    details_page: str = "app:details:"

    def classify(self, details: Column, player_event: Column, binge_type: Column) -> Column:
        return C.first_match(_CLASSIFIERS[self.classifier](details, player_event, binge_type))

    def classify_columns(self, details: str, player_event: str, binge_type: str) -> Column:
        """``classify`` on named columns, built once per Spark context."""
        return _classify_named(self.classifier, details, player_event, binge_type)

    def with_details_page(self, prefix: str) -> "RuleSet":
        return replace(self, details_page=prefix)

    @property
    def sequence_keys(self) -> tuple[str, ...]:
        keys = ("account_id", "event_date")
        return keys + ("device",) if self.device_in_keys else keys


_R4_COLUMNS = (
    "account_id",
    "event_date",
    "event_ts",
    "player_event",
    "click_details",
    "binge_type",
    "last_action",
    "start_type",
    "device",
    "feeder_title",
    "feeder_video_id",
    "title",
    "video_id",
    "final_watch_time",
)
_R3_COLUMNS = _R4_COLUMNS[:-1] + ("seconds_no_ads", "island", "island_seconds", "final_watch_time")
_R2_COLUMNS = _R4_COLUMNS[:-1] + (
    "seconds_no_ads",
    "island",
    "island_seconds",
    "watch_time_start",
    "watch_time_carry",
    "final_watch_time",
)
_R1_COLUMNS = (
    "account_id",
    "event_date",
    "event_ts",
    "last_action",
    "start_type",
    "device",
    "feeder_title",
    "feeder_video_id",
    "title",
    "video_id",
    "seconds_no_ads",
    "watch_time",
)

R4 = RuleSet(
    name="R4",
    click_day_from_upstream=True,
    lower_details=True,
    display_filter_contains=True,
    drop_episode_cue_up=True,
    with_binge_type=True,
    click_device="normalized",
    classifier="r4",
    drop_empty_titles=True,
    stop_episodes=C.STOP_EPISODES + (C.SAME_NAME_TITLE,),
    post_map_exclusions=(),
    linear_channel_names=C.LINEAR_CHANNEL_NAMES,
    video_shift_seconds=0,
    video_device="normalized",
    device_in_keys=True,
    popular_filter=False,
    ladder="r4",
    split_watch_time=True,
    positive_only=True,
    output_columns=_R4_COLUMNS,
)

R3 = replace(
    R4,
    name="R3",
    click_day_from_upstream=False,
    stop_episodes=C.STOP_EPISODES,
    post_map_exclusions=(C.SAME_NAME_TITLE,),
    video_shift_seconds=-40,
    ladder="r3",
    positive_only=False,
    output_columns=_R3_COLUMNS,
)

R2 = replace(
    R3,
    name="R2",
    lower_details=False,
    display_filter_contains=False,
    drop_episode_cue_up=False,
    click_device="raw",
    classifier="r2",
    video_device="raw",
    device_in_keys=False,
    output_columns=_R2_COLUMNS,
)

R1 = replace(
    R2,
    name="R1",
    with_binge_type=False,
    click_device="blank",
    classifier="r1",
    drop_empty_titles=False,
    linear_channel_names=tuple(n for n in C.LINEAR_CHANNEL_NAMES if n != "kgwn2"),
    popular_filter=True,
    ladder="r1",
    split_watch_time=False,
    output_columns=_R1_COLUMNS,
)

RULE_SETS = {"R1": R1, "R2": R2, "R3": R3, "R4": R4}


def rule_set(name_or_rules: "str | RuleSet") -> RuleSet:
    if isinstance(name_or_rules, RuleSet):
        return name_or_rules
    return RULE_SETS[name_or_rules.upper()]
