"""Labels and watch time (C9-C13) and the end-to-end build (C14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import RuleSet, rule_set
from ..plans.guards import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast
from ..sources.readers import HIT_DAY
from .clicks import _as_date, apply_series_map, build_daily_series_maps, build_series_map, click_times, prepare_clicks
from .sequence import DEFAULT_HOT_KEY_ROWS, sequence_timeline
from .videos import prepare_videos, video_times

def _c(name: str) -> Column:
    return F.col(name)


@C.reusable
def start_label(rules: RuleSet | str) -> Column:
    """The rule ladder of a rule set (first true arm wins)."""
    r = rule_set(rules)
    feeder, title, action, last = _c("feeder_title"), _c("title"), _c("action"), _c("last_action")
    seconds, island = _c("seconds_no_ads"), _c("island_seconds")
    no_feeder = C.blank_or_null(feeder)
    trailer_feeder = feeder.like("%trailer%")
    plain_end = action == C.VIDEO_END
    if r.ladder == "r4":
        return C.first_match(
            [
                (no_feeder & seconds.isNotNull(), C.MANUAL),
                (trailer_feeder, C.MANUAL),
                (last.like("%Manual%") & plain_end, C.MANUAL),
                (
                    (last == C.AUTO_PLAY)
                    & plain_end
                    & ~trailer_feeder
                    & (_c("prev_title") == title)
                    & (feeder != title),
                    C.AUTO_PLAY,
                ),
                ((last == C.CLICKED_UP_NEXT) & plain_end & ~trailer_feeder & (feeder != title), C.CLICKED_UP_NEXT),
                # The "auto-play click without a feeder" arm gives the default label.
            ],
            F.lit(C.MANUAL),
        )
    if r.ladder == "r3":
        return C.first_match(
            [
                (no_feeder & seconds.isNotNull(), C.MANUAL),
                (trailer_feeder, C.MANUAL),
                (last.like("%Manual%") & plain_end, C.MANUAL),
                ((last == C.AUTO_PLAY) & plain_end & ~trailer_feeder & (feeder != title), C.AUTO_PLAY),
                ((last == C.CLICKED_UP_NEXT) & plain_end & ~trailer_feeder, C.CLICKED_UP_NEXT),
                ((feeder != title) & (island > 0) & seconds.isNotNull(), C.AUTO_PLAY),
                ((feeder != title) & (feeder != "") & (island == 0) & (seconds > 30), C.UNATTRIBUTED),
            ],
            F.lit(C.MANUAL),
        )
    # The default keeps the input action.
    return C.first_match(
        [
            (feeder.isNull() & seconds.isNotNull(), C.MANUAL),
            (trailer_feeder, C.MANUAL),
            (last.like("%Manual%") & plain_end, C.MANUAL),
            ((last == C.AUTO_PLAY) & plain_end & ~trailer_feeder, C.AUTO_PLAY),
            ((last == C.CLICKED_UP_NEXT) & plain_end & ~trailer_feeder, C.CLICKED_UP_NEXT),
            ((feeder != title) & (island > 0) & seconds.isNotNull(), C.AUTO_PLAY),
            ((feeder != title) & (feeder != "") & (island == 0) & (seconds <= 30), C.AUTO_PLAY),
            ((feeder != title) & (feeder != "") & (island == 0) & (seconds > 30), C.UNATTRIBUTED),
            ((action == C.AUTO_PLAY) & no_feeder, C.MANUAL),
        ],
        action,
    )


@C.reusable
def watch_time_start() -> Column:
    """A start is credited its own seconds plus its island's."""
    feeder, title = _c("feeder_title"), _c("title")
    credited = F.coalesce(_c("seconds_no_ads"), F.lit(0.0)) + _c("island_seconds")
    return F.when(C.blank_or_null(feeder) | (feeder != title), credited).otherwise(F.lit(0.0))


@C.reusable
def watch_time_carry() -> Column:
    """C11: an island that continues a title first seen on another device."""
    prev_feeder = _c("prev_feeder")
    cond = (_c("prev_title") != _c("title")) & C.blank_or_null(prev_feeder) & (_c("feeder_title") == _c("title"))
    return F.when(cond, _c("island_seconds")).otherwise(F.lit(0.0))


def corrected_start(start: Column) -> Column:
    """Two clicks in a row, or an unplayed row before another title, get 0."""
    feeder = _c("feeder_title")
    cond = ((feeder == "") & (_c("next_feeder") == "")) | (
        (_c("title") != _c("next_title")) & _c("seconds_no_ads").isNull()
    )
    return F.when(cond, F.lit(0.0)).otherwise(start)


@C.reusable
def single_watch_time() -> Column:
    """R1's one-column watch time."""
    feeder = _c("feeder_title")
    credited = F.coalesce(_c("seconds_no_ads"), F.lit(0.0)) + _c("island_seconds")
    return F.when(feeder.isNull() | (feeder != _c("title")), credited).otherwise(F.lit(0.0))


def label_and_credit(seq: DataFrame, rules: RuleSet | str) -> DataFrame:
    """C9-C13 on a sequenced timeline; all columns stay available."""
    r = rule_set(rules)
    if not r.split_watch_time:
        return seq.select("*", start_label(r).alias("start_type"), single_watch_time().alias("watch_time"))
    staged = seq.select(
        "*",
        start_label(r).alias("start_type"),
        corrected_start(watch_time_start()).alias("watch_time_start"),
        watch_time_carry().alias("watch_time_carry"),
    )
    return staged.select("*", (_c("watch_time_start") + _c("watch_time_carry")).alias("final_watch_time"))


def popular_titles(videos: DataFrame, from_date, to_date, min_accounts: int) -> DataFrame:
    """A2 + J5: per day, titles with at least ``min_accounts`` viewers that
    are not linear channels. Exact distinct counts (two-level aggregate)."""
    played = videos.where(
        (_c("seconds_no_ads") > 0) & C.in_range("event_date", F.lit(str(from_date)).cast("date"), F.lit(str(to_date)).cast("date"))
    )
    counts = played.groupBy("event_date", C.video_title("display_name", "program").alias("raw_title")).agg(
        F.count_distinct("account_id").alias("accounts")
    )
    popular = counts.where((_c("accounts") >= min_accounts) & _c("raw_title").isNotNull()).select(
        "event_date", C.normalize_title("raw_title").alias("title")
    )
    return without_channels(popular, videos, from_date, to_date)


def without_channels(popular: DataFrame, videos: DataFrame, from_date, to_date) -> DataFrame:
    """Titles of a day that are not names of its linear channels."""
    channels = linear_channels(videos, from_date, to_date)
    # Neither side holds NULLs, so NOT IN is an anti join here.
    return popular.join(
        channels,
        (popular["event_date"] == channels["event_date"]) & (popular["title"] == channels["channel"]),
        "left_anti",
    )


def linear_channels(videos: DataFrame, from_date, to_date) -> DataFrame:
    """A3: distinct (day, normalised content channel) of the video log."""
    return (
        videos.where(
            C.in_range("event_date", F.lit(str(from_date)).cast("date"), F.lit(str(to_date)).cast("date"))
            & (_c("content_channel") != "N/A")
        )
        .select("event_date", C.normalize_title("content_channel").alias("channel"))
        .distinct()
    )


def popular_side(popular: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The popular list, written once. It is bounded by the catalogue; when its
    checked size allows it is broadcast, which keeps the timeline's partitioning."""
    side, _ = bounded_broadcast(popular.select("event_date", "title"), max_broadcast_rows, materialize_first=True)
    return side


def keep_popular(df: DataFrame, popular: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Keep timeline rows whose title is popular on their day."""
    return df.join(popular_side(popular, max_broadcast_rows), ["event_date", "title"], "left_semi")


def timeline_rows(
    clicks: DataFrame,
    videos: DataFrame,
    rules: RuleSet | str,
    from_date,
    to_date,
    map_date,
    *,
    series_map: DataFrame | None = None,
    tz: str = C.NEW_YORK,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Mapped clicks and cleaned videos as one (unpartitioned) timeline. The map
    is ``series_map``, or that of ``map_date``."""
    r = rule_set(rules)
    ready = prepare_clicks(clicks, r, from_date, to_date, tz)
    if series_map is None:
        series_map = build_series_map(videos, map_date, r)
    mapped = apply_series_map(ready, series_map, max_broadcast_rows)
    return mapped.unionByName(prepare_videos(videos, r, from_date, to_date))


def sequenced(
    clicks: DataFrame,
    videos: DataFrame,
    rules: RuleSet | str,
    from_date,
    to_date,
    map_date,
    *,
    series_map: DataFrame | None = None,
    min_accounts: int = 10_000,
    tz: str = C.NEW_YORK,
    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
    hot_keys: DataFrame | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The timeline with feeder, last action and islands."""
    r = rule_set(rules)
    timeline = timeline_rows(
        clicks, videos, r, from_date, to_date, map_date,
        series_map=series_map, tz=tz, max_broadcast_rows=max_broadcast_rows,
    )
    between = None
    if r.popular_filter:
        popular = popular_titles(videos, from_date, to_date, min_accounts)
        side = popular_side(popular, max_broadcast_rows)

        def between(df: DataFrame) -> DataFrame:
            return df.join(side, ["event_date", "title"], "left_semi")

    times = None
    if hot_key_rows is not None and hot_keys is None:
        times = click_times(clicks, r, from_date, to_date, tz).unionByName(
            video_times(videos, r, from_date, to_date)
        )
    return sequence_timeline(
        timeline,
        r.sequence_keys,
        between=between,
        times=times,
        hot_key_rows=hot_key_rows,
        hot_keys=hot_keys,
        max_broadcast_rows=max_broadcast_rows,
    )


def build_attribution(
    clicks: DataFrame,
    videos: DataFrame,
    rules: RuleSet | str = "R4",
    *,
    from_date,
    to_date,
    map_date=None,
    series_map: DataFrame | None = None,
    min_accounts: int = 10_000,
    tz: str = C.NEW_YORK,
    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
    hot_keys: DataFrame | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    all_columns: bool = False,
) -> DataFrame:
    """C14: label every video start in ``[from_date, to_date]`` and credit
    its watch time.

    ``map_date`` is the day of the video log the episode -> series map is
    built from, unless a ``series_map`` is given. ``min_accounts`` is R1's popularity threshold (per day).
    R1 is run for every day of the range; it is the union of its daily runs.
    ``hot_keys`` (``hot_keys.known``) spares the look for account-days above
    ``hot_key_rows``, which reads both inputs' account and time columns.
    """
    if map_date is None and series_map is None:
        raise ValueError("map_date or series_map is required")
    r = rule_set(rules)
    seq = sequenced(
        clicks,
        videos,
        r,
        from_date,
        to_date,
        map_date,
        series_map=series_map,
        min_accounts=min_accounts,
        tz=tz,
        hot_key_rows=hot_key_rows,
        hot_keys=hot_keys,
        max_broadcast_rows=max_broadcast_rows,
    )
    out = label_and_credit(seq, r)
    if r.positive_only:
        out = out.where(_c("final_watch_time") > 0)
    if all_columns:
        return out
    return out.select(*r.output_columns)


def build_days(
    clicks: DataFrame,
    videos: DataFrame,
    days,
    rules: RuleSet | str = "R3",
    *,
    map_date=None,
    map_lag_days: int = 0,
    tz: str = C.NEW_YORK,
    **build_kwargs,
) -> DataFrame:
    """C18 for any number of days in one build: the rows of every day as a build of that day
    alone gives them, with the map of ``map_lag_days`` before each day (or of ``map_date``
    for all).

    Each input is scanned once, on the day folders of these days only, and each row is
    shuffled once, however many days there are. Where a rule set takes a click's day from
    upstream, its clicks may have been hit a day earlier or later; these are read too.
    """
    r = rule_set(rules)
    days = sorted({_as_date(d) for d in days})
    around = dt.timedelta(days=1 if r.click_day_from_upstream else 0)
    near = sorted({d + dt.timedelta(days=i) for d in days for i in (-1, 0, 1)})
    click_day = _c("event_date") if r.click_day_from_upstream else C.local_date("hit_ts", tz)
    own_clicks = clicks.where(click_day.isin(*map(F.lit, days)))
    if HIT_DAY in clicks.columns:
        # The UTC day of a hit lies within a day of its local day.
        hit_days = near if not around else sorted({d + i * around for d in near for i in (-1, 0, 1)})
        own_clicks = own_clicks.where(_c(HIT_DAY).isin(*map(F.lit, hit_days)))
    if map_date is not None:
        series_map = build_series_map(videos, map_date, r)
    else:
        series_map = build_daily_series_maps(videos, days, r, map_lag_days)
    built = build_attribution(
        own_clicks,
        videos.where(_c("event_date").isin(*map(F.lit, days))),
        r,
        from_date=days[0] - around,
        to_date=days[-1] + around,
        series_map=series_map,
        tz=tz,
        **build_kwargs,
    )
    return built.where(_c("event_date").isin(*map(F.lit, days)))


def presentation_order(df: DataFrame, rules: RuleSet | str) -> DataFrame:
    """O1/O2: the original's final ORDER BY (account, day[, device], time).

    A total order is a range shuffle of the whole result; use it for
    displayed results only. Saved tables are clustered per file instead
    (``maintenance.save_table``).
    """
    r = rule_set(rules)
    keys = ["account_id", "event_date"] + (["device"] if r.ladder == "r3" and r.device_in_keys else []) + ["event_ts"]
    return df.orderBy(*keys)
