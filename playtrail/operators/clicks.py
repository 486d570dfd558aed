"""Click side of the timeline: clean and classify clicks (C1), build the
episode -> series map from one day of the video log (C2) and apply it (C3).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import RuleSet, rule_set
from ..plans.guards import DEFAULT_MAX_BROADCAST_ROWS, fits, materialize
from ..sources.readers import HIT_DAY


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def coarse_utc_bound(column: str, from_date, to_date):
    """Local days [from, to] lie inside UTC [from - 1 day, to + 2 days).

    This bound is a plain comparison on the stored column, so it reaches the
    Parquet scan as a pushed filter; the exact local-day test stays on top.
    """
    lo = _as_date(from_date) - dt.timedelta(days=1)
    hi = _as_date(to_date) + dt.timedelta(days=2)
    c = F.col(column)
    return (c >= F.lit(lo.isoformat()).cast("timestamp_ntz")) & (c < F.lit(hi.isoformat()).cast("timestamp_ntz"))


def _hit_in_period(clicks: DataFrame, from_date, to_date, tz: str):
    """Hit on a local day of the period, with the bounds that reach the scan:
    on the stored time, and on the day partitions where the table has them."""
    lo, hi = _as_date(from_date), _as_date(to_date)
    cond = coarse_utc_bound("hit_ts", lo, hi) & C.local_date("hit_ts", tz).between(F.lit(lo), F.lit(hi))
    if HIT_DAY in clicks.columns:
        day = dt.timedelta(days=1)
        cond = cond & F.col(HIT_DAY).between(F.lit(lo - day), F.lit(hi + day))
    return cond


def clean_clicks(clicks: DataFrame, rules: RuleSet | str, from_date, to_date, tz: str = C.NEW_YORK) -> DataFrame:
    """S1 + P13: null guards, ``display`` and episode cue-up clicks, period."""
    r = rule_set(rules)
    raw = F.col("click_details")
    cond = F.col("account_id").isNotNull() & F.col("hit_ts").isNotNull() & raw.isNotNull()
    cond = cond & ~(raw.like("%display%") if r.display_filter_contains else raw.like("%display"))
    if r.drop_episode_cue_up:
        cond = cond & ~F.lower(raw).like("%episode%cue%up%")
    return clicks.where(cond & _hit_in_period(clicks, from_date, to_date, tz))


def _click_day_ts(r: RuleSet, tz: str):
    if r.click_day_from_upstream:
        return F.col("event_date"), C.local_ts("revised_ts", tz)
    return C.local_date("hit_ts", tz), C.local_ts("hit_ts", tz)


def click_times(clicks: DataFrame, rules: RuleSet | str, from_date, to_date, tz: str = C.NEW_YORK) -> DataFrame:
    """(account, day, time) of every click of the period: a superset of the
    timeline's click rows, used to find hot account-days. It skips the
    details filters so the scan reads only the account and time columns."""
    r = rule_set(rules)
    day, ts = _click_day_ts(r, tz)
    cond = F.col("account_id").isNotNull() & F.col("hit_ts").isNotNull() & _hit_in_period(clicks, from_date, to_date, tz)
    return clicks.where(cond).select("account_id", day.alias("event_date"), ts.alias("event_ts"))


def classify_clicks(clicks: DataFrame, rules: RuleSet | str, tz: str = C.NEW_YORK) -> DataFrame:
    """D2, D4, D6-D9 on cleaned clicks: one row per click, label and raw title."""
    r = rule_set(rules)
    details = F.lower("click_details") if r.lower_details else F.col("click_details")
    binge_type = C.first_segment("binge_source") if r.with_binge_type else F.lit(None).cast("string")
    day, ts = _click_day_ts(r, tz)
    device = {
        "normalized": C.normalize_click_device("device"),
        "raw": F.col("device"),
        "blank": F.lit(""),
    }[r.click_device]
    staged = clicks.select(
        "account_id",
        day.alias("event_date"),
        ts.alias("event_ts"),
        "player_event",
        details.alias("click_details"),
        binge_type.alias("binge_type"),
        device.alias("device"),
    )
    return staged.select(
        "*",
        r.classify_columns("click_details", "player_event", "binge_type").alias("action"),
        C.extract_click_title("player_event", "click_details", r.details_page).alias("raw_title"),
    )


def prepare_clicks(clicks: DataFrame, rules: RuleSet | str, from_date, to_date, tz: str = C.NEW_YORK) -> DataFrame:
    """Cleaned, classified clicks that name a title, in timeline columns."""
    r = rule_set(rules)
    labelled = classify_clicks(clean_clicks(clicks, r, from_date, to_date, tz), r, tz)
    keep = F.col("action").isNotNull() & F.col("raw_title").isNotNull()
    if r.drop_empty_titles:
        keep = keep & (F.col("raw_title") != "")
    return labelled.where(keep).select(
        "account_id",
        "event_date",
        "event_ts",
        "player_event",
        "click_details",
        "binge_type",
        "action",
        "device",
        C.normalize_title("raw_title").alias("title"),
        F.lit("").alias("video_id"),
        F.lit(None).cast("double").alias("seconds_no_ads"),
        F.lit(False).alias("is_video"),
    )


def _plays_per_series(videos: DataFrame, rules: RuleSet | str, day: Column, keys: list[Column]) -> DataFrame:
    """Plays of the days that ``day`` holds for, per ``keys``, episode and series."""
    r = rule_set(rules)
    plays = videos.where(day & F.col("episode_title").isNotNull() & ~F.lower("episode_title").isin(*r.stop_episodes))
    series = F.when(C.is_linear_channel("display_name", r.linear_channel_names), F.lit(None)).otherwise(
        C.normalize_title("display_name")
    )
    return plays.groupBy(*keys, C.normalize_title("episode_title").alias("episode"), series.alias("series")).agg(
        F.count("display_name").alias("display_count")
    )


def series_counts(videos: DataFrame, map_date, rules: RuleSet | str = "R4") -> DataFrame:
    """A1 + D10 + D15: plays per (episode, series) on one day of the video log."""
    return _plays_per_series(videos, rules, F.col("event_date") == F.lit(str(map_date)).cast("date"), [])


def _most_played(counts: DataFrame, rules: RuleSet | str, keys: list[str]) -> DataFrame:
    r = rule_set(rules)
    counts = counts.where(F.col("series").isNotNull() & F.col("episode").isNotNull() & (F.col("episode") != "n/a"))
    rank = F.dense_rank().over(Window.partitionBy(*keys, "episode").orderBy(F.col("display_count").desc()))
    top = counts.select(*keys, "episode", "series", rank.alias("rk")).where(F.col("rk") == 1)
    if r.post_map_exclusions:
        top = top.where(~F.col("episode").isin(*r.post_map_exclusions))
    return top.select(*keys, "episode", "series")


def build_series_map(videos: DataFrame, map_date, rules: RuleSet | str = "R4") -> DataFrame:
    """The most played series of each episode title (ties kept).

    The rank sits under an ``rk = 1`` filter, which Spark turns into a
    per-partition group limit before the shuffle. The input is one day of
    the log grouped by title, so the map grows with the catalogue, not with
    the number of plays.
    """
    return _most_played(series_counts(videos, map_date, rules), rules, [])


def build_daily_series_maps(videos: DataFrame, days, rules: RuleSet | str = "R4", lag_days: int = 0) -> DataFrame:
    """C2 for many days at once: (event_date, episode, series), the map that applies to each
    of ``days``, built from the day ``lag_days`` before it. One scan and one shuffle
    for all days; grouped by (day, title), so it grows with the catalogue and the days."""
    sources = [d - dt.timedelta(days=lag_days) for d in map(_as_date, days)]
    applies = F.date_add("event_date", lag_days).alias("event_date")
    counts = _plays_per_series(videos, rules, F.col("event_date").isin(*map(F.lit, sources)), [applies])
    return _most_played(counts, rules, ["event_date"])


# Shares of a title's clicks in a shuffled map join.
MAP_SALTS = 16


def apply_series_map(
    clicks: DataFrame, series_map: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
) -> DataFrame:
    """Replace an episode title by its series; ties duplicate the click.

    A map with an ``event_date`` holds a map for each day, and a click meets that of its own day.
    The map is broadcast when its checked size allows, so the click side is not shuffled for
    this join. Above that bound both sides are shuffled by title and a salt: a title's clicks
    are dealt out to ``MAP_SALTS`` shares, and the map, which is as large as the catalogue, is
    repeated for each, so a title that half of all clicks name is no task's own.
    """
    daily = "event_date" in series_map.columns
    side = materialize(series_map)
    small, _ = fits(side, max_broadcast_rows)
    day = [F.col("event_date").alias("_map_day")] if daily else []
    m = side.select(F.col("episode").alias("_episode"), F.col("series").alias("_series"), *day)
    left, columns = clicks, clicks.columns
    if small:
        m = F.broadcast(m)
    else:
        share = F.pmod(F.xxhash64("account_id", "event_ts", "click_details"), F.lit(MAP_SALTS)).cast("int")
        left = clicks.withColumn("_share", share)
        m = m.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(MAP_SALTS - 1))))
    on = left["title"] == m["_episode"]
    if daily:
        on = on & (left["event_date"] == m["_map_day"])
    if not small:
        on = on & (left["_share"] == m["_salt"])
    joined = left.join(m, on, "left")
    return joined.select(*[F.coalesce("_series", left["title"]).alias("title") if c == "title" else left[c] for c in columns])
