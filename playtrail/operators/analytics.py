"""Reports on top of the attribution table: the two-title funnel
and the daily coverage monitor (C17).

All of them are aggregations with partial (map-side) aggregation; distinct
account counts are exact and planned as two-level aggregates, so a single
hot day or title is combined before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

STARTED_BY_PROMPT = (C.AUTO_PLAY, C.CLICKED_UP_NEXT)

WATCHED_SOURCE = "Watched Source Title"
AUTO_TO_REACHED = "Auto-played to Reached Title"
RETURNED = "Returned to watch Reached Title"


def _hours(seconds: Column) -> Column:
    return F.round(seconds / F.lit(3600), 2)


def _period(from_date, to_date) -> Column:
    return F.col("event_date").between(F.lit(str(from_date)).cast("date"), F.lit(str(to_date)).cast("date"))


def prompted_first_starts(attribution: DataFrame, source_title: str, reached_title: str, from_date, to_date) -> DataFrame:
    """A4: per account, the first start of the reached title that came from
    the source title by auto-play or an up-next click."""
    a = attribution.where(
        (F.col("final_watch_time") > 0)
        & F.col("start_type").isin(*STARTED_BY_PROMPT)
        & (F.col("title") == reached_title)
        & (F.col("feeder_title") == source_title)
        & _period(from_date, to_date)
    )
    return a.groupBy("account_id").agg(F.min("event_ts").alias("start"))


def manual_first_starts(attribution: DataFrame, reached_title: str, from_date, to_date) -> DataFrame:
    """A5: per account, the first manual start of the reached title and the
    hours of all its manual starts."""
    a = attribution.where(
        (F.col("final_watch_time") > 0)
        & (F.col("start_type") == C.MANUAL)
        & (F.col("title") == reached_title)
        & _period(from_date, to_date)
    )
    return a.groupBy("account_id").agg(
        F.min("event_ts").alias("start"), _hours(F.sum("final_watch_time")).alias("total_hours")
    )


def return_viewers(attribution: DataFrame, source_title: str, reached_title: str, from_date, to_date) -> DataFrame:
    """Accounts whose first manual start of the reached title comes after
    their first prompted start. Both sides have one row per account and are
    shuffled on it, so the join is co-partitioned."""
    auto = prompted_first_starts(attribution, source_title, reached_title, from_date, to_date)
    manual = manual_first_starts(attribution, reached_title, from_date, to_date)
    joined = auto.alias("i").join(
        manual.alias("m"), (F.col("i.account_id") == F.col("m.account_id")) & (F.col("i.start") < F.col("m.start"))
    )
    return joined.select(
        F.col("i.account_id").alias("account_id"),
        F.col("i.start").alias("prompted_start"),
        F.col("m.start").alias("manual_start"),
        F.col("m.total_hours").alias("total_hours"),
    )


def funnel_stages(
    attribution: DataFrame, videos: DataFrame, source_title: str, reached_title: str, from_date, to_date
) -> DataFrame:
    """The three stage rows (category, accounts, hours_watched)."""
    watched = videos.where(
        (F.lower("display_name") == source_title) & _period(from_date, to_date) & (F.col("seconds_no_ads") > 0)
    ).agg(
        F.lit(WATCHED_SOURCE).alias("category"),
        F.count_distinct("account_id").alias("accounts"),
        _hours(F.sum("seconds_no_ads")).alias("hours_watched"),
    )
    prompted = attribution.where(
        _period(from_date, to_date)
        & F.col("start_type").isin(*STARTED_BY_PROMPT)
        & (F.lower("feeder_title") == source_title)
        & (F.lower("title") == reached_title)
        & (F.col("final_watch_time") > 0)
    ).agg(
        F.lit(AUTO_TO_REACHED).alias("category"),
        F.count_distinct("account_id").alias("accounts"),
        _hours(F.sum("final_watch_time")).alias("hours_watched"),
    )
    returned = return_viewers(attribution, source_title, reached_title, from_date, to_date).agg(
        F.lit(RETURNED).alias("category"),
        F.count_distinct("account_id").alias("accounts"),
        F.round(F.sum("total_hours"), 2).alias("hours_watched"),
    )
    return watched.unionByName(prompted).unionByName(returned)


def funnel(attribution: DataFrame, videos: DataFrame, source_title: str, reached_title: str, from_date, to_date) -> DataFrame:
    """Stage rows with the eligible accounts (the next larger stage),
    take rate and hours per account. The window spans the three stage rows."""
    stages = funnel_stages(attribution, videos, source_title, reached_title, from_date, to_date)
    w = Window.orderBy(F.col("accounts").desc(), F.col("category"))
    with_prev = stages.select("*", F.lag("accounts").over(w).alias("eligible_accounts"))
    return with_prev.select(
        "category",
        "accounts",
        "eligible_accounts",
        F.round(F.try_divide(F.col("accounts"), F.col("eligible_accounts")), 2).alias("take_rate"),
        "hours_watched",
        F.round(F.try_divide(F.col("hours_watched"), F.col("accounts")), 2).alias("hours_per_account"),
    )


def coverage_monitor(attribution: DataFrame, videos: DataFrame, from_date, to_date) -> DataFrame:
    """C17: per day, accounts and hours in the attribution table against the
    video log, and their ratios (newest day first)."""
    attributed = (
        attribution.where(_period(from_date, to_date) & (F.col("final_watch_time") > 0))
        .groupBy("event_date")
        .agg(F.count_distinct("account_id").alias("accts"), _hours(F.sum("final_watch_time")).alias("watched_hours"))
    )
    logged = (
        videos.where(_period(from_date, to_date) & (F.col("seconds_no_ads") > 0))
        .groupBy("event_date")
        .agg(F.count_distinct("account_id").alias("sv_accts"), _hours(F.sum("seconds_no_ads")).alias("sv_watch_hours"))
    )
    return coverage_ratios(attributed, logged)


def coverage_ratios(attributed: DataFrame, logged: DataFrame) -> DataFrame:
    """The day's accounts and hours of both tables and their ratios, newest day first."""
    joined = attributed.join(logged, "event_date", "left")
    return joined.select(
        "event_date",
        "accts",
        "watched_hours",
        "sv_accts",
        "sv_watch_hours",
        F.round(F.try_divide(F.col("accts"), F.col("sv_accts")), 2).alias("acct_prc"),
        F.round(F.try_divide(F.col("watched_hours"), F.col("sv_watch_hours")), 2).alias("hours_prc"),
    ).orderBy(F.col("event_date").desc())
