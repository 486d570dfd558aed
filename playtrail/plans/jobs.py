"""End-to-end jobs: what the original runs by hand, as table-to-table Spark jobs.

* ``attribution_job``  build a date range with a rule set and write the table
* ``daily_reload_job`` recompute one day (default: yesterday in New York)
* ``delete_day_job``   remove one day's rows
* ``prune_job``        drop the working columns of a saved table
* ``ordered_job``      write a saved table as one totally ordered result
* ``monitor_job``      write the daily coverage monitor table
* ``funnel_job``       the two-title funnel as a small result DataFrame

Inputs are tables (clickstream, video log, attribution) by path or by catalog
name, read with the typed readers so only used columns are scanned.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from ..functions import columns as C
from ..functions.rules import RuleSet, rule_set
from ..operators import analytics as A
from ..operators import maintenance as M
from ..operators.attribution import build_attribution, presentation_order
from ..sources.readers import read_attribution, read_clickstream, read_video_log


def yesterday(tz: str = C.NEW_YORK) -> dt.date:
    """The daily job's default day: yesterday in ``tz``."""
    return dt.datetime.now(ZoneInfo(tz)).date() - dt.timedelta(days=1)


def _rules(rules: RuleSet | str, details_page: str | None) -> RuleSet:
    """The rule set with the app's details-page prefix, which has no default:
    with a wrong one, titles would be wrong without a word."""
    if details_page is not None:
        return rule_set(rules).with_details_page(details_page)
    if isinstance(rules, RuleSet):
        return rules
    raise ValueError("details_page is required: the page-name prefix of the app's details pages")


def attribution_job(
    spark: SparkSession,
    clickstream_path: str,
    video_log_path: str,
    out_path: str,
    rules: RuleSet | str = "R4",
    *,
    from_date,
    to_date,
    map_date=None,
    details_page: str | None = None,
    **build_kwargs,
) -> None:
    """Create or replace the attribution table for ``[from_date, to_date]``.

    ``map_date`` defaults to ``to_date`` (the original builds its map from
    the last finished day)."""
    r = _rules(rules, details_page)
    clicks = read_clickstream(spark, clickstream_path)
    videos = read_video_log(spark, video_log_path)
    built = build_attribution(
        clicks, videos, r, from_date=from_date, to_date=to_date, map_date=map_date or to_date, **build_kwargs
    )
    M.save_table(built, out_path)


def daily_reload_job(
    spark: SparkSession,
    clickstream_path: str,
    video_log_path: str,
    table_path: str,
    day=None,
    rules: RuleSet | str = "R3",
    *,
    map_date=None,
    details_page: str | None = None,
    **build_kwargs,
) -> dt.date:
    """Recompute one day of the table (default: yesterday); returns the day.

    ``map_date`` defaults to the reloaded day."""
    r = _rules(rules, details_page)
    day = yesterday() if day is None else (day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day)))
    M.reload_day(
        read_clickstream(spark, clickstream_path), read_video_log(spark, video_log_path), table_path, day, r,
        map_date=map_date, **build_kwargs,
    )
    return day


def delete_day_job(spark: SparkSession, table_path: str, day) -> None:
    """Remove one day from the table."""
    M.delete_day(spark, table_path, dt.date.fromisoformat(str(day)))


def prune_job(spark: SparkSession, table_path: str) -> None:
    """Drop the working columns of the table."""
    M.prune_table(spark, table_path)


def ordered_job(spark: SparkSession, attribution_path: str, out_path: str, rules: RuleSet | str = "R4") -> None:
    """The table in the original's final order: the files of ``out_path`` hold it by name."""
    presentation_order(read_attribution(spark, attribution_path), rules).write.mode("overwrite").parquet(out_path)


def monitor_job(
    spark: SparkSession, attribution_path: str, video_log_path: str, out_path: str, *, from_date, to_date
) -> None:
    """Create or replace the (small, one row per day) coverage monitor table."""
    report = A.coverage_monitor(
        read_attribution(spark, attribution_path), read_video_log(spark, video_log_path), from_date, to_date
    )
    report.write.mode("overwrite").parquet(out_path)


def funnel_job(
    spark: SparkSession,
    attribution_path: str,
    video_log_path: str,
    source_title: str,
    reached_title: str,
    *,
    from_date,
    to_date,
) -> DataFrame:
    """The funnel's three stage rows for two (normalised) titles."""
    return A.funnel(
        read_attribution(spark, attribution_path),
        read_video_log(spark, video_log_path),
        source_title,
        reached_title,
        from_date,
        to_date,
    )
