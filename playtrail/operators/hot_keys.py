"""Hot account-days from mergeable sketches.

An account-day with very many rows needs the chunked plan (``sequence``). Which ones there are is a
question of heavy hitters: a frequent-items sketch for each day, one state per task and day, answers
it without a shuffle of all (account, day) pairs. Its answer is a superset: every account-day above the
threshold is in it, and one that is in it without need is only planned with more care. A sketch that
tracks T accounts is off by less than 8 / T of its rows; a day with more rows than T / 8 thresholds is
counted exactly instead.

States are mergeable, so they can be kept: ``keep`` stores those of each day beside the tables, as days
land, and ``known`` reads a period's hot account-days from them. Builds that are given these
(``hot_keys=``) don't look at the inputs for them at all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import RuleSet, rule_set
from ..plans.guards import DEFAULT_MAX_BROADCAST_ROWS, fits, materialize
from . import versions as V
from .clicks import _as_date, click_times
from .videos import video_times

BASE_KEYS = ("account_id", "event_date")
TRACKED = 10_000
MARGIN = 8  # a sketch is off by less than MARGIN / tracked of its rows


def count_hot(times: DataFrame, hot_key_rows: int) -> DataFrame:
    """Account-days with more than ``hot_key_rows`` rows, by counting all: one partial aggregation, so a
    hot key costs one row per task, and a shuffle of all account-days."""
    counts = times.groupBy(*BASE_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > hot_key_rows).select(*BASE_KEYS)


def sketch_days(times: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(event_date, state, n): a frequent-items sketch of the accounts of every day, and its rows."""
    return times.groupBy("event_date").agg(
        F.expr(f"approx_top_k_accumulate(account_id, {tracked})").alias("state"), F.count(F.lit(1)).alias("n")
    )


def _candidates(sketches: DataFrame, hot_key_rows: int, tracked: int) -> DataFrame:
    """(account_id, event_date, _uncertain): accounts that may be above the threshold; a day whose sketch
    can't tell has one row, without an account."""
    uncertain = F.col("n") > F.lit(hot_key_rows * tracked // MARGIN).cast("long")
    found = F.filter(F.expr(f"approx_top_k_estimate(state, {tracked})"), lambda x: x["count"] > hot_key_rows)
    accounts = F.when(uncertain, F.array(F.lit(None).cast("string"))).otherwise(F.transform(found, lambda x: x["item"]))
    return sketches.select(F.explode(accounts).alias("account_id"), "event_date", uncertain.alias("_uncertain"))


def _on_days(name: str, days: list[dt.date | None]) -> Column:
    """Is the day one of ``days`` (None: no day)? One list, not a comparison for each day: below a projection
    each comparison would work the day out again, for clicks from the time zone."""
    on = F.col(name).isin([d for d in days if d is not None])
    return on | F.col(name).isNull() if None in days else on


def look(
    times: DataFrame, hot_key_rows: int, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, tracked: int = TRACKED
) -> tuple[DataFrame, bool, int]:
    """(hot, is it small enough to broadcast, rows): a superset of the account-days with more than ``hot_key_rows``
    rows, written.

    ``times`` holds ``account_id, event_date`` of the timeline rows, or of a superset of them."""
    found = materialize(_candidates(sketch_days(times, tracked), hot_key_rows, tracked))
    small, rows, uncertain = fits(found, max_broadcast_rows, also=F.max("_uncertain"))
    if not uncertain:
        return found.select(*BASE_KEYS), small, rows
    days = [r.event_date for r in found.where("_uncertain").select("event_date").distinct().collect()]
    counted = count_hot(times.where(_on_days("event_date", days)), hot_key_rows)
    hot = materialize(found.where(~F.col("_uncertain")).select(*BASE_KEYS).unionByName(counted))
    return hot, *fits(hot, max_broadcast_rows)


def hot_account_days(times: DataFrame, hot_key_rows: int, tracked: int = TRACKED) -> DataFrame:
    """The hot account-days of ``look``."""
    return look(times, hot_key_rows, tracked=tracked)[0]


def keep(
    clicks: DataFrame, videos: DataFrame, path: str, days, rules: RuleSet | str = "R4", *,
    tracked: int = TRACKED, tz: str = C.NEW_YORK,
) -> None:
    """Store the sketches of ``days`` (replacing theirs) in the versioned table at ``path``. Rule sets that take a click's
    day from upstream need a table of their own."""
    days = sorted({_as_date(d) for d in days})
    r = rule_set(rules)
    times = click_times(clicks, r, days[0], days[-1], tz).unionByName(video_times(videos, r, days[0], days[-1]))
    own = times.where(F.col("event_date").isin(*map(F.lit, days)))
    V.replace_days(sketch_days(own, tracked).select("state", "n", "event_date"), path, days)


def known(spark: SparkSession, path: str, from_date, to_date, hot_key_rows: int) -> DataFrame | None:
    """The hot account-days (a superset) of a period from kept sketches, or None where they can't tell: a day
    of the period has none, or one that is too coarse for the threshold."""
    if not V.is_versioned(spark, path):
        return None
    first, last = _as_date(from_date), _as_date(to_date)
    kept = V.snapshot(spark, path)["days"]
    if any(str(first + dt.timedelta(days=i)) not in kept for i in range((last - first).days + 1)):
        return None
    sketches = V.read(spark, path).where(F.col("event_date").between(F.lit(first), F.lit(last)))
    head = sketches.select("state.maxItemsTracked").first()
    tracked = head[0] if head else TRACKED
    found = materialize(_candidates(sketches, hot_key_rows, tracked))
    return None if not found.where("_uncertain").isEmpty() else found.select(*BASE_KEYS)

