"""Many days in one build: the same rows as a build of each day, one shuffle of the inputs, one commit."""

import datetime as dt
import re
import uuid
from functools import reduce

import pytest
from pyspark.sql import functions as F

from playtrail.functions.rules import R1, R3, R4, rule_set
from playtrail.operators import maintenance as M
from playtrail.operators import versions as V
from playtrail.operators.attribution import build_attribution, build_days
from playtrail.operators.clicks import apply_series_map, build_daily_series_maps, build_series_map, prepare_clicks
from playtrail.plans.catalog import PARAMS
from playtrail.plans.guards import checkpoint_dir
from playtrail.sources.fixture import fixture_tables

from .conftest import SF_SMALL

DAYS = [dt.date(2024, 1, d) for d in (9, 10, 11, 20)]


def same(a, b):
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("rules,lag", [(R3, 0), (R3, 1), (R1, 0), (R4, 0)])
def test_days_equal_builds_of_each_day(spark, rules, lag):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    one = dt.timedelta(days=1)
    around = one if rules.click_day_from_upstream else 0 * one
    each = [
        build_attribution(
            clicks, videos, rules, from_date=d - around, to_date=d + around, map_date=d - lag * one, min_accounts=2
        ).where(F.col("event_date") == F.lit(d))
        for d in DAYS
    ]
    built = build_days(clicks, videos, DAYS, rules, map_lag_days=lag, min_accounts=2)
    same(built, reduce(lambda a, b: a.unionByName(b), each))


def test_one_scan_and_one_shuffle_however_many_days(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    built = build_days(clicks, videos, days, R4, hot_key_rows=None)
    text = built._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*hit_ts", text)) == 1
    assert len(re.findall(r"FileScan parquet [^\n]*media_load", text)) == 1
    assert len([e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "account_id" in e]) == 2
    # Days far apart: only their own folders are read.
    far = build_days(clicks, videos, [days[0], days[-1]], R3, hot_key_rows=None)
    text = far._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ (IN|INSET) ", text)
    assert re.search(r"PartitionFilters: \[[^\]]*hit_day#\d+ (IN|INSET) ", text)


def test_daily_maps_equal_the_maps_of_each_day(spark):
    _, videos = fixture_tables(spark, SF_SMALL)
    for rules in ("R3", "R4"):
        daily = build_daily_series_maps(videos, DAYS, rules, lag_days=2)
        for d in DAYS:
            same(
                daily.where(F.col("event_date") == F.lit(d)).drop("event_date"),
                build_series_map(videos, d - dt.timedelta(days=2), rules),
            )


@pytest.mark.parametrize("daily", [False, True])
def test_map_join_above_the_broadcast_bound_deals_out_a_hot_title(spark, daily):
    """One title holds half of all clicks: its rows take several shares, and the rows are the same."""
    clicks, videos = fixture_tables(spark, SF_SMALL)
    ready = prepare_clicks(clicks, rule_set("R4"), PARAMS["from_date"], PARAMS["to_date"])
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)]
    maps = build_daily_series_maps(videos, days, "R4") if daily else build_series_map(videos, PARAMS["map_date"], "R4")
    hot = maps.orderBy("episode").first().episode
    ready = ready.withColumn("title", F.when(F.pmod(F.xxhash64("account_id", "event_ts"), F.lit(2)) == 0, F.lit(hot)).otherwise(F.col("title")))
    small, large = apply_series_map(ready, maps), apply_series_map(ready, maps, max_broadcast_rows=0)
    same(large, small)
    text = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text and "_share" in text
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()


def test_reloaded_days_are_one_commit(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    path = f"{checkpoint_dir(spark).rstrip('/')}/backfill-{uuid.uuid4().hex}"
    M.save_table(build_attribution(clicks, videos, R3, from_date="2024-01-01", to_date="2024-01-31", map_date="2024-01-30"), path, versioned=True)
    before = V.snapshot(spark, path)
    M.reload_days(clicks, videos, path, DAYS, R3)
    after = V.snapshot(spark, path)
    assert after["commit"] == before["commit"] + 1
    assert {d for d in after["days"] if after["days"][d] != before["days"][d]} == set(map(str, DAYS))
    # Days without inputs leave the table; an empty list of days changes nothing.
    M.reload_days(clicks.limit(0), videos.limit(0), path, DAYS[:2], R3)
    assert not set(map(str, DAYS[:2])) & set(V.snapshot(spark, path)["days"])
    M.reload_days(clicks, videos, path, [], R3)
    assert V.snapshot(spark, path)["commit"] == after["commit"] + 1
