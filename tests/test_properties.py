"""Properties of the attribution on the projected test data, and of the
maintenance operations."""

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from playtrail.functions.rules import R3, R4
from playtrail.operators import maintenance as M
from playtrail.operators.attribution import build_attribution
from playtrail.operators.videos import prepare_videos
from playtrail.plans.catalog import PARAMS
from playtrail.plans.guards import checkpoint_dir
from playtrail.sources.fixture import fixture_tables

from .conftest import SF_MID, SF_SMALL

P = dict(from_date=PARAMS["from_date"], to_date=PARAMS["to_date"], map_date=PARAMS["map_date"])


def test_r4_keeps_only_positive_watch_time(spark):
    clicks, videos = fixture_tables(spark, SF_MID)
    df = build_attribution(clicks, videos, R4, **P)
    assert df.where(~(F.col("final_watch_time") > 0)).count() == 0
    assert df.count() == 3108


def test_watch_time_is_conserved_on_single_device_days(spark):
    """Before the > 0 filter, credited seconds equal played seconds per
    account-day when every account uses one device and no times tie."""
    clicks, videos = fixture_tables(spark, SF_MID)
    credited = (
        build_attribution(clicks, videos, replace(R4, positive_only=False), **P)
        .groupBy("account_id", "event_date")
        .agg(F.sum("final_watch_time").alias("credited"))
    )
    played = (
        prepare_videos(videos, R4, P["from_date"], P["to_date"])
        .groupBy("account_id", "event_date")
        .agg(F.sum(F.coalesce("seconds_no_ads", F.lit(0.0))).alias("played"))
    )
    diff = credited.join(played, ["account_id", "event_date"], "full").where(
        F.abs(F.coalesce("credited", F.lit(0.0)) - F.coalesce("played", F.lit(0.0))) > 1e-6
    )
    assert diff.count() == 0


def _table(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/test-{uuid.uuid4().hex}/attribution"


def test_reload_day_is_idempotent_and_matches_a_direct_build(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    direct = build_attribution(clicks, videos, R3, **P)
    path = _table(spark)
    M.save_table(direct, path)
    day = "2024-01-15"
    for _ in range(2):
        M.reload_day(clicks, videos, path, day, R3, map_date=P["map_date"])
    cols = list(R3.output_columns)
    got = spark.read.parquet(path).select(*cols)
    assert got.exceptAll(direct.select(*cols)).count() == 0
    assert direct.select(*cols).exceptAll(got).count() == 0


def test_reload_of_an_empty_day_removes_it(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    path = _table(spark)
    M.save_table(build_attribution(clicks, videos, R3, **P), path)
    # Recompute 2024-01-15 from inputs that hold no rows of that day.
    day = dt.date(2024, 1, 15)
    M.reload_day(clicks.where(F.lit(False)), videos.where(F.lit(False)), path, day, R3, map_date=P["map_date"])
    assert spark.read.parquet(path).where(F.col("event_date") == F.lit(day)).count() == 0
    assert spark.read.parquet(path).count() > 0


def test_prune_table_swaps_in_a_copy(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    path = _table(spark)
    built = build_attribution(clicks, videos, R3, **P)
    M.save_table(built, path)
    M.prune_table(spark, path)
    pruned = spark.read.parquet(path)
    assert not set(M.WORKING_COLUMNS) & set(pruned.columns)
    assert pruned.count() == built.count()
