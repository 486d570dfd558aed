"""Hot keys: one shared account holds about a third of all rows; its days
are split into chunks of bounded size, and results do not change."""

from dataclasses import replace

from pyspark.sql import functions as F

from playtrail.functions.rules import R4
from playtrail.operators.attribution import build_attribution, timeline_rows
from playtrail.operators.clicks import click_times
from playtrail.operators.sequence import assign_chunks
from playtrail.operators.videos import video_times
from playtrail.plans.catalog import PARAMS, rounded
from playtrail.sources.fixture import fixture_tables

from .conftest import SF_MID

P = dict(from_date=PARAMS["from_date"], to_date=PARAMS["to_date"], map_date=PARAMS["map_date"])
THRESHOLD = PARAMS["shared_hot_key_rows"]


def test_shared_account_days_are_split(spark):
    clicks, videos = fixture_tables(spark, SF_MID, shared_every=PARAMS["shared_every"])
    rows = clicks.count() + videos.count()
    shared = clicks.where(F.col("account_id") == "shared").count() + videos.where(
        F.col("account_id") == "shared"
    ).count()
    assert 0.28 < shared / rows < 0.38  # about a third of all rows

    times = click_times(clicks, R4, P["from_date"], P["to_date"]).unionByName(
        video_times(videos, R4, P["from_date"], P["to_date"])
    )
    timeline = timeline_rows(clicks, videos, R4, **P)
    tagged, layout = assign_chunks(timeline, times, THRESHOLD)
    assert layout.chunked
    sizes = tagged.where(F.col("_hot")).groupBy("account_id", "event_date", "_chunk").count()
    per_day = sizes.groupBy("account_id", "event_date").agg(
        F.count(F.lit(1)).alias("chunks"), F.max("count").alias("largest"), F.sum("count").alias("rows")
    )
    shared_days = per_day.where(F.col("account_id") == "shared").collect()
    assert len(shared_days) == 30
    for day in shared_days:
        assert day.chunks >= 2
        assert day.largest < day.rows
        # Chunks are cut by a running row count: none is much over the target.
        assert day.largest <= 2 * THRESHOLD


def test_chunked_and_plain_plans_agree_on_the_shared_account(spark):
    clicks, videos = fixture_tables(spark, SF_MID, shared_every=PARAMS["shared_every"])
    rules = replace(R4, positive_only=False)
    cols = list(rules.output_columns)
    plain = rounded(build_attribution(clicks, videos, rules, hot_key_rows=None, **P).select(*cols))
    chunked = rounded(build_attribution(clicks, videos, rules, hot_key_rows=THRESHOLD, **P).select(*cols))
    assert plain.count() == chunked.count()
    assert plain.exceptAll(chunked).count() == 0
