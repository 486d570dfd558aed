"""End-to-end jobs on the projected test tables (paths in, tables out)."""

import uuid

import pytest
from pyspark.sql import functions as F

from playtrail.functions.rules import R3, R4
from playtrail.operators.attribution import build_attribution
from playtrail.plans import jobs
from playtrail.plans.catalog import PARAMS
from playtrail.plans.guards import checkpoint_dir
from playtrail.sources.fixture import _WRITTEN, fixture_tables

from .conftest import SF_SMALL

P = dict(from_date=PARAMS["from_date"], to_date=PARAMS["to_date"])


def _paths(spark):
    fixture_tables(spark, SF_SMALL)
    return _WRITTEN[(spark.sparkContext.applicationId, SF_SMALL, None, False)]


def test_attribution_monitor_and_funnel_jobs(spark):
    clicks_path, videos_path = _paths(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
    page = PARAMS["details_page"]
    jobs.attribution_job(
        spark, clicks_path, videos_path, f"{base}/attribution", "R4", map_date=PARAMS["map_date"],
        details_page=page, **P,
    )
    clicks, videos = fixture_tables(spark, SF_SMALL)
    direct = build_attribution(clicks, videos, R4.with_details_page(page), map_date=PARAMS["map_date"], **P)
    table = spark.read.parquet(f"{base}/attribution").select(*R4.output_columns)
    assert table.count() == direct.count() > 0

    jobs.monitor_job(spark, f"{base}/attribution", videos_path, f"{base}/monitor", **P)
    monitor = spark.read.parquet(f"{base}/monitor")
    assert monitor.count() == table.select("event_date").distinct().count()
    assert monitor.where(F.col("acct_prc") > 1).count() == 0

    funnel = jobs.funnel_job(
        spark, f"{base}/attribution", videos_path, PARAMS["source_title"], PARAMS["reached_title"], **P
    ).collect()
    assert len(funnel) == 3


def test_daily_reload_job_replaces_one_day(spark):
    clicks_path, videos_path = _paths(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
    with pytest.raises(ValueError, match="details_page"):
        jobs.attribution_job(spark, clicks_path, videos_path, f"{base}/t", "R3", map_date=PARAMS["map_date"], **P)
    jobs.attribution_job(
        spark, clicks_path, videos_path, f"{base}/t", "R3", map_date=PARAMS["map_date"],
        details_page=PARAMS["details_page"], **P,
    )
    before = spark.read.parquet(f"{base}/t").groupBy("event_date").count().collect()
    day = jobs.daily_reload_job(spark, clicks_path, videos_path, f"{base}/t", "2024-01-15", R3)
    after = {r.event_date: r["count"] for r in spark.read.parquet(f"{base}/t").groupBy("event_date").count().collect()}
    assert str(day) == "2024-01-15"
    assert {r.event_date: r["count"] for r in before}.keys() == after.keys()
