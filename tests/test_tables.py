"""Catalog tables by name: the same jobs and the same rows as by path."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from playtrail.functions.rules import R3
from playtrail.operators import maintenance as M
from playtrail.operators.attribution import build_attribution
from playtrail.plans import jobs
from playtrail.plans.catalog import PARAMS
from playtrail.plans.guards import checkpoint_dir
from playtrail.sources.fixture import _WRITTEN, fixture_tables
from playtrail.sources.readers import is_table_name, read_attribution

from .conftest import SF_SMALL

P = dict(from_date="2024-01-10", to_date="2024-01-16")


@pytest.fixture()
def schema(spark):
    name = f"trail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{checkpoint_dir(spark).rstrip('/')}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_names_and_paths_are_told_apart():
    assert is_table_name("trail.attribution") and is_table_name("attribution")
    assert not any(map(is_table_name, ("/data/x", "./x", "s3://bucket/x", "x/y")))


def test_jobs_on_named_tables(spark, schema):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    clicks_path, videos_path = _WRITTEN[(spark.sparkContext.applicationId, SF_SMALL, None, False)]
    spark.sql(f"CREATE TABLE {schema}.clicks USING parquet LOCATION '{clicks_path}'")
    spark.sql(f"ALTER TABLE {schema}.clicks RECOVER PARTITIONS")
    table, page = f"{schema}.attribution", PARAMS["details_page"]
    for _ in range(2):  # the second run replaces the table
        jobs.attribution_job(
            spark, f"{schema}.clicks", videos_path, table, "R3", map_date=PARAMS["map_date"], details_page=page, **P
        )
    direct = build_attribution(clicks, videos, R3, map_date=PARAMS["map_date"], **P)
    cols = list(R3.output_columns)
    got = spark.table(table).select(*cols)
    assert got.count() > 0 and got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0

    # A wrong day is reloaded, the others stay.
    day = dt.date(2024, 1, 12)
    M.replace_day(spark.table(table).withColumn("title", F.lit("wrong")), table, day)
    assert spark.table(table).where("title = 'wrong'").select("event_date").distinct().count() == 1
    jobs.daily_reload_job(
        spark, f"{schema}.clicks", videos_path, table, day, "R3", map_date=PARAMS["map_date"], details_page=page
    )
    got = spark.table(table).select(*cols)
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0

    jobs.delete_day_job(spark, table, day)
    assert spark.table(table).where(F.col("event_date") == F.lit(day)).count() == 0
    left = spark.table(table).count()
    assert left == direct.where(F.col("event_date") != F.lit(day)).count()
    jobs.prune_job(spark, table)
    assert not set(M.WORKING_COLUMNS) & set(read_attribution(spark, table).columns)
    assert spark.table(table).count() == left
    assert [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary].count("attribution") == 1


def test_ordered_job(spark, schema):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    base = f"{checkpoint_dir(spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    M.save_table(build_attribution(clicks, videos, R3, map_date=PARAMS["map_date"], **P), f"{schema}.t")
    jobs.ordered_job(spark, f"{schema}.t", base, R3)
    files = sorted(f for f in spark.read.parquet(base).inputFiles())
    keys = [
        (r.account_id, r.event_date, r.device, r.event_ts) for f in files for r in spark.read.parquet(f).collect()
    ]
    assert keys and keys == sorted(keys)
