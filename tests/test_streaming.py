"""Daily refresh as an availableNow stream over both day-partitioned inputs."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from playtrail.functions.columns import local_date
from playtrail.functions.rules import R3, R4
from playtrail.operators.attribution import build_attribution
from playtrail.operators.maintenance import save_table
from playtrail.plans.guards import checkpoint_dir
from playtrail.sources.fixture import fixture_tables
from playtrail.sources.readers import conform, read_clickstream, read_video_log
from playtrail.streaming import refresh_new_days

from .conftest import SF_SMALL

DAYS = [dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 12)]


def test_refresh_sees_every_landed_file(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    clicks_path, log_path, table_path = f"{base}/clicks", f"{base}/video_log", f"{base}/attribution"
    own_day = local_date("hit_ts")

    def run():
        refresh_new_days(spark, clicks_path, log_path, table_path, rules=R3, progress_path=f"{base}/progress")

    def days():
        return {r.event_date for r in spark.read.parquet(table_path).select("event_date").distinct().collect()}

    def expected(whole_days):
        # From the files as they are now, not from handles opened before they landed.
        landed, seen = read_video_log(spark, log_path), read_clickstream(spark, clicks_path)
        cols, out = list(R3.output_columns), None
        for day in whole_days:
            one = build_attribution(seen, landed, R3, from_date=day, to_date=day, map_date=day).select(*cols)
            out = one if out is None else out.unionByName(one)
        return out

    def same(whole_days):
        want = expected(whole_days)
        got = spark.read.parquet(table_path).select(*R3.output_columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0

    save_table(videos.where(F.col("event_date").isin(*DAYS[:2])), log_path)
    clicks.where(own_day.isin(*DAYS[:2])).write.parquet(clicks_path)
    run()
    assert days() == set(DAYS[:2])
    same(DAYS[:2])

    # A new day lands; its plays are in the next run's table.
    save_table(videos.where(F.col("event_date") == F.lit(DAYS[2])), log_path, mode="append")
    run()
    same(DAYS)
    plays = spark.read.parquet(table_path).where((F.col("event_date") == F.lit(DAYS[2])) & (F.col("seconds_no_ads") > 0))
    assert plays.count() > 0

    # Its clicks come later: the day is refreshed again.
    before = spark.read.parquet(table_path).where(F.col("event_date") == F.lit(DAYS[2])).count()
    clicks.where(own_day == F.lit(DAYS[2])).write.mode("append").parquet(clicks_path)
    run()
    same(DAYS)
    assert spark.read.parquet(table_path).where(F.col("event_date") == F.lit(DAYS[2])).count() > before


def test_a_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="account_id"):
        conform(spark.createDataFrame([(1,)], "x int"), {"account_id": "string"})


def test_r4_reload_equals_the_day_of_a_longer_build(spark):
    from playtrail.operators.maintenance import reload_day

    clicks, videos = fixture_tables(spark, SF_SMALL)
    day = DAYS[1]
    path = f"{checkpoint_dir(spark).rstrip('/')}/r4-{uuid.uuid4().hex}"
    # Some clicks of the day were hit a day earlier or later.
    moved = F.expr("hit_ts + make_dt_interval(abs(xxhash64(account_id, hit_ts)) % 3 - 1)")
    clicks = clicks.withColumn("hit_ts", F.when(F.col("event_date") == F.lit(day), moved).otherwise(F.col("hit_ts")))
    whole = build_attribution(
        clicks, videos, R4, from_date=day - dt.timedelta(days=5), to_date=day + dt.timedelta(days=5), map_date=day
    ).where(F.col("event_date") == F.lit(day))
    reload_day(clicks, videos, path, day, R4)
    got = spark.read.parquet(path).select(*R4.output_columns)
    want = whole.select(*R4.output_columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    from playtrail.plans.session import ensure_local_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_local_checkpoint_dir(Session())
