"""Two-title reports on the clustered copy: same rows, no shuffle by account, row groups skipped."""

import uuid

import pytest
from pyspark.sql import functions as F

from playtrail.operators import analytics as A
from playtrail.operators.clustered import save_clustered
from playtrail.plans.guards import checkpoint_dir

PERIOD = ("2024-01-01", "2024-12-31")


@pytest.fixture(scope="module")
def tables(spark):
    """500 accounts, about 200 titles; two of them have returning viewers."""
    rows = spark.range(200_000).select(
        F.concat(F.lit("a"), F.xxhash64("id", F.lit(1)) % 250).alias("account_id"),
        F.expr("date'2024-01-01' + CAST(id % 300 AS INT)").alias("event_date"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 300 AS INT), 0, 0, id % 86400)").alias("event_ts"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'Auto-Play' ELSE 'Manual-Selection' END").alias("start_type"),
        F.concat(F.lit("show "), F.xxhash64("id") % 100 + 100).alias("title"),
        F.concat(F.lit("show "), F.xxhash64(F.col("id") + 1) % 3 + 107).alias("feeder_title"),
        (F.col("id") % 50).cast("double").alias("final_watch_time"),
    )
    plain = f"{checkpoint_dir(spark).rstrip('/')}/plain-{uuid.uuid4().hex}"
    rows.write.parquet(plain)
    name = f"clustered_{uuid.uuid4().hex[:8]}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    yield spark.read.parquet(plain), save_clustered(spark.read.parquet(plain), name, 4, path, row_group_bytes=1 << 16)
    spark.sql(f"DROP TABLE {name}")


def test_same_rows_without_a_shuffle_by_account(tables):
    plain, clustered = tables
    args = ("show 108", "show 107", *PERIOD)
    want, got = A.return_viewers(plain, *args), A.return_viewers(clustered, *args)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    got = A.return_viewers(clustered, *args)
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "PushedFilters: [" in text and "EqualTo(title,show 107)" in text
    one = A.manual_first_starts(clustered, "show 107", *PERIOD)
    one.collect()
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df):
    """Rows that the scans of a collected plan gave out."""
    df.collect()
    jvm_plan = df._jdf.queryExecution().executedPlan()
    leaves = jvm_plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        if metric.isDefined():
            total += metric.get().value()
    return total


def test_row_groups_of_other_titles_are_skipped(spark, tables):
    plain, clustered = tables
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few = clustered.where(F.col("title") == "show 107").select("account_id", "title")
        none = clustered.where(F.col("title") == "show 107x").select("account_id", "title")
        assert few.count() == plain.where(F.col("title") == "show 107").count()
        assert scanned_rows(few) < 200_000 / 4
        assert scanned_rows(none) == 0  # within the range of the titles, and in no Bloom filter
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
