"""Account sets: exact counts over any period, equal to counts of the rows."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from playtrail.operators import audience as A
from playtrail.operators import versions as V
from playtrail.plans.guards import checkpoint_dir

DAYS = [dt.date(2024, 1, d) for d in range(1, 9)]


@pytest.fixture()
def path(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/audience-{uuid.uuid4().hex}"


def played(spark, seed, days=DAYS, accounts=400):
    rnd = random.Random(seed)
    rows = [
        (rnd.choice(A.KINDS), rnd.choice(days), rnd.choice(["x", "y", None]), rnd.choice([None, *(f"a{i}" for i in range(accounts))]), float(rnd.randrange(100)))
        for _ in range(3000)
    ]
    return spark.createDataFrame(rows, "kind string, event_date date, title string, account_id string, seconds double")


def counts(rows, *keys):
    return sorted(map(tuple, rows.groupBy(*keys).agg(F.count_distinct("account_id"), F.sum("seconds")).collect()), key=str)


def test_counts_over_periods(spark, path):
    rows = played(spark, 1)
    A.update(rows, path, DAYS)
    for first, last in ((DAYS[0], DAYS[-1]), (DAYS[2], DAYS[4]), (DAYS[3], DAYS[3])):
        own = rows.where(F.col("event_date").between(F.lit(first), F.lit(last)))
        for keys in (["kind"], ["kind", "title"], ["event_date", "title"], ["title"]):
            got = sorted(map(tuple, A.audience(A.read_sets(spark, path, first, last), *keys).collect()), key=str)
            assert got == counts(own, *keys)


def test_updates_replace_days_and_keep_numbers(spark, path):
    first, second = played(spark, 1, DAYS[:5], 300), played(spark, 2, DAYS[4:], 600)
    A.update(first, path, DAYS[:5])
    numbers = {r.account_id: r.account_no for r in A._numbers(spark, path).collect()}
    for _ in range(2):  # twice equals once
        A.update(second, path, DAYS[4:])
    rows = first.where(F.col("event_date") < F.lit(DAYS[4])).unionByName(second)
    got = sorted(map(tuple, A.audience(A.read_sets(spark, path, DAYS[0], DAYS[-1]), "kind", "event_date").collect()), key=str)
    assert got == counts(rows, "kind", "event_date")
    now = {r.account_id: r.account_no for r in A._numbers(spark, path).collect()}
    assert now.items() >= numbers.items() and sorted(now.values()) == list(range(1, len(now) + 1))


def test_accounts_beyond_one_bucket(spark, path):
    rows = spark.range(70_000).select(
        F.lit(A.LOGGED).alias("kind"), F.lit(DAYS[0]).alias("event_date"), F.lit("t").alias("title"),
        F.concat(F.lit("a"), "id").alias("account_id"), F.lit(1.0).alias("seconds"),
    )
    A.update(rows.unionByName(rows.limit(1000)), path, DAYS[:1])
    sets = A.read_sets(spark, path, DAYS[0], DAYS[0])
    assert sets.count() == 3 and A.audience(sets, "title").first().accounts == 70_000


def test_a_report_reads_its_days_only(spark, path):
    A.update(played(spark, 3), path, DAYS)
    sets = A.read_sets(spark, path, DAYS[1], DAYS[2])
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert V.is_versioned(spark, f"{path}/sets")
