"""Global positions of ordered results."""

import random

from pyspark.sql import functions as F

from playtrail.operators.ordering import with_positions


def test_positions_follow_the_order(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.randrange(50), rnd.random()) for _ in range(3000)] + [("a", 1, 0.5)] * 20
    df = spark.createDataFrame(rows, "k string, n int, x double").repartition(7)
    got = [tuple(r) for r in with_positions(df, ["k", "n"], descending=("n",)).orderBy("position").collect()]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1], r[2]))
    assert [r[:3] for r in got] == want and [r[3] for r in got] == list(range(1, len(rows) + 1))
    assert with_positions(df.limit(0), ["k"]).count() == 0


def test_a_hot_key_is_split(spark):
    """All rows share the key: the range shuffle cuts between their other columns."""
    df = spark.range(200_000).select(F.lit("one").alias("k"), F.xxhash64("id").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_positions(df, ["k"])
        parts = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in parts) < 100_000
    assert got.agg(F.count_distinct("position"), F.max("position")).first()[:] == (200_000, 200_000)
