"""Plan shape: one shuffle of the timeline, group limit in the map, pushed
filters and pruned partitions at the scans."""

import contextlib
import io
import re

from playtrail.functions.rules import R4
from playtrail.operators.attribution import build_attribution
from playtrail.operators.clicks import build_series_map
from playtrail.plans.catalog import PARAMS
from playtrail.sources.fixture import fixture_tables

from .conftest import SF_SMALL

P = dict(from_date=PARAMS["from_date"], to_date=PARAMS["to_date"], map_date=PARAMS["map_date"])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_timeline_rows_are_shuffled_once(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    text = plan(build_attribution(clicks, videos, R4, **P))
    # The cached series map prints its own (episode) exchanges; every
    # exchange of timeline rows is keyed by account: one for the clicks and
    # one for the videos, both below the union, none above it.
    hash_exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    timeline_exchanges = [e for e in hash_exchanges if "account_id" in e]
    assert len(timeline_exchanges) == 2, hash_exchanges
    assert all(e.startswith("account_id") for e in timeline_exchanges)
    above_union = text[: text.index("Union")]
    assert "Exchange" not in above_union


def test_series_map_uses_a_group_limit(spark):
    _, videos = fixture_tables(spark, SF_SMALL)
    text = plan(build_series_map(videos, P["map_date"], R4))
    assert "WindowGroupLimit" in text


def formatted(spark, df) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_reach_the_scans(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    df = build_attribution(clicks, videos, R4, **P)
    text = formatted(spark, df)
    # Clickstream: the coarse UTC bound is pushed into the Parquet reader.
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(hit_ts", text)
    # A clickstream stored by hit day: its files are pruned by the period too.
    assert re.search(r"PartitionFilters: \[[^\]]*hit_day", text)
    # Video log: the period prunes day partitions.
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)


def test_a_clickstream_without_hit_days_gives_the_same_rows(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL)
    days = P | {"from_date": "2024-01-10", "to_date": "2024-01-12"}
    pruned = build_attribution(clicks, videos, R4, **days)
    plain = build_attribution(clicks.drop("hit_day"), videos, R4, **days)
    assert pruned.count() > 0
    assert pruned.exceptAll(plain).count() == 0 and plain.exceptAll(pruned).count() == 0


def test_cold_rows_take_the_plain_plan(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL, shared_every=PARAMS["shared_every"])
    text = plan(build_attribution(clicks, videos, R4, hot_key_rows=PARAMS["small_hot_key_rows"], **P))
    scans = text[: text.index("guard-")] if "guard-" in text else text
    # Rows of the inputs are kept apart from the hot ones by an anti join, and
    # the chunked side reads the written hot rows instead of the inputs.
    assert "LeftAnti" in text
    assert len(re.findall(r"FileScan parquet [^\n]*hit_ts", text)) == 1, scans
    assert len(re.findall(r"FileScan parquet [^\n]*media_load", text)) == 1


def test_broadcast_bound_in_bytes(spark):
    from playtrail.plans.guards import bounded_broadcast

    small = spark.range(10).selectExpr("id", "repeat('x', 1000) AS title")
    marked, rows = bounded_broadcast(small, max_rows=100, max_bytes=100_000)
    assert rows == 10 and "ResolvedHint (strategy=broadcast)" in marked._jdf.queryExecution().analyzed().toString()
    plain, _ = bounded_broadcast(small, max_rows=100, max_bytes=5_000)
    assert "Hint" not in plain._jdf.queryExecution().analyzed().toString()
