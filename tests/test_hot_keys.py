"""Hot account-days from sketches, and seconds with more rows than a chunk."""

import datetime as dt
import random
import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from playtrail.functions.rules import R1, R3, R4
from playtrail.operators import hot_keys as H
from playtrail.operators import sequence as S
from playtrail.operators.attribution import build_attribution, timeline_rows
from playtrail.operators.clicks import click_times
from playtrail.operators.sequence import BASE_KEYS, _tag
from playtrail.plans.catalog import PARAMS, rounded
from playtrail.plans.guards import checkpoint_dir, materialize
from playtrail.sources.fixture import fixture_tables
from playtrail.sources.readers import CLICKSTREAM_COLUMNS, VIDEO_LOG_COLUMNS

from .conftest import SF_SMALL

P = dict(from_date=PARAMS["from_date"], to_date=PARAMS["to_date"], map_date=PARAMS["map_date"])
DAY = dt.date(2024, 3, 4)


def times(spark, seed, accounts=3000, rows=40_000):
    rnd = random.Random(seed)
    out = []
    for _ in range(rows):
        day = rnd.choice([DAY, DAY + dt.timedelta(days=1), None])
        out.append((f"hot{rnd.randrange(4)}" if rnd.random() < 0.2 else f"a{rnd.randrange(accounts)}", day))
    return spark.createDataFrame(out, "account_id string, event_date date").repartition(6)


def keys(df):
    return {tuple(r) for r in df.select(*BASE_KEYS).collect()}


@pytest.mark.parametrize("threshold,tracked", [(300, 10_000), (300, 512), (5, 64), (100_000, 64)])
def test_sketches_miss_no_hot_key(spark, threshold, tracked):
    t = times(spark, threshold)
    exact, found = keys(H.count_hot(t, threshold)), keys(H.hot_account_days(t, threshold, tracked))
    assert found >= exact
    # A few too many at the most: the sketch is off by a small part of the threshold.
    assert len(found) <= len(exact) + 4 and (threshold != 300 or exact)


def test_kept_sketches_serve_a_period(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL, shared_every=3)
    path = f"{checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    assert H.known(spark, path, days[0], days[-1], 5) is None
    H.keep(clicks, videos, path, days[:6], R4)
    H.keep(clicks, videos, path, days[4:], R4)  # two days again: replaced, not added
    assert H.known(spark, path, days[0], dt.date(2024, 1, 20), 5) is None  # days without a sketch
    known = H.known(spark, path, days[0], days[-1], 5)
    p = dict(from_date=days[0], to_date=days[-1], map_date=days[-1])
    assert keys(known) and keys(known) <= keys(H.known(spark, path, days[0], days[-1], 2))
    given = build_attribution(clicks, videos, R4, hot_key_rows=5, hot_keys=known, **p)
    plain = build_attribution(clicks, videos, R4, hot_key_rows=None, **p)
    assert given.count() == plain.count() > 0 and rounded(given).exceptAll(rounded(plain)).count() == 0
    # Cold accounts named hot by mistake: the same rows.
    more = videos.select("account_id", "event_date").distinct().limit(20)
    given = build_attribution(clicks, videos, R4, hot_key_rows=5, hot_keys=known.unionByName(more), **p)
    assert given.count() == plain.count() and rounded(given).exceptAll(rounded(plain)).count() == 0


def test_nothing_hot_shuffles_no_account_days(spark):
    """Without hot keys there is one shuffle of each input, and the look for hot keys has states by day only."""
    clicks, videos = fixture_tables(spark, SF_SMALL)
    text = build_attribution(clicks, videos, R4, **P)._jdf.queryExecution().executedPlan().toString()
    assert len([e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "account_id" in e]) == 2
    t = timeline_rows(clicks, videos, R4, **P).select(*BASE_KEYS)
    text = H.sketch_days(t)._jdf.queryExecution().executedPlan().toString()
    assert not [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "account_id" in e]
    assert H.hot_account_days(t, 4_000_000).isEmpty()


def burst(spark, rows, seed=1):
    """One account; most of its rows share a second, many the same time, some all columns."""
    rnd = random.Random(seed)
    base, clicks, videos = dt.datetime.combine(DAY, dt.time(9)), [], []
    for i in range(rows):
        ts = base + dt.timedelta(seconds=rnd.choice([-50, 0, 0, 0, 0, 0, 0, 0, 60, 61]), microseconds=rnd.choice([0, 0, 0, 500_000]))
        title, device = rnd.choice("abcd"), rnd.choice(["Roku", "Xbox One", None])
        if rnd.random() < 0.6:
            seconds = None if rnd.random() < 0.1 else float(rnd.choice([5, 40, 300]))
            videos.append(("one", DAY, ts, title, title, f"{title} ep", "N/A", device, str(rnd.randrange(rows)), seconds, 1.0, False))
        else:
            details = rnd.choice([f"Series-Cue-Up||{title}|auto-play", f"Programme-Cue-Up||{title}|click", f"Rail|{title}|click"])
            hit = ts + dt.timedelta(hours=5)
            clicks.append(("one", DAY, None if rnd.random() < 0.2 else hit, hit, "player", details, None, device, None))
    cs = spark.createDataFrame(clicks, ", ".join(f"{k} {t}" for k, t in CLICKSTREAM_COLUMNS.items()))
    vs = spark.createDataFrame(videos, ", ".join(f"{k} {t}" for k, t in VIDEO_LOG_COLUMNS.items()))
    return cs, vs


@pytest.mark.parametrize("rules,target", [(R1, 7), (R3, 1), (R4, 7), (R4, 60)], ids=["R1-7", "R3-1", "R4-7", "R4-60"])
def test_rows_of_one_second_in_several_chunks(spark, rules, target):
    clicks, videos = burst(spark, 300)
    # No two videos are equal, so that their order is settled.
    videos = videos.dropDuplicates(["video_id"])
    clicks = clicks.dropDuplicates(["click_details", "device", "hit_ts", "revised_ts"])
    r = replace(rules, positive_only=False)
    kw = dict(from_date=DAY, to_date=DAY, map_date=DAY, min_accounts=1, all_columns=True)
    cols = [c for c in r.output_columns if c != "island"] + ["island", "prev_title", "next_title"]

    def rows(hot):
        out = build_attribution(clicks, videos, r, hot_key_rows=hot, **kw).select(*cols).collect()
        return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in row)) for row in out)

    plain = rows(None)
    assert len(plain) > 150 and rows(target) == plain


def test_a_second_of_100_000_rows_is_split(spark):
    n, target = 100_000, 5_000
    rows = spark.range(n).select(
        F.lit("one").alias("account_id"), F.lit(DAY).alias("event_date"),
        F.expr("timestamp_ntz'2024-03-04 09:00:00'").alias("event_ts"), F.lit("").alias("player_event"),
        F.lit("").alias("click_details"), F.lit("").alias("binge_type"), F.lit("Vdo_End").alias("action"),
        F.lit("roku").alias("device"), F.lit("t").alias("title"), F.xxhash64("id").cast("string").alias("video_id"),
        F.lit(1.0).alias("seconds_no_ads"), F.lit(True).alias("is_video"),
    )
    sizes = _tag(rows, rows, target, 1_000_000).groupBy("_chunk").agg(F.count(F.lit(1)).alias("n"), F.min("video_id").alias("a"), F.max("video_id").alias("b"))
    sizes = sizes.orderBy("_chunk").collect()
    assert len(sizes) == n // target and {s.n for s in sizes} == {target}
    assert all(x.b < y.a for x, y in zip(sizes, sizes[1:]))  # chunks follow the row order


def test_days_are_worked_out_once_however_many_are_counted(spark):
    """Sketches that can't tell a day leave it to a count: a row's day isn't compared day by day."""
    clicks, _ = fixture_tables(spark, SF_SMALL)
    t = click_times(clicks, R3, P["from_date"], P["to_date"])

    def conversions(n):
        days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]
        text = t.where(H._on_days("event_date", [*days, None]))._jdf.queryExecution().executedPlan().toString()
        return text.count("convert_timezone")

    assert 0 < conversions(28) <= conversions(2)
    rows = spark.createDataFrame([("a", DAY), ("b", None), ("c", DAY + dt.timedelta(days=1))], "account_id string, event_date date")
    kept = lambda *days: {r.account_id for r in rows.where(H._on_days("event_date", list(days))).collect()}
    assert (kept(DAY), kept(DAY, None), kept(None), kept()) == ({"a"}, {"a", "b"}, {"b"}, set())


def test_tagged_rows_are_joined_once_where_chunks_are_many(spark):
    clicks, videos = fixture_tables(spark, SF_SMALL, shared_every=3)
    rows = timeline_rows(clicks, videos, R4, **P)
    few, many = _tag(rows, rows, 5, 1_000_000), _tag(rows, rows, 5, 0)
    # No broadcast: the rows come from files, so that whatever reads them doesn't repeat the join.
    assert "Join" in few._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in many._jdf.queryExecution().executedPlan().toString()
    assert many.count() == few.count() > 0 and many.exceptAll(few).count() == 0


@pytest.mark.parametrize("rules,broadcast", [(R1, 1_000_000), (R3, 0), (R4, 1_000_000)], ids=["R1", "R3-shuffle", "R4"])
def test_many_hot_keys_make_the_timeline_once(spark, monkeypatch, rules, broadcast):
    monkeypatch.setattr(S, "MANY_HOT_KEYS", 3)
    written = []
    monkeypatch.setattr(S, "materialize", lambda df: written.append(df) or materialize(df))
    clicks, videos = fixture_tables(spark, SF_SMALL, wide=True)
    hot = videos.select(*BASE_KEYS).where("account_id is null or account_id < '15'")
    hot = hot.unionByName(clicks.where("event_date is null").select(*BASE_KEYS).limit(20))  # some come twice
    kw = dict(P, min_accounts=1, max_broadcast_rows=broadcast)
    many = build_attribution(clicks, videos, rules, hot_key_rows=3, hot_keys=hot, **kw)
    # Rows of other account-days are read from what was written, not told apart by a second pass over the inputs.
    assert "LeftAnti" not in many._jdf.queryExecution().executedPlan().toString()
    assert "_named" in written[0].columns
    plain = build_attribution(clicks, videos, rules, hot_key_rows=None, **kw)
    assert many.count() == plain.count() > 0 and rounded(many).exceptAll(rounded(plain)).count() == 0
