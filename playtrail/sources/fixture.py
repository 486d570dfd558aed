"""Projection of the generic ``events`` table onto the two inputs.

The test data has no clickstream or video log, so both are derived from
``events(event_id, ts, user_id, event_type, value, props)`` by fixed rules:
five users are pooled into one account, ``props.k`` picks the show, and
``event_id`` picks the kind of click, the device variant and the edge cases
(trailers, ``N/A`` display names, missing seconds, media loads). All of it
is column arithmetic, so the projection is a narrow map over the scan.

``ts`` is read as the local (New York) wall clock; the clickstream carries
the matching UTC instant, so converting it back gives ``ts`` again.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import R4

CLICK_EVENTS = ("click", "signup", "error")
VIDEO_EVENTS = ("view", "purchase")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pool(shared_every: int | None) -> Column:
    """Account number: five users per account; with ``shared_every`` set,
    every user whose id is a multiple of it shares account ``-1`` instead
    (one hot account holding about 1/shared_every of all rows)."""
    pooled = F.floor(F.col("user_id") / 5)
    if shared_every is None:
        return pooled
    return F.when(F.col("user_id") % shared_every == 0, F.lit(-1).cast("bigint")).otherwise(pooled)


def _account(acct: Column) -> Column:
    return F.when(acct == -1, F.lit("shared")).otherwise(acct.cast("string"))


def _device_key(acct: Column) -> Column:
    return F.when(acct == -1, F.lit(0)).otherwise(acct % 4)


def _show(k: Column) -> Column:
    # One show name is punctuated on purpose, so title cleaning matters.
    return F.concat(F.when(k % 5 == 0, F.lit("Show: ")).otherwise(F.lit("Show ")), (k % 5).cast("string"))


def events_as_clickstream(
    events: DataFrame, details_page: str = R4.details_page, shared_every: int | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    k = _k()
    s = _show(k)
    eid = F.col("event_id")
    acct = _pool(shared_every)
    dk = _device_key(acct)
    hit = F.convert_timezone(F.lit(C.NEW_YORK), F.lit("UTC"), F.col("ts").cast("timestamp_ntz"))
    details = C.first_match(
        [
            (eid % 10 == 0, F.concat(F.lit("Series-Cue-Up||"), s, F.lit("|auto-play"))),
            (eid % 10 == 1, F.concat(F.lit("Programme-Cue-Up||"), s, F.lit("|auto-play"))),
            (eid % 10 == 2, F.concat(F.lit("Series-Cue-Up||"), s, F.lit("|click"))),
            (eid % 10 == 3, F.lit("details|play|click")),
            (eid % 10 == 4, F.concat(F.lit("Rail|"), s, F.lit("|click"))),
            (eid % 10 == 5, F.lit("deeplink|x")),
            (eid % 10 == 6, F.concat(F.lit("Episode-Cue-Up||"), s, F.lit("|auto-play"))),
            (eid % 10 == 7, F.concat(F.lit("sle-binge|player||"), s, F.lit("|auto-play"))),
            (eid % 10 == 8, F.lit("cue-up|dismiss")),
        ],
        F.lit("tile|display"),
    )
    return events.where(F.col("event_type").isin(*CLICK_EVENTS)).select(
        _account(acct).alias("account_id"),
        F.to_date("ts").alias("event_date"),
        hit.alias("revised_ts"),
        hit.alias("hit_ts"),
        F.when(
            eid % 10 == 3,
            F.concat(F.lit(f"{details_page}episodes:Episode "), (k % 12).cast("string"), F.lit("!")),
        )
        .otherwise(F.lit("player"))
        .alias("player_event"),
        details.alias("click_details"),
        F.lit(None).cast("string").alias("platform"),
        C.first_match(
            [(dk == 0, "PS4"), (dk == 1, "Xbox One"), (dk == 2, "Android TV")], F.lit("Xfinity")
        ).alias("device"),
        F.when(eid % 10 == 7, F.lit("sle-binge|x")).alias("binge_source"),
        *keep,
    )


def events_as_video_log(
    events: DataFrame, shared_every: int | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    k = _k()
    s = _show(k)
    eid = F.col("event_id")
    acct = _pool(shared_every)
    dk = _device_key(acct)
    even = eid % 2 == 0
    display = F.when((k % 5 == 4) & (eid % 7 == 0), F.lit("N/A")).otherwise(
        F.concat(s, F.when(eid % 13 == 0, F.lit(" Trailer")).otherwise(F.lit("")))
    )
    device = C.first_match(
        [
            (dk == 0, F.lit("Playstation")),
            (dk == 1, F.lit("Xbox")),
            (dk == 2, F.when(even, F.lit("Google TV")).otherwise(F.lit("Android TV"))),
        ],
        F.when(even, F.lit("Xfinity X1")).otherwise(F.lit("Xfinity Flex")),
    )
    return events.where(F.col("event_type").isin(*VIDEO_EVENTS)).select(
        _account(acct).alias("account_id"),
        F.to_date("ts").alias("event_date"),
        F.col("ts").cast("timestamp_ntz").alias("event_ts"),
        display.alias("display_name"),
        F.concat(F.lit("Show "), (k % 5).cast("string")).alias("program"),
        F.concat(F.lit("Episode "), (k % 12).cast("string"), F.lit("!")).alias("episode_title"),
        F.when(eid % 19 == 0, F.lit("Show 3")).otherwise(F.lit("N/A")).alias("content_channel"),
        device.alias("device"),
        eid.cast("string").alias("video_id"),
        F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("seconds_no_ads"),
        F.col("value").alias("seconds_with_ads"),
        (eid % 11 == 0).alias("media_load"),
        *keep,
    )


def _variant(n: int) -> Column:
    """Which of ``n`` variations an event gets in the wide projection."""
    return F.floor(F.col("event_id") / 10) % n


def _overridden(base: DataFrame, changes: dict[str, list[tuple[Column, Column]]], names: list[str]) -> DataFrame:
    return base.select(*[C.first_match(changes[c], F.col(c)).alias(c) if c in changes else F.col(c) for c in names])


def wide_clickstream(events: DataFrame, details_page: str = R4.details_page) -> DataFrame:
    """The clickstream with every spelling that a rule set tells apart, and with NULLs."""
    base = events_as_clickstream(events, details_page, keep=("event_id", "props"))
    j, s = _variant(20), _show(_k())
    episode = F.concat(F.lit("Episode "), (_k() % 12).cast("string"), F.lit("!"))
    null = F.lit(None).cast("string")

    def page(*parts: Column) -> Column:
        return F.concat(F.lit(details_page), *parts)

    changes = {
        "click_details": [
            (j == 1, F.concat(F.lit("Series-cue-up||"), s, F.lit("|auto-play"))),
            (j == 2, F.concat(F.lit("Programme-cue-up||"), s, F.lit("|auto-play"))),
            (j == 3, F.concat(F.lit("Series-cue-up||"), s, F.lit("|click"))),
            (j == 4, F.concat(F.lit("rail|"), s, F.lit("|click"))),
            (j.isin(5, 6, 7, 8, 15, 16), F.lit("details|play|click")),
            (j == 9, F.concat(F.lit("Programme-Cue-Up||"), s, F.lit("|click"))),
            (j == 14, null),
            (j == 17, F.lit("deeplink|details")),
        ],
        "player_event": [
            (j == 5, page(F.lit("upsell:"), episode)),
            (j == 6, page(F.lit("more-like-this:"), episode)),
            (j == 7, page(F.lit("extras:"), episode)),
            (j == 8, page(episode)),
            (j == 15, page(F.lit("episodes:Poker Face"))),
            (j == 16, page(F.lit("episodes:Yellowstone"))),
            (j == 17, page(F.lit("episodes:"), episode)),
        ],
        "device": [(j == 10, null)],
        "event_date": [(j.isin(3, 11), F.lit(None).cast("date"))],
        "account_id": [(j == 13, null)],
    }
    return _overridden(base, changes, base.columns[:-2])


def wide_video_log(events: DataFrame) -> DataFrame:
    """The video log with linear channels of every kind, stop titles and NULLs."""
    base = events_as_video_log(events, keep=("event_id", "props"))
    j, null = _variant(24), F.lit(None).cast("string")
    changes = {
        "display_name": [
            (j == 1, F.lit("NBC")),
            (j == 2, F.lit("Peacock TV")),
            (j == 3, F.lit("Local News (East)")),
            (j == 4, F.lit("KQED-DT")),
            (j == 5, F.lit("Movies Premium")),
            (j == 6, F.lit("Kgwn2")),
            (j == 7, F.lit("WXYZ-A News")),
            (j == 8, F.lit("KXYZ-B News")),
            (j == 13, null),
        ],
        "episode_title": [
            (j == 9, F.lit("Yellowstone")),
            (j == 10, F.lit("Poker Face")),
            (j == 11, F.lit("N/A")),
            (j == 12, null),
        ],
        "device": [(j == 14, null)],
        "account_id": [(j == 15, null)],
        "seconds_no_ads": [(j == 16, F.lit(0.0))],
        "content_channel": [(j == 17, null)],
    }
    return _overridden(base, changes, base.columns[:-2])


_LOCK = threading.Lock()
_WRITTEN: dict[tuple, tuple[str, str]] = {}
_FRAMES: dict[tuple, tuple[DataFrame, DataFrame]] = {}


def fixture_tables(
    spark, sf_dir: str, shared_every: int | None = None, wide: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The projected clickstream and video log as Parquet tables.

    They are written once per session under the checkpoint folder, the video
    log partitioned by ``event_date`` and the clickstream by ``hit_day`` as the
    production tables are, and then scanned like any other table (pushed
    filters, pruned columns, pruned partitions). ``wide`` takes the projection
    in which every arm of the rules is met.
    """
    key = (spark.sparkContext.applicationId, sf_dir, shared_every, wide)
    with _LOCK:
        return _fixture_tables_locked(spark, sf_dir, shared_every, wide, key)


def _fixture_tables_locked(spark, sf_dir, shared_every, wide, key):
    from ..plans.guards import checkpoint_dir
    from .readers import read_clickstream, read_table, read_video_log

    if key not in _WRITTEN:
        base = f"{checkpoint_dir(spark).rstrip('/')}/fixture-{abs(hash(key)) % 10**12}"
        events = read_table(spark, sf_dir, "events")
        paths = (f"{base}/clickstream", f"{base}/video_log")
        clicks, videos = (
            (wide_clickstream(events), wide_video_log(events))
            if wide
            else (
                events_as_clickstream(events, shared_every=shared_every),
                events_as_video_log(events, shared_every=shared_every),
            )
        )
        tables = ((clicks.withColumn("hit_day", F.to_date("hit_ts")), "hit_day"), (videos, "event_date"))
        for path, (table, day) in zip(paths, tables):
            table.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(path)
        _WRITTEN[key] = paths
    # Listed once per session; every query scans the same two tables.
    frames_key = (id(spark), sf_dir, shared_every, wide)
    if frames_key not in _FRAMES:
        clicks_path, videos_path = _WRITTEN[key]
        _FRAMES[frames_key] = (read_clickstream(spark, clicks_path), read_video_log(spark, videos_path))
    return _FRAMES[frames_key]
