"""Hand-made clickstream / video-log rows for golden timelines.

A timeline is a list of steps on one account and day; each step is one of
``("v", title, seconds[, device])`` for a play, ``("auto"|"next"|"rail",
title[, device])`` for a click. Steps are five minutes apart, starting at
10:00 local time; the video log records local time, the clickstream the UTC
instant.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from playtrail.sources.readers import CLICKSTREAM_COLUMNS, VIDEO_LOG_COLUMNS

DAY = dt.date(2024, 1, 10)
UTC_OFFSET = dt.timedelta(hours=5)  # New York in January


def _details(kind: str, title: str) -> str:
    if kind == "auto":
        return f"Series-Cue-Up||{title}|auto-play"
    if kind == "next":
        return f"Series-Cue-Up||{title}|click"
    if kind == "rail":
        return f"Rail|{title}|click"
    raise ValueError(kind)


def build(
    spark: SparkSession,
    timelines: dict[str, list[tuple]],
    day: dt.date = DAY,
    device: str = "Roku",
    start_time: dt.time = dt.time(10, 0),
):
    clicks, videos = [], []
    start = dt.datetime.combine(day, start_time)
    for account, steps in timelines.items():
        for i, step in enumerate(steps):
            ts = start + dt.timedelta(minutes=5 * i)
            if step[0] == "v":
                _, title, seconds, *rest = step
                dev = rest[0] if rest else device
                display = title
                videos.append(
                    (account, day, ts, display, display, f"{title} episode", "N/A", dev, f"{account}-{i}",
                     None if seconds is None else float(seconds), 1.0, False)
                )
            else:
                kind, title, *rest = step
                dev = rest[0] if rest else device
                hit = ts + UTC_OFFSET
                clicks.append((account, day, hit, hit, "player", _details(kind, title), None, dev, None))
    cs = spark.createDataFrame(clicks, schema=", ".join(f"{k} {v}" for k, v in CLICKSTREAM_COLUMNS.items()))
    vl = spark.createDataFrame(videos, schema=", ".join(f"{k} {v}" for k, v in VIDEO_LOG_COLUMNS.items()))
    return cs, vl
