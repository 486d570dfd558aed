"""Edge cases named in FIXTURES.md: midnight, an N/A display name with a
trailer program, a deep-link click without a title, equal timestamps, and a
funnel return viewer."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from playtrail.functions.rules import R4
from playtrail.operators import analytics as A
from playtrail.operators.attribution import build_attribution
from playtrail.sources.readers import CLICKSTREAM_COLUMNS, VIDEO_LOG_COLUMNS

DAY = dt.date(2024, 1, 10)
NEXT = DAY + dt.timedelta(days=1)
UTC = dt.timedelta(hours=5)

VSCHEMA = ", ".join(f"{k} {v}" for k, v in VIDEO_LOG_COLUMNS.items())
CSCHEMA = ", ".join(f"{k} {v}" for k, v in CLICKSTREAM_COLUMNS.items())


def video(acct, ts, display, seconds, vid, program=None, device="Roku"):
    return (acct, ts.date(), ts, display, program or display, f"{display} ep", "N/A", device, vid, seconds, 1.0, False)


def click(acct, ts, details, player="player", device="Roku"):
    hit = ts + UTC
    return (acct, ts.date(), hit, hit, player, details, None, device, None)


def at(day, h, m, s=0):
    return dt.datetime.combine(day, dt.time(h, m, s))


def run(spark, clicks, videos, **kw):
    cs = spark.createDataFrame(clicks, CSCHEMA)
    vs = spark.createDataFrame(videos, VSCHEMA)
    rules = replace(R4, positive_only=False)
    return build_attribution(cs, vs, rules, from_date=DAY, to_date=NEXT, map_date=DAY, all_columns=True, **kw)


def test_first_video_after_midnight_has_no_feeder(spark):
    videos = [video("m", at(DAY, 23, 55), "a", 100.0, "1"), video("m", at(NEXT, 0, 5), "b", 50.0, "2")]
    rows = run(spark, [], videos).where(F.col("event_date") == F.lit(NEXT)).collect()
    assert [(r.feeder_title, r.start_type, r.final_watch_time) for r in rows] == [(None, "Manual-Selection", 50.0)]


def test_na_display_with_trailer_program_stays_a_plain_end(spark):
    videos = [
        video("n", at(DAY, 10, 0), "N/A", 60.0, "1", program="X Trailer"),
        video("n", at(DAY, 10, 5), "b", 40.0, "2"),
    ]
    rows = {r.video_id: r for r in run(spark, [], videos).collect()}
    assert rows["1"].title == "x trailer" and rows["1"].action == "Vdo_End"
    # The next play has a trailer feeder, so it is manual.
    assert rows["2"].feeder_title == "x trailer" and rows["2"].start_type == "Manual-Selection"


def test_deep_link_without_details_page_is_dropped(spark):
    clicks = [click("d", at(DAY, 10, 0), "deeplink|x")]
    videos = [video("d", at(DAY, 10, 1), "a", 30.0, "1")]
    rows = run(spark, clicks, videos).collect()
    assert [r.video_id for r in rows] == ["1"]


def test_equal_timestamps_share_an_island_number(spark):
    t1 = at(DAY, 10, 5)
    videos = [
        video("e", at(DAY, 10, 0), "a", 100.0, "1"),
        video("e", t1, "b", 50.0, "2"),
        video("e", t1, "b", 30.0, "3"),
    ]
    for hot in (None, 1):
        rows = {r.video_id: r.island for r in run(spark, [], videos, hot_key_rows=hot).collect()}
        assert rows["2"] == rows["3"] == rows["1"] + 1


def test_funnel_counts_a_return_viewer(spark):
    attribution = spark.createDataFrame(
        [
            ("r", DAY, at(DAY, 10, 0), "Auto-Play", "show 1", "show 2", 1800.0),
            ("r", DAY, at(DAY, 12, 0), "Manual-Selection", "", "show 2", 3600.0),
            ("s", DAY, at(DAY, 9, 0), "Manual-Selection", "", "show 2", 7200.0),  # manual first: no return
            ("s", DAY, at(DAY, 11, 0), "Clicked-Up-Next", "show 1", "show 2", 600.0),
        ],
        "account_id string, event_date date, event_ts timestamp_ntz, start_type string, feeder_title string, "
        "title string, final_watch_time double",
    )
    videos = spark.createDataFrame([video("r", at(DAY, 9, 0), "Show 1", 900.0, "1")], VSCHEMA)
    rows = {r.category: r for r in A.funnel(attribution, videos, "show 1", "show 2", DAY, DAY).collect()}
    assert (rows[A.WATCHED_SOURCE].accounts, rows[A.WATCHED_SOURCE].hours_watched) == (1, 0.25)
    assert (rows[A.AUTO_TO_REACHED].accounts, rows[A.AUTO_TO_REACHED].hours_watched) == (2, 0.67)
    returned = rows[A.RETURNED]
    assert (returned.accounts, returned.hours_watched) == (1, 1.0)
    # Eligible accounts come from the previous stage in account order; the
    # two one-account stages tie and are ordered by category name.
    assert rows[A.AUTO_TO_REACHED].eligible_accounts is None
    assert returned.eligible_accounts == 2 and returned.take_rate == 0.5
    assert rows[A.WATCHED_SOURCE].eligible_accounts == 1 and rows[A.WATCHED_SOURCE].take_rate == 1.0


def test_clicks_without_a_time_stay_with_their_hot_key(spark):
    """R4 takes click times from a nullable column; such rows sort first and
    must stay in the same window partition as the rest of a hot key."""
    clicks = [click("h", at(DAY, 10, 2), "Series-Cue-Up||b|auto-play"), click("h", at(DAY, 10, 7), "Rail|a|click")]
    clicks = [c[:2] + (None,) + c[3:] if i == 0 else c for i, c in enumerate(clicks)]
    videos = [video("h", at(DAY, 10, i), t, float(10 + i), str(i)) for i, t in enumerate("aabbaab")]
    cols = ["event_ts", "video_id", "last_action", "island", "island_seconds", "start_type", "final_watch_time"]
    plain = run(spark, clicks, videos).select(*cols)
    chunked = run(spark, clicks, videos, hot_key_rows=2).select(*cols)
    assert plain.where(F.col("event_ts").isNull()).count() == 1
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, chunked.collect()))
