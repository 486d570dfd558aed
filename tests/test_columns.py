"""Column functions D1-D16 on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playtrail.functions import columns as C
from playtrail.functions.rules import R1, R2, R4


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_normalize_title(spark):
    got = one(spark, C.normalize_title("s"), [("Show: 0",), ("Law & Order!",), ("It's.A,B",), (None,)], "s string")
    assert got == ["show 0", "law  order", "itsab", None]


def test_click_and_video_devices(spark):
    rows = [("Xbox One",), ("PS4",), ("Xfinity X1",), ("Google TV",), ("Roku",), (None,)]
    assert one(spark, C.normalize_click_device("d"), rows, "d string") == [
        "xbox", "playstation", "xfinity x1", "google tv", "roku", None
    ]
    assert one(spark, C.normalize_video_device("d"), rows, "d string") == [
        "xbox one", "ps4", "xfinity", "android tv", "roku", None
    ]


def test_first_segment_is_literal_and_null_safe(spark):
    got = one(spark, C.first_segment("s"), [("sle-binge|x",), ("a",), ("",), (None,)], "s string")
    assert got == ["sle-binge", "a", "", None]


def test_extract_click_title(spark):
    page = "app:details:"
    rows = [
        ("app:details:episodes:Ep 1", "x"),
        ("app:details:more-like-this:Show", "x"),
        ("app:details:Movie", "x"),
        ("player", "series-cue-up||show 1|auto-play"),
        ("player", "series-cue-up|show 1|auto-play"),  # no "||": NULL, not ""
        ("player", "rail|show: 2|click"),
        ("player", "deeplink|x"),
    ]
    got = one(spark, C.extract_click_title("p", "d", page), rows, "p string, d string")
    assert got == ["Ep 1", "Show", "Movie", "show 1", None, "show: 2", None]


def test_linear_channels(spark):
    rows = [("NBC",), ("Bravo TV",), ("News (East)",), ("KTVH-DT",), ("WXYZ-TV2",), ("Kgwn2",), ("The Office",), (None,)]
    got = one(spark, C.is_linear_channel("s"), rows, "s string")
    assert got == [True, True, True, True, True, True, False, None]
    r1 = one(spark, C.is_linear_channel("s", R1.linear_channel_names), [("kgwn2",)], "s string")
    assert r1 == [False]


def test_video_title_and_action(spark):
    rows = [("N/A", "Prog"), ("Show 1 Trailer", "P"), (None, "P")]
    assert one(spark, C.video_title("d", "p"), rows, "d string, p string") == ["prog", "show 1 trailer", None]
    assert one(spark, C.video_action("d"), rows, "d string, p string") == [C.VIDEO_END, C.MANUAL, C.VIDEO_END]


def test_local_time_and_shift(spark):
    rows = [(dt.datetime(2024, 1, 1, 3, 30),), (dt.datetime(2024, 7, 1, 3, 30),)]
    schema = "t timestamp_ntz"
    assert one(spark, C.local_date("t"), rows, schema) == [dt.date(2023, 12, 31), dt.date(2024, 6, 30)]
    assert one(spark, C.local_ts("t"), rows, schema) == [dt.datetime(2023, 12, 31, 22, 30), dt.datetime(2024, 6, 30, 23, 30)]
    assert one(spark, C.shift_seconds("t", -40), rows[:1], schema) == [dt.datetime(2024, 1, 1, 3, 29, 20)]


@pytest.mark.parametrize(
    "rules,details,expected",
    [
        (R4, "series-cue-up||a|auto-play", "Auto-Play"),
        (R4, "programme-cue-up||a|click", "Clicked-Up-Next"),
        (R4, "rail|a|click", "Manual-Selection"),
        (R4, "cue-up|dismiss", None),
        (R2, "Series-Cue-Up||a|auto-play", None),  # case-sensitive pattern
        (R2, "cue-up|dismiss", "Dismiss"),
        (R1, "Episode-Cue-Up||a|auto-play", "Auto-Play"),
    ],
)
def test_classifiers(spark, rules, details, expected):
    df = spark.createDataFrame([(details, "player", None)], "d string, p string, b string")
    got = df.select(rules.classify(F.col("d"), F.col("p"), F.col("b"))).first()[0]
    assert got == expected


def test_local_yesterday_matches_new_york_calendar(spark):
    from zoneinfo import ZoneInfo

    from playtrail.plans.jobs import yesterday

    expected = dt.datetime.now(ZoneInfo(C.NEW_YORK)).date() - dt.timedelta(days=1)
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = spark.range(1).select(C.local_yesterday().alias("d")).first().d
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == expected == yesterday()


def test_presentation_order_follows_the_rule_set(spark):
    from playtrail.functions.rules import R3
    from playtrail.operators.attribution import presentation_order

    rows = [("a", dt.date(2024, 1, 1), "d2", dt.datetime(2024, 1, 1, 9)), ("a", dt.date(2024, 1, 1), "d1", dt.datetime(2024, 1, 1, 10))]
    df = spark.createDataFrame(rows, "account_id string, event_date date, device string, event_ts timestamp_ntz")
    assert [r.device for r in presentation_order(df, R3).collect()] == ["d1", "d2"]  # account, day, device, time
    assert [r.device for r in presentation_order(df, R2).collect()] == ["d2", "d1"]  # account, day, time
