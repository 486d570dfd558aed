"""Script variables: the original's dates in a Spark session, under any clock."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from playtrail.plans import script as S

NY = ZoneInfo("America/New_York")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_yesterday_across_clock_changes(spark, zone):
    """Every hour around both changes of 2024, whatever the session's zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for start in (dt.datetime(2024, 3, 10, 3), dt.datetime(2024, 11, 3, 3), dt.datetime(2024, 1, 1, 4, 59)):
            for hours in (0, 1, 2, 3, 25, 26):
                clock = start + dt.timedelta(hours=hours)
                S.declare(spark, clock=clock)
                local = clock.replace(tzinfo=dt.timezone.utc).astimezone(NY).date()
                found = S.variables(spark)
                assert found["run_clock"] == clock
                assert {found[n] for n in ("yesterday", *S.DATES)} == {local - dt.timedelta(days=1)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_default_clock_is_now(spark):
    S.declare(spark)
    assert abs(S.variables(spark)["run_clock"] - S._now()) < dt.timedelta(minutes=1)


def test_given_values_and_set(spark):
    S.declare(spark, clock="2024-03-10 07:30:00", from_date="2024-03-01", source_title="it's :a \\ 'show'")
    found = S.variables(spark)
    assert str(found["from_date"]) == "2024-03-01" and found["source_title"] == "it's :a \\ 'show'"
    assert found["reached_title"] is None and str(found["to_date"]) == "2024-03-09"
    spark.sql("SET VAR from_date = date_sub(to_date, 6)")
    assert str(S.variables(spark)["from_date"]) == "2024-03-03"
    with pytest.raises(ValueError, match="unknown"):
        S.declare(spark, other="2024-01-01")


def test_script_over_a_saved_table(spark):
    rows = [("a", dt.date(2024, 3, 8), 2.0), ("b", dt.date(2024, 3, 8), 3.0), ("c", dt.date(2024, 3, 2), 9.0)]
    spark.createDataFrame(rows, "account_id string, event_date date, final_watch_time double").createOrReplaceTempView("attribution")
    try:
        S.declare(spark, clock="2024-03-10 07:30:00")
        got = {str(r.event_date): (r.starts, r.seconds) for r in S.run(spark, S.WEEK_REPORT).collect()}
    finally:
        spark.catalog.dropTempView("attribution")
    assert len(got) == 7 and got["2024-03-08"] == (2, 5.0) and got["2024-03-09"] == (0, 0.0) and "2024-03-02" not in got
