"""The original's script variables as Spark session variables (S4, S6, CURRENT_DATE).

The original opens with ``DECLARE from_date ...; DECLARE to_date ...`` and computes yesterday
from CURRENT_DATE in New York. ``declare`` gives a Spark session the same variables; any SQL of the session
reads them by name, and ``SET VAR`` changes them. The run's clock is a variable too (UTC, without a
zone), so that a run can be repeated as of any moment:

    declare(spark)                                # as of now: every date is yesterday in New York
    declare(spark, clock="2024-03-10 07:30:00")   # as of then
    spark.sql("SET VAR from_date = date_sub(to_date, 6)")
    spark.sql("SELECT * FROM attribution WHERE event_date BETWEEN from_date AND to_date")

``run`` executes a SQL script (``BEGIN ... END``) in that session, statement by statement
with its loops and conditions, and returns the rows of its last query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..functions import columns as C

DATES = ("from_date", "to_date", "map_date", "reload_day")
TITLES = ("source_title", "reached_title")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def declare(spark: SparkSession, clock: dt.datetime | str | None = None, tz: str = C.NEW_YORK, **values) -> None:
    """Declare ``run_clock``, ``yesterday``, the dates and the funnel's titles. Dates that aren't given are
    yesterday in ``tz`` as of the clock, titles NULL."""
    unknown = set(values) - {*DATES, *TITLES}
    if unknown:
        raise ValueError(f"unknown variables {sorted(unknown)}; there are {DATES + TITLES}")
    clock = _now() if clock is None else dt.datetime.fromisoformat(str(clock))
    spark.sql(f"DECLARE OR REPLACE VARIABLE run_clock TIMESTAMP_NTZ DEFAULT TIMESTAMP_NTZ'{clock.isoformat(' ')}'")
    spark.sql("DECLARE OR REPLACE VARIABLE yesterday DATE")
    spark.sql(f"SET VAR yesterday = date_sub(to_date(convert_timezone('UTC', '{tz}', run_clock)), 1)")
    for name in DATES:
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} DATE")
        given = values.get(name)
        spark.sql(f"SET VAR {name} = " + ("yesterday" if given is None else f"DATE'{dt.date.fromisoformat(str(given))}'"))
    for name in TITLES:
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} STRING")
        if values.get(name) is not None:
            spark.sql(f"SET VAR {name} = :value", args={"value": values[name]})


def variables(spark: SparkSession) -> dict:
    """The variables' values in this session."""
    names = ("run_clock", "yesterday", *DATES, *TITLES)
    return spark.sql(f"SELECT {', '.join(f'session.{n} AS {n}' for n in names)}").first().asDict()


def run(spark: SparkSession, script: str) -> DataFrame:
    """Run a SQL script and return its last query's rows."""
    return spark.sql(script)


# A week of the table up to ``to_date``, with the days that have no rows yet.
WEEK_REPORT = """
BEGIN
  SET from_date = date_sub(to_date, 6);
  IF map_date IS NULL THEN
    SET map_date = to_date;
  END IF;
  SELECT d.day AS event_date, count(a.account_id) AS starts, coalesce(sum(a.final_watch_time), 0) AS seconds
  FROM (SELECT explode(sequence(from_date, to_date)) AS day) d
  LEFT JOIN attribution a ON a.event_date = d.day AND a.event_date BETWEEN from_date AND to_date
  GROUP BY d.day;
END
"""
