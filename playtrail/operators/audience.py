"""Exact account sets per day and title (A2, A6, A7): distinct counts over any period without a rescan.

A count of distinct accounts can't be added up over days, so every report over another period, and
every popularity threshold, reads all rows again. The side table kept here can be: it holds, per
kind of play, day and title, the set of accounts as bitmaps over dense account numbers, and the
seconds played. Sets of different days are united by OR, and counted by their bits, exactly.

* ``accounts``: (account_id, account_no), numbers 1, 2, 3, ...; an account keeps its number, new ones
  get the next ones from a range shuffle (``ordering``).
* ``sets``: (kind, title, bucket, bits, seconds, event_date). A bucket is 32,768 accounts, a row of it
  4 KB, mostly zeros that Parquet's encodings shrink; a day's set has a row for each bucket that it
  touches, so no row and no group grows with the number of viewers.

Both are versioned tables: ``update`` replaces the sets of the days it is given in one commit, and may be
repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..plans.guards import materialize
from . import versions as V
from .clicks import _as_date
from .ordering import with_positions

LOGGED, ATTRIBUTED = "logged", "attributed"
KINDS = (LOGGED, ATTRIBUTED)


def plays(videos: DataFrame, attribution: DataFrame) -> DataFrame:
    """(kind, event_date, title, account_id, seconds): what the reports count. Logged plays are under the
    log's title (program where there is no display name), attributed ones under the table's."""
    logged = videos.where(F.col("seconds_no_ads") > 0).select(
        F.lit(LOGGED).alias("kind"), "event_date", C.video_title("display_name", "program").alias("title"),
        "account_id", F.col("seconds_no_ads").alias("seconds"),
    )
    attributed = attribution.where(F.col("final_watch_time") > 0).select(
        F.lit(ATTRIBUTED).alias("kind"), "event_date", "title", "account_id", F.col("final_watch_time").alias("seconds")
    )
    return logged.unionByName(attributed)


def _numbers(spark: SparkSession, path: str) -> DataFrame | None:
    folder = f"{path}/accounts"
    return V.read(spark, folder).select("account_id", "account_no") if V.is_versioned(spark, folder) else None


def _number_new(played: DataFrame, path: str) -> DataFrame:
    """All account numbers, after those of new accounts have been added to the table."""
    spark = played.sparkSession
    known = _numbers(spark, path)
    seen = played.where(F.col("account_id").isNotNull()).select("account_id").distinct()
    top = 0
    if known is not None:
        top = known.agg(F.max("account_no")).first()[0] or 0
        seen = seen.join(known, "account_id", "left_anti")
    new = with_positions(seen, ["account_id"], name="account_no").withColumn("account_no", F.col("account_no") + F.lit(top))
    # A part of its own for each update: the numbers given out before aren't written again.
    new = new.select("account_id", "account_no", F.lit(f"after-{top}").alias("part"))
    folder = f"{path}/accounts"
    before = V.snapshot(spark, folder)
    written = V._write(new, folder, "part")
    if written or not before["commit"]:
        V._commit(spark, folder, before, new.schema, "part", before["days"] | written)
    return _numbers(spark, path)


def update(played: DataFrame, path: str, days) -> None:
    """Replace the sets of ``days`` by those of ``played`` (``plays``)."""
    days = sorted({_as_date(d) for d in days})
    own = played.where(F.col("event_date").isin(*map(F.lit, days)))
    numbers = _number_new(own, path)
    numbered = own.join(numbers, "account_id", "left")
    # Without an account, the seconds count and no bit is set.
    bits = F.bitmap_construct_agg(F.when(F.col("account_no").isNotNull(), F.bitmap_bit_position("account_no")))
    sets = numbered.groupBy("kind", "title", F.bitmap_bucket_number("account_no").alias("bucket"), "event_date").agg(
        bits.alias("bits"), F.sum("seconds").alias("seconds")
    )
    V.replace_days(sets.select("kind", "title", "bucket", "bits", "seconds", "event_date"), f"{path}/sets", days)


def read_sets(spark: SparkSession, path: str, from_date, to_date) -> DataFrame:
    """The sets of a period; only its days' folders are read."""
    return V.read(spark, f"{path}/sets").where(F.col("event_date").between(F.lit(_as_date(from_date)), F.lit(_as_date(to_date))))


def audience(sets: DataFrame, *keys: str) -> DataFrame:
    """Distinct accounts and seconds per ``keys``: the sets of a bucket are united, then buckets, which hold
    different accounts, are added up. Both steps combine before they shuffle."""
    united = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("seconds").alias("seconds"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("accounts"), F.sum("seconds").alias("seconds"))


def popular(sets: DataFrame, videos: DataFrame, from_date, to_date, min_accounts: int) -> DataFrame:
    """A2 + J5 from the sets: R1's popular titles per day (``attribution.popular_titles``)."""
    from .attribution import without_channels

    found = audience(sets.where(F.col("kind") == LOGGED), "event_date", "title")
    found = found.where((F.col("accounts") >= min_accounts) & F.col("title").isNotNull())
    return without_channels(found.select("event_date", C.normalize_title("title").alias("title")), videos, from_date, to_date)


def monitor(sets: DataFrame) -> DataFrame:
    """C17 from the sets alone: ``analytics.coverage_monitor`` without either of its tables."""
    from .analytics import _hours, coverage_ratios

    found = materialize(audience(sets, "kind", "event_date"))

    def of(kind: str, accounts: str, hours: str) -> DataFrame:
        return found.where(F.col("kind") == kind).select("event_date", F.col("accounts").alias(accounts), _hours(F.col("seconds")).alias(hours))

    return coverage_ratios(of(ATTRIBUTED, "accts", "watched_hours"), of(LOGGED, "sv_accts", "sv_watch_hours"))
