"""Scans of the two inputs and of a saved attribution table.

The readers only select and type the columns the pipeline uses, so Catalyst
prunes the Parquet scan to them; all row filters live in the operators,
where Catalyst pushes them into the same scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLICKSTREAM_COLUMNS = {
    "account_id": "string",
    "event_date": "date",  # upstream local day (used by R4)
    "revised_ts": "timestamp_ntz",  # UTC instant, zone-less (R4 click time)
    "hit_ts": "timestamp_ntz",  # UTC instant, zone-less (filter; R1-R3 time)
    "player_event": "string",
    "click_details": "string",
    "platform": "string",
    "device": "string",
    "binge_source": "string",  # "|"-separated; first segment is the binge type
}

# Optional: the UTC day of ``hit_ts``, where the clickstream is stored by it.
# A period then lists and reads its own days only.
HIT_DAY = "hit_day"

VIDEO_LOG_COLUMNS = {
    "account_id": "string",
    "event_date": "date",
    "event_ts": "timestamp_ntz",  # local wall-clock time
    "display_name": "string",
    "program": "string",
    "episode_title": "string",
    "content_channel": "string",  # "N/A" when none
    "device": "string",
    "video_id": "string",
    "seconds_no_ads": "double",
    "seconds_with_ads": "double",
    "media_load": "boolean",
}

ATTRIBUTION_COLUMNS = {
    "account_id": "string",
    "event_date": "date",
    "event_ts": "timestamp_ntz",
    "start_type": "string",
    "feeder_title": "string",
    "title": "string",
    "final_watch_time": "double",
}


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Select and cast to a known column set; a missing column is an error, as
    NULLs in its place would drop rows without a word."""
    missing = [name for name in schema if name not in df.columns]
    if missing:
        raise ValueError(f"the input lacks the columns {missing}; it has {df.columns}")
    return df.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in schema.items()])


def is_table_name(source: str) -> bool:
    """Is ``source`` the name of a catalog table (and not a path)?"""
    return re.fullmatch(r"\w+(\.\w+){0,2}", source) is not None


def scan(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by its name, or the table at a path: its last commit where it is
    versioned, else the Parquet files below it. A name without a schema is a table of the current
    schema; a temporary view of that name is read only where there is none."""
    from ..operators import versions

    if is_table_name(source):
        full = versions.qualified(spark, source)
        return spark.table(full if spark.catalog.tableExists(full) else source)
    return versions.read(spark, source) if versions.is_versioned(spark, source) else spark.read.parquet(source)


def read_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """The clickstream (path or table name) in the column names of
    ``CLICKSTREAM_COLUMNS``, with ``hit_day`` if it is stored by that."""
    stored = scan(spark, path)
    return conform(stored, CLICKSTREAM_COLUMNS | ({HIT_DAY: "date"} if HIT_DAY in stored.columns else {}))


def read_video_log(spark: SparkSession, path: str) -> DataFrame:
    """The video log, ideally stored ``partitionBy("event_date")``."""
    return conform(scan(spark, path), VIDEO_LOG_COLUMNS)


def read_attribution(spark: SparkSession, path: str) -> DataFrame:
    """S3: a saved attribution table, by path or name (all its columns)."""
    return scan(spark, path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
