"""Daily refresh of the attribution table as an incremental stream.

The original keeps its table fresh by hand: every morning it recomputes
yesterday, and bad days are deleted and recomputed. Here the same job is a
Structured Streaming query over both inputs: the file sources notice new
files of the video log and of the clickstream (late clicks refresh their day
too), each micro-batch names the days it touched (a handful of dates, the
only thing that reaches the driver), reads both inputs anew by path, so that
it sees every file that has landed, and recomputes all these days in one build
and replaces them together with ``reload_days`` (idempotent, so a retried
micro-batch does no harm): a backfill of 92 days is one scan and one shuffle.
``trigger(availableNow=True)`` processes whatever has arrived and stops,
which is how a daily scheduler runs it; the stream's progress is kept in a
checkpoint folder on shared storage.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import local_date
from ..functions.rules import RuleSet, rule_set
from ..operators.maintenance import reload_days
from ..plans.guards import shared_dir
from ..sources.readers import read_clickstream, read_video_log


def refresh_new_days(
    spark: SparkSession,
    clickstream_path: str,
    video_log_path: str,
    table_path: str,
    *,
    rules: RuleSet | str = "R3",
    progress_path: str | None = None,
    map_lag_days: int = 0,
    **build_kwargs,
):
    """Recompute every day with new files in either input (both by path); returns the finished query.

    The series map of a day is built from ``map_lag_days`` before it (0: the
    day itself, as in the daily reload).
    """
    r = rule_set(rules)
    if progress_path is None:
        # Stable across runs, so a later run resumes where the last one stopped.
        digest = hashlib.sha1(f"{clickstream_path}|{video_log_path}|{table_path}".encode()).hexdigest()[:16]
        progress_path = f"{shared_dir(spark).rstrip('/')}/refresh-{digest}"

    def landed(path: str) -> DataFrame:
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    click_day = F.col("event_date").cast("date") if r.click_day_from_upstream else local_date("hit_ts")
    days_stream = landed(video_log_path).select(F.col("event_date").cast("date").alias("event_date")).unionByName(
        landed(clickstream_path).select(click_day.alias("event_date"))
    )

    def refresh(batch: DataFrame, batch_id: int) -> None:
        touched = batch.where(F.col("event_date").isNotNull()).distinct().collect()
        reload_days(
            read_clickstream(spark, clickstream_path),
            read_video_log(spark, video_log_path),
            table_path,
            [row.event_date for row in touched],
            r,
            map_lag_days=map_lag_days,
            **build_kwargs,
        )

    query = (
        days_stream.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
