"""Registered queries over the test data (one per operator of the survey).

Every query reads the driver's ``events`` table through the fixture
projection (written once as day-partitioned Parquet), so its work grows with
the table. Computed doubles are rounded to 6 decimals, the same rule the
oracle SQL applies.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import columns as C
from ..functions.rules import rule_set
from ..operators import analytics as A
from ..operators import audience
from ..operators import maintenance as M
from ..operators import versions as V
from ..operators.attribution import (
    build_attribution,
    label_and_credit,
    linear_channels,
    popular_titles,
    sequenced,
)
from ..operators.clicks import (
    apply_series_map,
    build_series_map,
    classify_clicks,
    clean_clicks,
    prepare_clicks,
    series_counts,
)
from ..operators.clustered import save_clustered
from ..operators.ordering import with_positions
from ..operators.videos import prepare_videos
from ..sources.fixture import fixture_tables
from ..streaming.daily import refresh_new_days
from . import script
from .guards import checkpoint_dir, materialize

PARAMS = {
    # The whole month of the test data; the map is built from its last full day.
    "from_date": "2024-01-01",
    "to_date": "2024-01-31",
    "map_date": "2024-01-30",
    # Page-name prefix of details pages in the projected clickstream.
    "details_page": "app:details:",
    # R1 popularity threshold: viewers per title and day (10,000 in production).
    "min_accounts": 6,
    # Funnel titles (normalised form).
    "source_title": "show 1",
    "reached_title": "show 2",
    # Day replaced by the reload query.
    "reload_day": "2024-01-15",
    # A day outside the period, deleted by the reload query.
    "stale_day": "2023-12-25",
    # Last day of the table that replaces a month's.
    "week_end": "2024-01-07",
    # Hot-key threshold of the *_hot_keys queries: every account-day with more
    # rows than this is split into chunks.
    "small_hot_key_rows": 4,
    # Shared-account variant of the test data: users whose id is a multiple
    # of 3 share one account, which then holds about a third of all rows; its
    # account-days exceed the hot-key threshold and are split into chunks.
    "shared_every": 3,
    "shared_hot_key_rows": 25,
    # Title pairs (source, reached) with viewers who return in the test data.
    "title_pairs": [("show 0", "show 2"), ("show 2", "show 3"), ("show 3", "show 4"), ("show 1", "show 2")],
    # The refresh query: all days but the last land first, without a third of the late day's clicks.
    "late_day": "2024-01-11",
    "last_day": "2024-01-31",
    # The clock (UTC) of the query that reloads yesterday; in New York it is still the 14th.
    "clock": "2024-01-15 04:30:00",
    "yesterday": "2024-01-13",
}

ROUNDED = {"island_seconds", "watch_time_start", "watch_time_carry", "final_watch_time", "watch_time"}


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name)
            if f.name in ROUNDED and isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _inputs(spark: SparkSession, sf_dir: str, shared_every: int | None = None, wide: bool = False):
    return fixture_tables(spark, sf_dir, shared_every, wide)


def _period():
    return PARAMS["from_date"], PARAMS["to_date"]


def _rules(name: str):
    return rule_set(name).with_details_page(PARAMS["details_page"])


def _attribution(spark, sf_dir, name, shared_every=None, wide=False, **kw) -> DataFrame:
    clicks, videos = _inputs(spark, sf_dir, shared_every, wide)
    return build_attribution(
        clicks,
        videos,
        _rules(name),
        from_date=PARAMS["from_date"],
        to_date=PARAMS["to_date"],
        map_date=PARAMS["map_date"],
        min_accounts=PARAMS["min_accounts"],
        **kw,
    )


def _sequenced(spark, sf_dir, name, **kw) -> DataFrame:
    clicks, videos = _inputs(spark, sf_dir)
    return sequenced(
        clicks,
        videos,
        _rules(name),
        PARAMS["from_date"],
        PARAMS["to_date"],
        PARAMS["map_date"],
        min_accounts=PARAMS["min_accounts"],
        **kw,
    )


def _scratch_table(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}/{name}"


# --- column functions -----------------------------------------------------


def normalize_titles(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return videos.select(
        "video_id",
        "display_name",
        C.normalize_title("display_name").alias("title_norm"),
        C.normalize_title("episode_title").alias("episode_norm"),
    )


def click_devices(spark, sf_dir):
    clicks, _ = _inputs(spark, sf_dir)
    return clicks.groupBy("device", C.normalize_click_device("device").alias("device_norm")).agg(
        F.count(F.lit(1)).alias("n")
    )


def video_devices(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return videos.groupBy("device", C.normalize_video_device("device").alias("device_norm")).agg(
        F.count(F.lit(1)).alias("n")
    )


def binge_types(spark, sf_dir):
    clicks, _ = _inputs(spark, sf_dir)
    typed = clicks.select("binge_source", "click_details", C.first_segment("binge_source").alias("binge_type"))
    return typed.groupBy(
        "binge_source", "binge_type", C.binge_kind("binge_type", "click_details").alias("binge_kind")
    ).agg(F.count(F.lit(1)).alias("n"))


def _click_classes(name: str, wide: bool = False):
    def query(spark, sf_dir):
        clicks, _ = _inputs(spark, sf_dir, wide=wide)
        r = _rules(name)
        classified = classify_clicks(clean_clicks(clicks, r, *_period()), r)
        return classified.select("account_id", "event_date", "event_ts", "click_details", "action")

    return query


def click_titles(spark, sf_dir):
    return click_titles_of(*_inputs(spark, sf_dir))


def click_titles_of(clicks, _):
    r = _rules("R4")
    classified = classify_clicks(clean_clicks(clicks, r, *_period()), r)
    return classified.select("account_id", "event_ts", "player_event", "click_details", "raw_title")


def linear_channels_flag(spark, sf_dir):
    return linear_flags_of(*_inputs(spark, sf_dir))


def linear_flags_of(_, videos):
    return videos.groupBy("display_name", C.is_linear_channel("display_name").alias("is_linear")).agg(
        F.count(F.lit(1)).alias("n")
    )


def video_titles(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return videos.select(
        "video_id",
        C.video_title("display_name", "program").alias("title"),
        C.video_action("display_name").alias("action"),
    )


def local_days(spark, sf_dir):
    clicks, _ = _inputs(spark, sf_dir)
    return clicks.select(
        "account_id", "hit_ts", C.local_ts("hit_ts").alias("local_ts"), C.local_date("hit_ts").alias("local_day")
    )


def shifted_videos(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return videos.select("video_id", "event_ts", C.shift_seconds("event_ts", -40).alias("shifted_ts"))


# --- timeline stages ------------------------------------------------------

TIMELINE_OUT = ("account_id", "event_date", "event_ts", "action", "device", "title", "video_id", "seconds_no_ads")


def clean_clicks_q(spark, sf_dir):
    clicks, _ = _inputs(spark, sf_dir)
    return prepare_clicks(clicks, _rules("R4"), *_period()).drop("video_id", "seconds_no_ads", "is_video")


def clean_videos_q(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return prepare_videos(videos, _rules("R4"), *_period()).select(*TIMELINE_OUT)


def series_counts_q(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return series_counts(videos, PARAMS["map_date"], _rules("R4"))


def _series_map(name: str):
    def query(spark, sf_dir):
        _, videos = _inputs(spark, sf_dir)
        return build_series_map(videos, PARAMS["map_date"], _rules(name))

    return query


def mapped_clicks(spark, sf_dir):
    clicks, videos = _inputs(spark, sf_dir)
    r = _rules("R4")
    ready = prepare_clicks(clicks, r, *_period())
    return apply_series_map(ready, build_series_map(videos, PARAMS["map_date"], r)).drop(
        "video_id", "seconds_no_ads", "is_video"
    )


def feeder(spark, sf_dir):
    seq = _sequenced(spark, sf_dir, "R4")
    return seq.where(F.col("is_video")).select(
        "account_id", "event_date", "event_ts", "video_id", "title", "feeder_title", "feeder_video_id"
    )


def timeline(spark, sf_dir):
    seq = _sequenced(spark, sf_dir, "R4")
    return seq.select(*TIMELINE_OUT, "feeder_title", "feeder_video_id")


def sequence(spark, sf_dir):
    seq = _sequenced(spark, sf_dir, "R4")
    return seq.select(*TIMELINE_OUT, "feeder_title", "last_action", "island")


def island_seconds(spark, sf_dir):
    seq = _sequenced(spark, sf_dir, "R4")
    return rounded(seq.select(*TIMELINE_OUT, "feeder_title", "island", "island_seconds"))


def popular_titles_q(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return popular_titles(videos, *_period(), PARAMS["min_accounts"])


def linear_channels_q(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return linear_channels(videos, *_period())


def popular_timeline(spark, sf_dir):
    seq = _sequenced(spark, sf_dir, "R1")
    return rounded(seq.select(*TIMELINE_OUT, "feeder_title", "last_action", "island", "island_seconds"))


# --- attribution ----------------------------------------------------------


def _attribution_q(name: str, **kw):
    def query(spark, sf_dir):
        return rounded(_attribution(spark, sf_dir, name, **kw))

    return query


def watch_time_parts(spark, sf_dir):
    seq = _sequenced(spark, sf_dir, "R4")
    parts = label_and_credit(seq, _rules("R4"))
    return rounded(
        parts.select(
            "account_id",
            "event_date",
            "event_ts",
            "device",
            "title",
            "video_id",
            "start_type",
            "watch_time_start",
            "watch_time_carry",
            "final_watch_time",
        )
    )


# --- reports --------------------------------------------------------------


_SAVED: dict[tuple[str, str], str] = {}
_SAVING = threading.Lock()


def _r4_table(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The reports read a saved attribution table, as in production: the R4
    build is written once a session and folder (day-partitioned) and scanned
    by every report."""
    _, videos = _inputs(spark, sf_dir)
    with _SAVING:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _SAVED:
            path = _scratch_table(spark, "attribution_r4")
            M.save_table(_attribution(spark, sf_dir, "R4"), path)
            _SAVED[key] = path
    return spark.read.parquet(_SAVED[key]), videos


def first_starts(spark, sf_dir):
    attribution, _ = _r4_table(spark, sf_dir)
    prompted = A.prompted_first_starts(attribution, PARAMS["source_title"], PARAMS["reached_title"], *_period())
    manual = A.manual_first_starts(attribution, PARAMS["reached_title"], *_period())
    return prompted.select(
        "account_id", F.lit("prompted").alias("kind"), "start", F.lit(None).cast("double").alias("total_hours")
    ).unionByName(manual.select("account_id", F.lit("manual").alias("kind"), "start", "total_hours"))


def return_viewers(spark, sf_dir):
    attribution, _ = _r4_table(spark, sf_dir)
    return A.return_viewers(attribution, PARAMS["source_title"], PARAMS["reached_title"], *_period())


def return_viewers_pairs(spark, sf_dir):
    return _pairs_of(_r4_table(spark, sf_dir)[0])


def _pairs_of(attribution):
    out = None
    for source, reached in PARAMS["title_pairs"]:
        found = A.return_viewers(attribution, source, reached, *_period())
        found = found.select(F.lit(source).alias("source"), F.lit(reached).alias("reached"), *found.columns)
        out = found if out is None else out.unionByName(found)
    return out


def return_viewers_clustered(spark, sf_dir):
    """``return_viewers_pairs`` on the copy of the table that is bucketed by account and ordered by title."""
    attribution, _ = _r4_table(spark, sf_dir)
    with _SAVING:
        key = (spark.sparkContext.applicationId, f"clustered:{sf_dir}")
        if key not in _SAVED:
            name = f"attribution_{uuid.uuid4().hex}"
            save_clustered(attribution, name, 8, _scratch_table(spark, name))
            _SAVED[key] = name
    return _pairs_of(spark.table(_SAVED[key]))


def funnel_returning(spark, sf_dir):
    attribution, videos = _r4_table(spark, sf_dir)
    return A.funnel(attribution, videos, *PARAMS["title_pairs"][1], *_period())


def funnel_stages(spark, sf_dir):
    attribution, videos = _r4_table(spark, sf_dir)
    return A.funnel_stages(attribution, videos, PARAMS["source_title"], PARAMS["reached_title"], *_period())


def funnel(spark, sf_dir):
    attribution, videos = _r4_table(spark, sf_dir)
    return A.funnel(attribution, videos, PARAMS["source_title"], PARAMS["reached_title"], *_period())


def coverage_monitor(spark, sf_dir):
    attribution, videos = _r4_table(spark, sf_dir)
    return A.coverage_monitor(attribution, videos, *_period())


# --- maintenance ----------------------------------------------------------


def pruned(spark, sf_dir):
    path = _scratch_table(spark, "attribution_r2")
    M.save_table(_attribution(spark, sf_dir, "R2"), path)
    M.prune_table(spark, path)
    return rounded(spark.read.parquet(path))


def reloaded_day(spark, sf_dir):
    clicks, videos = _inputs(spark, sf_dir)
    path = _scratch_table(spark, "attribution_r3")
    # The day to reload starts out wrong, and another day is one too many.
    built = _attribution(spark, sf_dir, "R3")
    day = F.lit(PARAMS["reload_day"]).cast("date")
    spoilt = built.withColumn("title", F.when(F.col("event_date") == day, F.lit("wrong")).otherwise(F.col("title")))
    stale = built.where(F.col("event_date") == day).withColumn("event_date", F.lit(PARAMS["stale_day"]).cast("date"))
    M.save_table(spoilt.unionByName(stale), path)
    M.reload_day(clicks, videos, path, PARAMS["reload_day"], _rules("R3"))
    M.delete_day(spark, path, PARAMS["stale_day"])
    return rounded(spark.read.parquet(path).select(*rule_set("R3").output_columns))


def replaced_table(spark, sf_dir):
    """A month's table replaced by its first week's, with no day left over."""
    path = _scratch_table(spark, "attribution_r2")
    M.save_table(_attribution(spark, sf_dir, "R2"), path)
    clicks, videos = _inputs(spark, sf_dir)
    week = build_attribution(
        clicks, videos, _rules("R2"), from_date=PARAMS["from_date"], to_date=PARAMS["week_end"], map_date=PARAMS["map_date"]
    )
    M.save_table(week, path)
    return rounded(spark.read.parquet(path).select(*rule_set("R2").output_columns))


def refreshed_days(spark, sf_dir):
    """All days in two landings of files (the last day and late clicks of an old one come later), each refreshed
    in one build."""
    clicks, videos = _inputs(spark, sf_dir)
    base = _scratch_table(spark, "refresh")
    last, late_day = (F.lit(PARAMS[k]).cast("date") for k in ("last_day", "late_day"))
    late = (C.local_date("hit_ts") == last) | ((F.col("event_date") == late_day) & (F.minute("hit_ts") % 3 == 0))
    landings = [
        (clicks.where(~late), videos.where(F.col("event_date") != last)),
        (clicks.where(late), videos.where(F.col("event_date") == last)),
    ]
    for new_clicks, new_videos in landings:
        new_clicks.write.mode("append").partitionBy("hit_day").parquet(f"{base}/clickstream")
        new_videos.write.mode("append").partitionBy("event_date").parquet(f"{base}/video_log")
        refresh_new_days(
            spark, f"{base}/clickstream", f"{base}/video_log", f"{base}/table", rules=_rules("R3"),
            progress_path=f"{base}/progress",
        )
    days = F.col("event_date").between(*(F.lit(d).cast("date") for d in _period()))
    return rounded(spark.read.parquet(f"{base}/table").where(days).select(*rule_set("R3").output_columns))


def backfilled_days(spark, sf_dir):
    """A versioned table whose days are all recomputed in one build, each with its own day's map; it held
    wrong rows of every day before."""
    clicks, videos = _inputs(spark, sf_dir)
    path = _scratch_table(spark, "backfill")
    M.save_table(_attribution(spark, sf_dir, "R3").withColumn("title", F.lit("wrong")), path, versioned=True)
    first, last = (dt.date.fromisoformat(d) for d in _period())
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    M.reload_days(clicks, videos, path, days, _rules("R3"))
    return rounded(V.read(spark, path).select(*rule_set("R3").output_columns))


def yesterday_reload(spark, sf_dir):
    """The daily job by its script variables: as of a fixed clock, yesterday in New York is recomputed in a versioned
    table, and the report reads the table by the session's dates."""
    clicks, videos = _inputs(spark, sf_dir)
    path = _scratch_table(spark, "daily")
    script.declare(spark, clock=PARAMS["clock"], from_date=PARAMS["from_date"])
    built = _attribution(spark, sf_dir, "R3")
    wrong = F.col("event_date") == F.lit(PARAMS["yesterday"]).cast("date")
    M.save_table(built.withColumn("title", F.when(wrong, F.lit("wrong")).otherwise(F.col("title"))), path, versioned=True)
    M.reload_day(clicks, videos, path, script.variables(spark)["reload_day"], _rules("R3"))
    columns = ", ".join(rule_set("R3").output_columns)
    found = spark.sql(
        f"SELECT {columns} FROM {{saved}} WHERE event_date BETWEEN from_date AND to_date", saved=V.read(spark, path)
    )
    # The variables are the session's, and another query of it may set them: the dates are read now.
    return rounded(materialize(found))


# --- final order ----------------------------------------------------------


def _ordered(name: str, keys: list[str]):
    def query(spark, sf_dir):
        return with_positions(rounded(_attribution(spark, sf_dir, name)), keys)

    return query


def ordered_monitor(spark, sf_dir):
    return with_positions(coverage_monitor(spark, sf_dir), ["event_date"], descending=("event_date",))


# --- reports from kept account sets ---------------------------------------


def _sets(spark, sf_dir) -> DataFrame:
    """The side table of account sets, kept in two updates that share a day; written once a session and folder."""
    attribution, videos = _r4_table(spark, sf_dir)
    with _SAVING:
        key = (spark.sparkContext.applicationId, f"sets:{sf_dir}")
        if key not in _SAVED:
            path = _scratch_table(spark, "audience")
            first, last = (dt.date.fromisoformat(d) for d in _period())
            days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
            played = audience.plays(videos, attribution)
            audience.update(played, path, days[: len(days) // 2])
            audience.update(played, path, days[len(days) // 2 - 1 :])
            _SAVED[key] = path
    return audience.read_sets(spark, _SAVED[key], *_period())


def monitor_from_sets(spark, sf_dir):
    return audience.monitor(_sets(spark, sf_dir))


def popular_from_sets(spark, sf_dir):
    _, videos = _inputs(spark, sf_dir)
    return audience.popular(_sets(spark, sf_dir), videos, *_period(), PARAMS["min_accounts"])


# --- every arm of the rules -----------------------------------------------


def _wide(query):
    """A query of clicks and videos on the projection in which every arm is met."""

    def run(spark, sf_dir):
        return query(*_inputs(spark, sf_dir, wide=True))

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_titles": normalize_titles,
    "click_devices": click_devices,
    "video_devices": video_devices,
    "binge_types": binge_types,
    "click_classes_r1": _click_classes("R1"),
    "click_classes_r2": _click_classes("R2"),
    "click_classes_r4": _click_classes("R4"),
    "click_titles": click_titles,
    "linear_channels_flag": linear_channels_flag,
    "video_titles": video_titles,
    "local_days": local_days,
    "shifted_videos": shifted_videos,
    "clean_clicks": clean_clicks_q,
    "clean_videos": clean_videos_q,
    "series_counts": series_counts_q,
    "series_map": _series_map("R4"),
    "series_map_r3": _series_map("R3"),
    "mapped_clicks": mapped_clicks,
    "feeder": feeder,
    "timeline": timeline,
    "sequence": sequence,
    "island_seconds": island_seconds,
    "popular_titles": popular_titles_q,
    "linear_channels": linear_channels_q,
    "popular_timeline": popular_timeline,
    "attribution_r1": _attribution_q("R1"),
    "attribution_r2": _attribution_q("R2"),
    "attribution_r3": _attribution_q("R3"),
    "attribution_r4": _attribution_q("R4"),
    "attribution_r1_hot_keys": _attribution_q("R1", hot_key_rows=PARAMS["small_hot_key_rows"]),
    "attribution_r2_hot_keys": _attribution_q("R2", hot_key_rows=PARAMS["small_hot_key_rows"]),
    "attribution_r3_hot_keys": _attribution_q("R3", hot_key_rows=PARAMS["small_hot_key_rows"]),
    "attribution_r4_hot_keys": _attribution_q("R4", hot_key_rows=PARAMS["small_hot_key_rows"]),
    "attribution_r4_shared_account": _attribution_q(
        "R4", shared_every=PARAMS["shared_every"], hot_key_rows=PARAMS["shared_hot_key_rows"]
    ),
    "attribution_r3_shared_account": _attribution_q(
        "R3", shared_every=PARAMS["shared_every"], hot_key_rows=PARAMS["shared_hot_key_rows"]
    ),
    "watch_time_parts": watch_time_parts,
    "first_starts": first_starts,
    "return_viewers": return_viewers,
    "funnel_stages": funnel_stages,
    "funnel": funnel,
    "coverage_monitor": coverage_monitor,
    "pruned": pruned,
    "reloaded_day": reloaded_day,
    "replaced_table": replaced_table,
    "refreshed_days": refreshed_days,
    "backfilled_days": backfilled_days,
    "yesterday_reload": yesterday_reload,
    "ordered_r1": _ordered("R1", ["account_id", "event_date", "event_ts"]),
    "ordered_r3": _ordered("R3", ["account_id", "event_date", "device", "event_ts"]),
    "ordered_monitor": ordered_monitor,
    "monitor_from_sets": monitor_from_sets,
    "popular_from_sets": popular_from_sets,
    "return_viewers_pairs": return_viewers_pairs,
    "return_viewers_clustered": return_viewers_clustered,
    "funnel_returning": funnel_returning,
    # Joins that no side may be broadcast for.
    "attribution_r1_shuffle_joins": _attribution_q("R1", max_broadcast_rows=0),
    "attribution_r4_shuffle_joins": _attribution_q(
        "R4", max_broadcast_rows=0, hot_key_rows=PARAMS["small_hot_key_rows"]
    ),
    # The projection in which every arm of the rules is met.
    "click_classes_r1_all_arms": _click_classes("R1", wide=True),
    "click_classes_r2_all_arms": _click_classes("R2", wide=True),
    "click_classes_r4_all_arms": _click_classes("R4", wide=True),
    "click_titles_all_arms": _wide(click_titles_of),
    "linear_channels_flag_all_arms": _wide(linear_flags_of),
    "series_map_all_arms": _wide(lambda _, videos: build_series_map(videos, PARAMS["map_date"], _rules("R4"))),
    "series_map_r1_all_arms": _wide(lambda _, videos: build_series_map(videos, PARAMS["map_date"], _rules("R1"))),
    "attribution_r1_all_arms": _attribution_q("R1", wide=True),
    "attribution_r2_all_arms": _attribution_q("R2", wide=True),
    "attribution_r3_all_arms": _attribution_q("R3", wide=True),
    "attribution_r4_all_arms": _attribution_q("R4", wide=True),
    "attribution_r4_all_arms_hot_keys": _attribution_q("R4", wide=True, hot_key_rows=PARAMS["small_hot_key_rows"]),
}
