"""Ordered-timeline windows (W1-W9) over one partitioning of the data.

Layout
------
Videos and clicks are each hash-partitioned once on ``(account_id,
event_date[, _chunk])``; the feeder window runs on the videos alone, and the
union of both sides keeps the partitioning. Every window afterwards is keyed
by a superset of those columns (the sequence windows add ``device``), so
Spark plans no further exchange of the timeline rows: each row is shuffled
exactly once.

Hot keys
--------
A single account-day can be arbitrarily large (a shared or automated
account). Keys with more than ``hot_key_rows`` rows are found by frequent-items
sketches (``hot_keys``) and split into chunks of roughly ``hot_key_rows`` rows
each, cut at second boundaries by a running count of rows per second, and inside
a second that holds more by the order of its rows.
Windows then run per chunk, and the few values that cross a chunk border
(the previous row's fields, the next row's fields, the running island
number, island totals) are carried over by per-chunk summary tables: one
row per chunk, with windows over at most "chunks per key" rows. Only the rows
of hot keys meet this plan: they are written once to the checkpoint folder (with
many hot keys the whole timeline is, and read by both plans) and
chunked there, all other rows take the plain plan, and both results are
united. Without hot keys none of this is planned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.guards import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast, fits, materialize
from .hot_keys import hot_account_days, look
from .ordering import with_totals_before

# Row order inside a partition. The original orders by time only; ties are
# broken by all other columns a row has at that point, so LAG/LEAD never
# depend on the order in which rows arrive.
VIDEO_ORDER = ("event_ts", "video_id", "title", "action", "device", "seconds_no_ads")
TIMELINE_ORDER = (
    "event_ts",
    "video_id",
    "title",
    "action",
    "click_details",
    "player_event",
    "binge_type",
    "device",
    "seconds_no_ads",
    "feeder_title",
    "feeder_video_id",
)

BASE_KEYS = ("account_id", "event_date")

DEFAULT_HOT_KEY_ROWS = 4_000_000

# With more hot account-days than this, the whole timeline is written once instead of being made twice, for
# the hot rows and for the others.
MANY_HOT_KEYS = 10_000

# Stands for a NULL day among the hot rows.
NO_DAY = "9999-12-31"


@dataclass(frozen=True)
class Layout:
    chunked: bool

    @property
    def window_keys(self) -> tuple[str, ...]:
        return ("_hot", "_chunk") if self.chunked else ()

    @property
    def partition_keys(self) -> tuple[str, ...]:
        return BASE_KEYS + (("_chunk",) if self.chunked else ())


def _second(ts: str | Column) -> Column:
    return F.date_trunc("second", F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def _hour(ts: str | Column) -> Column:
    return F.date_trunc("hour", F.col(ts) if isinstance(ts, str) else ts)


# The order of rows that share a time; rows equal in all of it stay together.
TIE_ORDER = TIMELINE_ORDER[1:-2]


def chunk_hours(times: DataFrame, target_rows: int) -> DataFrame:
    """For account-days of ``times``: per hour, the chunk it starts in, the places inside it where a new
    chunk starts, and the seconds that hold more than ``target_rows`` rows.

    Rows are counted per second; a running count over the seconds of one
    key (a window over at most 86,400 rows) cuts them into chunks of about
    ``target_rows`` rows, however bursty the key is. A chunk is a monotone
    function of the row order, so chunk order is row order. The table keeps one row per hot
    key-hour (24 per day), so it stays small enough to broadcast for many hot keys.
    """
    per_second = times.groupBy(*BASE_KEYS, _second("event_ts").alias("_second")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*BASE_KEYS).orderBy("_second")
    before = F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunk = F.floor(F.col("_before") / F.lit(target_rows)).cast("long")
    chunked = per_second.withColumn("_before", before).withColumn("_chunk", chunk)
    prev = F.lag("_chunk").over(w)
    no_key = F.lit(None).cast(_tie_type(times))
    starts = F.when(prev.isNull() | (prev != F.col("_chunk")), F.struct("_second", no_key.alias("_key"), "_chunk"))
    full = F.when(F.col("_c") > target_rows, F.struct("_second", "_before"))
    return (
        chunked.select(*BASE_KEYS, "_second", "_chunk", starts.alias("_start"), full.alias("_full"))
        .groupBy(*BASE_KEYS, _hour("_second").alias("_hour"))
        .agg(
            F.min("_chunk").alias("_base"),
            F.array_sort(F.collect_list("_start")).alias("_starts"),
            F.collect_list("_full").alias("_full"),
        )
    )


def _tie_type(df: DataFrame) -> str:
    types = dict(df.dtypes)
    return "struct<" + ",".join(f"{c}:{types.get(c, 'string')}" for c in TIE_ORDER) + ">"


def split_seconds(timeline: DataFrame, hours: DataFrame, target_rows: int, max_broadcast_rows: int) -> DataFrame:
    """``hours`` with the places inside its overfull seconds where a new chunk starts.

    The rows of such a second are counted by their place in the order of ties, and a prefix sum in two
    levels (``ordering.with_totals_before``) over these places, not over one second in one task, cuts
    them. Rows that are equal in the whole order keep one place.
    """
    full = hours.select(*BASE_KEYS, F.inline("_full")).withColumnsRenamed({"_second": "_full_second", "_before": "_rows_before"})
    keys = {c: f"_full_{c}" for c in BASE_KEYS}
    side, _ = bounded_broadcast(full.withColumnsRenamed(keys), max_broadcast_rows)
    second = _second("event_ts")
    on = _all([F.col(c) == F.col(k) for c, k in keys.items()]) & second.eqNullSafe(F.col("_full_second"))
    places = (
        timeline.join(side, on)
        .groupBy(*BASE_KEYS, "_full_second", "_rows_before", "event_ts", *TIE_ORDER)
        .agg(F.count(F.lit(1)).alias("_w"))
    )
    placed = with_totals_before(places, [*BASE_KEYS, "_full_second", "event_ts", *TIE_ORDER], "_w", "_b")
    of_second = [*BASE_KEYS, "_full_second"]
    first = placed.groupBy(*of_second).agg(F.min("_b").alias("_first_b")).withColumnsRenamed({c: f"_own_{c}" for c in of_second})
    same = _all([F.col(c).eqNullSafe(F.col(f"_own_{c}")) for c in of_second])
    chunk = F.floor((F.col("_rows_before") + F.col("_b") - F.col("_first_b")) / F.lit(target_rows)).cast("long")
    cuts = (
        placed.join(bounded_broadcast(first, max_broadcast_rows)[0], same)
        .withColumn("_chunk", chunk)
        .where(F.col("_chunk") > F.floor(F.col("_rows_before") / F.lit(target_rows)))
        .groupBy(*of_second, "_chunk")
        .agg(F.min(F.struct("event_ts", *TIE_ORDER)).alias("_at"))
    )
    key = F.struct(*[F.col(f"_at.{c}") for c in TIE_ORDER]).alias("_key")
    more = cuts.groupBy(*BASE_KEYS, _hour("_full_second").alias("_hour")).agg(
        F.collect_list(F.struct(F.col("_at.event_ts").alias("_second"), key, "_chunk")).alias("_more")
    )
    more = more.withColumnsRenamed({c: f"_m_{c}" for c in (*BASE_KEYS, "_hour")})
    same = _all([F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in (*BASE_KEYS, "_hour")])
    all_starts = F.array_sort(F.concat("_starts", F.coalesce("_more", F.array().cast(hours.schema["_starts"].dataType))))
    return hours.join(more, same, "left").select(*BASE_KEYS, "_hour", "_base", all_starts.alias("_starts"))


def assign_chunks(
    timeline: DataFrame,
    times: DataFrame | None,
    hot_key_rows: int | None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> tuple[DataFrame, Layout]:
    """Tag rows of hot account-days with a chunk of about ``hot_key_rows`` rows.

    ``times`` must cover every timeline row's ``(account_id, event_date,
    event_ts)``. When no key is hot the timeline is returned untouched.
    """
    if times is None or hot_key_rows is None:
        return timeline, Layout(chunked=False)
    hot = hot_account_days(times, hot_key_rows)
    if hot.isEmpty():
        return timeline, Layout(chunked=False)
    side, _ = bounded_broadcast(hot, max_broadcast_rows)
    return _tag(timeline, times.join(side, list(BASE_KEYS)), hot_key_rows, max_broadcast_rows), Layout(chunked=True)


def _tag(timeline: DataFrame, times: DataFrame, hot_key_rows: int, max_broadcast_rows: int) -> DataFrame:
    """The timeline with the chunks of the account-days that are in ``times``."""
    typed = dict(timeline.dtypes)
    blank = [F.lit(None).cast(typed[c]).alias(c) for c in TIE_ORDER if c not in times.columns]
    hours = materialize(chunk_hours(times.select("*", *blank), hot_key_rows))
    small, _, full = fits(hours, max_broadcast_rows, also=F.max(F.size("_full")))
    if full:
        hours = materialize(split_seconds(timeline, hours, hot_key_rows, max_broadcast_rows))
        small, _ = fits(hours, max_broadcast_rows)
    hours = F.broadcast(hours.drop("_full")) if small else hours.drop("_full")
    joined = timeline.join(
        hours,
        (timeline["account_id"] == hours["account_id"])
        & (timeline["event_date"] == hours["event_date"])
        # Null-safe: rows without a time sort first.
        & _hour("event_ts").eqNullSafe(hours["_hour"]),
        "left",
    )
    # A start at a second's beginning has no key, and one inside it has the time of its row.
    own = F.struct(timeline["event_ts"].alias("_second"), F.struct(*[timeline[c].alias(c) for c in TIE_ORDER]).alias("_key"))
    started = F.filter(
        hours["_starts"], lambda st: F.struct(st["_second"].alias("_second"), st["_key"].alias("_key")) <= own
    )
    chunk = F.coalesce(F.try_element_at(started, F.lit(-1))["_chunk"], hours["_base"])
    tagged = joined.select(
        *[timeline[c] for c in timeline.columns],
        hours["_base"].isNotNull().alias("_hot"),
        F.coalesce(chunk, F.lit(0)).cast("long").alias("_chunk"),
    )
    # The windows and the summaries read the tagged rows several times over, each with columns of its own,
    # so that Spark can't share the shuffles of this join: it is done once.
    return tagged if small else materialize(tagged)


def _null_safe_key(name: str) -> Column:
    """A key that is equal where ``name`` is, NULLs included, and can be hashed."""
    return F.coalesce(F.concat(F.lit("+"), F.col(name)), F.lit("-"))


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return _all([left[k].eqNullSafe(right[k]) for k in keys])


def add_feeder(videos: DataFrame, layout: Layout) -> DataFrame:
    """Previous video (title, id) of the account-day on any device.

    Runs on the video rows only (partitioned like the timeline), so the
    clicks are not sorted for it.
    """
    ck = layout.window_keys
    w = Window.partitionBy(*BASE_KEYS, *ck).orderBy(*VIDEO_ORDER)
    t = videos.select(
        "*",
        F.lag("title").over(w).alias("_lag_title"),
        F.lag("video_id").over(w).alias("_lag_vid"),
        (F.row_number().over(w) == 1).alias("_a_first"),
    )
    if layout.chunked:
        last = F.max_by(F.struct("title", "video_id"), F.struct(*VIDEO_ORDER))
        per_chunk = t.where(F.col("_hot")).groupBy(*BASE_KEYS, "_chunk").agg(last.alias("_last"))
        carry = per_chunk.select(
            *BASE_KEYS,
            "_chunk",
            F.lag("_last").over(Window.partitionBy(*BASE_KEYS).orderBy("_chunk")).alias("_carry"),
        ).where(F.col("_carry").isNotNull())
        t = t.join(carry.hint("shuffle_hash"), [*BASE_KEYS, "_chunk"], "left")
        first = F.col("_a_first") & F.col("_carry").isNotNull()
        lag_title = F.when(first, F.col("_carry.title")).otherwise(F.col("_lag_title"))
        lag_vid = F.when(first, F.col("_carry.video_id")).otherwise(F.col("_lag_vid"))
    else:
        lag_title, lag_vid = F.col("_lag_title"), F.col("_lag_vid")
    keep = [c for c in videos.columns]
    return t.select(*keep, lag_title.alias("feeder_title"), lag_vid.alias("feeder_video_id"))


def sequence_timeline(
    timeline: DataFrame,
    keys: tuple[str, ...],
    *,
    between: Callable[[DataFrame], DataFrame] | None = None,
    times: DataFrame | None = None,
    hot_key_rows: int | None = None,
    hot_keys: DataFrame | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Feeder, last action, island number and seconds, neighbours.

    ``keys`` are the sequence keys (``account_id, event_date[, device]``).
    ``between`` filters rows after the island numbers are set and before the
    island seconds are summed (the popular-title filter of R1).
    ``times`` (account, day and time of the rows, or of a superset) and
    ``hot_key_rows`` switch on chunking of account-days above that size;
    ``hot_keys`` names them (or more) where they are known already.

    Adds: ``feeder_title, feeder_video_id, last_action, island,
    island_seconds, prev_title, prev_feeder, next_title, next_feeder``.
    """
    plain = Layout(chunked=False)
    if hot_key_rows is None or (times is None and hot_keys is None):
        return _sequence(timeline, keys, plain, between)
    if hot_keys is None:
        hot, small, n = look(times, hot_key_rows, max_broadcast_rows)
    else:
        hot, (small, n) = hot_keys, fits(hot_keys, max_broadcast_rows)
    if n == 0:
        return _sequence(timeline, keys, plain, between)
    side = hot.select(*[F.col(c).alias(f"_key_{c}") for c in BASE_KEYS])
    side = F.broadcast(side) if small else side
    is_hot = _all([F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in BASE_KEYS])
    if n > MANY_HOT_KEYS:
        # Much of the timeline is hot: it is made and told apart once, and both plans read it.
        named = side.distinct().withColumn("_named", F.lit(True))
        named = F.broadcast(named) if small else named
        told = materialize(timeline.join(named, is_hot, "left").select(*timeline.columns, F.col("_named").isNotNull().alias("_named")))
        cold_rows, hot_rows = told.where(~F.col("_named")).drop("_named"), told.where("_named").drop("_named")
    else:
        cold_rows = timeline.join(side, is_hot, "left_anti")
        hot_rows = materialize(timeline.join(side, is_hot, "left_semi"))
    cold = _sequence(cold_rows, keys, plain, between)
    # R4 takes a click's day from upstream, where it may be NULL: such rows are
    # split as well, under a day that no log holds.
    no_day = F.lit(NO_DAY).cast("date")
    rows = hot_rows.withColumn("event_date", F.coalesce("event_date", no_day))
    tagged = _tag(rows, rows, hot_key_rows, max_broadcast_rows)
    split = _sequence(tagged, keys, Layout(chunked=True), between, timeline.columns)
    return cold.unionByName(split.withColumn("event_date", F.nullif("event_date", no_day)))


def _sequence(
    tagged: DataFrame,
    keys: tuple[str, ...],
    layout: Layout,
    between: Callable[[DataFrame], DataFrame] | None,
    columns: list[str] | None = None,
) -> DataFrame:
    """``sequence_timeline`` on one layout; ``columns`` are those of the timeline."""
    columns = columns or tagged.columns
    # Videos and clicks are shuffled separately on the same keys; the union
    # keeps that partitioning, so every row still moves once, and only the
    # videos are sorted for the feeder window. (Filtering on the literal
    # ``is_video`` prunes the other branch of the union.)
    videos = tagged.where(F.col("is_video")).repartition(*layout.partition_keys)
    clicks = tagged.where(~F.col("is_video")).repartition(*layout.partition_keys)
    t = add_feeder(videos, layout).unionByName(
        clicks.select("*", F.lit("").alias("feeder_title"), F.lit("").alias("feeder_video_id"))
    )

    ck = layout.window_keys
    w = Window.partitionBy(*keys, *ck).orderBy(*TIMELINE_ORDER)
    w_range = Window.partitionBy(*keys, *ck).orderBy("event_ts")
    same = F.col("feeder_title") == F.col("title")
    step = F.when(same, F.lit(0)).otherwise(F.lit(1))
    contrib = F.when(same, F.col("seconds_no_ads")).otherwise(F.lit(0.0))
    seq = t.select(
        "*",
        F.lag("action").over(w).alias("_last_action"),
        F.lag("title").over(w).alias("_prev_title"),
        F.lag("feeder_title").over(w).alias("_prev_feeder"),
        F.lead("title").over(w).alias("_next_title"),
        F.lead("feeder_title").over(w).alias("_next_feeder"),
        F.sum(step).over(w_range).alias("_grp"),
        contrib.alias("_contrib"),
    )
    if layout.chunked:
        seq = seq.select(
            "*",
            (F.row_number().over(w) == 1).alias("_b_first"),
            F.lead(F.lit(1)).over(w).isNull().alias("_b_last"),
        )
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        seq = seq.select(
            "*",
            F.last("_grp").over(whole).alias("_tot_row"),
            F.first("_grp").over(whole).alias("_first_grp"),
            F.first("event_ts").over(whole).alias("_first_ts"),
            F.last("event_ts").over(whole).alias("_last_ts"),
        )
        # Rows of a chunk's last time: later chunks may hold rows of the same time, and equal
        # times share an island number.
        seq = seq.withColumn("_tie", F.col("event_ts").eqNullSafe(F.col("_last_ts")))
    pre = seq
    post = between(pre) if between is not None else pre
    tie = ["_tie"] if layout.chunked else []
    post = post.select("*", F.sum("_contrib").over(Window.partitionBy(*keys, *ck, "_grp", *tie)).alias("_part"))

    if not layout.chunked:
        return post.select(
            *columns,
            "feeder_title",
            "feeder_video_id",
            F.col("_last_action").alias("last_action"),
            F.col("_grp").alias("island"),
            F.col("_part").alias("island_seconds"),
            F.col("_prev_title").alias("prev_title"),
            F.col("_prev_feeder").alias("prev_feeder"),
            F.col("_next_title").alias("next_title"),
            F.col("_next_feeder").alias("next_feeder"),
        )

    # The summaries are joined by all keys. With the session settings of ``JOB_CONF`` Spark shuffles them
    # as the rows are (account, day, chunk), which stay where they are; a hash finds a row's device.
    extra = {f"_key_{k}": _null_safe_key(k) for k in keys if k not in BASE_KEYS}
    fix = _chunk_fixups(pre, post, keys, filtered=between is not None).withColumns(extra).drop(*(k for k in keys if k not in BASE_KEYS))
    joined = post.withColumns(extra).join(fix.hint("shuffle_hash"), [*BASE_KEYS, "_chunk", *extra], "left")
    has = F.col("_offset").isNotNull()
    first = has & F.col("_b_first")
    last = has & F.col("_b_last")
    island_seconds = (
        F.when(~has, F.col("_part"))
        .when(F.col("_tie"), F.col("_tie_total"))
        .when(F.col("_grp") == 0, F.col("_head_total"))
        .when(F.col("_grp") == F.col("_first_grp"), F.col("_first_total"))
        .when(F.col("_grp") == F.col("_tot_row"), F.col("_tail_total"))
        .otherwise(F.col("_part"))
    )
    later = F.when(F.col("_tie"), F.coalesce(F.col("_extra"), F.lit(0))).otherwise(F.lit(0))
    return joined.select(
        *columns,
        "feeder_title",
        "feeder_video_id",
        F.when(first, F.col("_prev_last.action")).otherwise(F.col("_last_action")).alias("last_action"),
        (F.col("_grp") + F.coalesce(F.col("_offset"), F.lit(0)) + later).alias("island"),
        island_seconds.alias("island_seconds"),
        F.when(first, F.col("_prev_last.title")).otherwise(F.col("_prev_title")).alias("prev_title"),
        F.when(first, F.col("_prev_last.feeder_title")).otherwise(F.col("_prev_feeder")).alias("prev_feeder"),
        F.when(last, F.col("_next_first.title")).otherwise(F.col("_next_title")).alias("next_title"),
        F.when(last, F.col("_next_first.feeder_title")).otherwise(F.col("_next_feeder")).alias("next_feeder"),
    )


def _chunk_fixups(pre: DataFrame, post: DataFrame, keys: tuple[str, ...], filtered: bool) -> DataFrame:
    """One row per chunk of a hot key (``keys``, so of each device) with the cross-chunk values.

    Everything here works on chunk summaries: one row per chunk and key (or
    a few entries per chunk), so every window below spans at most the number
    of chunks of one key. ``pre``/``post`` are the rows before and after the
    optional filter between island numbering and island seconds (``filtered``
    says whether they differ).
    """
    keys = list(keys)
    order = F.struct(*TIMELINE_ORDER)
    plain, grp = ~F.col("_tie"), F.col("_grp")
    neighbours = [
        F.max_by(F.struct("action", "title", "feeder_title"), order).alias("_last"),
        F.min_by(F.struct("title", "feeder_title"), order).alias("_first"),
        # The same in every row of the chunk.
        *[F.first(c).alias(c) for c in ("_tot_row", "_first_grp", "_first_ts", "_last_ts")],
    ]
    # The islands of a chunk that may go on in another: that of its first rows without a step, that of its
    # first time, that of its last rows, and the rows of its last time.
    border = {
        "head": plain & (grp == 0),
        "first": plain & (grp == F.col("_first_grp")) & (F.col("_first_grp") > 0),
        "tail": plain & (grp == F.col("_tot_row")) & (F.col("_tot_row") > 0) & (F.col("_tot_row") != F.col("_first_grp")),
        "tie": F.col("_tie"),
    }
    partials = [F.sum(F.when(c, F.col("_contrib"))).alias(f"_{k}_part") for k, c in border.items()]
    partials += [F.max(c).alias(f"_has_{k}") for k, c in border.items()]
    if not filtered:
        summary = post.where(F.col("_hot")).groupBy(*keys, "_chunk").agg(*neighbours, *partials)
    else:
        # Neighbours and island numbers come from the rows before the
        # filter; a chunk may lose all its rows to the filter.
        before = pre.where(F.col("_hot")).groupBy(*keys, "_chunk").agg(*neighbours)
        after = post.where(F.col("_hot")).groupBy(*keys, "_chunk").agg(*partials)
        summary = before.join(after, _null_safe_on(before, after, keys + ["_chunk"]), "left").select(
            before["*"], *[c for k in border for c in (f"_{k}_part", f"_has_{k}")]
        )
    ws = Window.partitionBy(*keys).orderBy("_chunk")
    # Steps of this chunk and the following ones at the time this one begins with.
    same_time = Window.partitionBy(*keys, "_first_ts").orderBy(F.col("_chunk").desc())
    s = summary.withColumn("_at_first", F.sum("_first_grp").over(same_time.rowsBetween(Window.unboundedPreceding, 0)))
    goes_on = F.lead("_first_ts").over(ws).eqNullSafe(F.col("_last_ts")) & F.lead(F.lit(1)).over(ws).isNotNull()
    s = s.select(
        *keys,
        "_chunk",
        *[c for k in border for c in (f"_{k}_part", f"_has_{k}")],
        "_tot_row",
        "_first_grp",
        F.lag("_last").over(ws).alias("_prev_last"),
        F.lead("_first").over(ws).alias("_next_first"),
        F.coalesce(F.sum("_tot_row").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.when(goes_on, F.lead("_at_first").over(ws)).otherwise(F.lit(0)).alias("_extra"),
    )
    # An island that crosses chunk borders has one global number. Each chunk contributes the partial
    # sums of its border islands as entries, the island total is a window sum over entries of one
    # island, and one more entry per chunk keeps chunks without any.
    number = {
        "head": F.col("_offset"),
        "first": F.col("_offset") + F.col("_first_grp"),
        "tail": F.col("_offset") + F.col("_tot_row"),
        "tie": F.col("_offset") + F.col("_tot_row") + F.col("_extra"),
    }

    def entry(kind: str, g: Column, p: Column, on: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), g.cast("long").alias("g"), p.cast("double").alias("p"), on.alias("on"))

    listed = [entry(k, number[k], F.col(f"_{k}_part"), F.coalesce(F.col(f"_has_{k}"), F.lit(False))) for k in border]
    listed.append(entry("chunk", F.lit(None), F.lit(None), F.lit(True)))
    entries = s.select(
        *keys, "_chunk", "_prev_last", "_next_first", "_offset", "_extra", F.explode(F.array(*listed)).alias("_e")
    ).where(F.col("_e.on"))
    entries = entries.select(
        "*", F.sum("_e.p").over(Window.partitionBy(*keys, F.col("_e.g"))).alias("_island_total")
    )
    totals = [F.max(F.when(F.col("_e.kind") == k, F.col("_island_total"))).alias(f"_{k}_total") for k in border]
    return entries.groupBy(*keys, "_chunk").agg(
        F.first("_prev_last", ignorenulls=True).alias("_prev_last"),
        F.first("_next_first", ignorenulls=True).alias("_next_first"),
        F.first("_offset").alias("_offset"),
        F.first("_extra").alias("_extra"),
        *totals,
    )
