"""Pure ``Column -> Column`` building blocks of the attribution logic.

Every function here is a composition of built-in ``pyspark.sql.functions``
so it stays inside whole-stage codegen; none of them needs a UDF.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Sequence

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the values the original scripts use, or the
# labels and titles come out different.
# ---------------------------------------------------------------------------

# Characters removed from titles before they are compared.
TITLE_PUNCTUATION = "[:,.&'!]"

# Linear channels by name (the suffix rule for "-dt" holds for the first two as well).
LINEAR_CHANNEL_NAMES = ("ktvh-dt", "ksnv-dt", "kgwn2")
# Call-sign shapes of linear channels, matched against the raw display name.
LINEAR_CALL_SIGNS = ("(W)[a-zA-Z0-9]+-[a-zA-Z0-9]", "(K)[a-zA-Z0-9]+-[a-zA-Z0-9]")

# Episode titles that are known to be wrong in the video log; they never
# feed the episode -> series map.
STOP_EPISODES = (
    "yellowstone",
    "quantum leap",
    "dateline nbc",
    "pft live",
    "americas got talent all stars",
)
# Title excluded because its series and episode names are the same.
SAME_NAME_TITLE = "poker face"

# Sub-pages of a details page whose suffix is the title.
DETAIL_SECTIONS = ("episodes", "upsell", "more-like-this", "extras")
# Title sits between "||" and the last "|" of a cue-up click.
CUE_UP_TITLE = r"[|][|](.*)[|]"
# Title of a rail click: "|<title>|click".
RAIL_TITLE = r"[|]([a-zA-Z0-9\s.:-]+)[|]click"

# Start labels.
AUTO_PLAY = "Auto-Play"
CLICKED_UP_NEXT = "Clicked-Up-Next"
MANUAL = "Manual-Selection"
UNATTRIBUTED = "Unattributed"
DISMISS = "Dismiss"
VIDEO_END = "Vdo_End"

NEW_YORK = "America/New_York"

# ---------------------------------------------------------------------------


def reusable(fn):
    """Build a Column expression once per Spark context and reuse it.

    Column expressions are unresolved, immutable trees, so one instance can
    appear in many plans; building the large ones (rule ladders, title
    extraction) costs hundreds of calls into the JVM each time. Only calls
    whose arguments are all hashable (names, rule sets) are cached.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        sc = SparkContext._active_spark_context
        try:
            key = (sc.applicationId if sc is not None else None, args, tuple(sorted(kwargs.items())))
            hash(key)
        except TypeError:
            return fn(*args, **kwargs)
        if key not in cache:
            cache[key] = fn(*args, **kwargs)
        return cache[key]

    return wrapper


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Searched CASE: the first true condition wins, NULL conditions do not."""
    if not rules:
        return F.lit(default) if not isinstance(default, Column) else default
    cond, value = rules[0]
    out = F.when(cond, value)
    for cond, value in rules[1:]:
        out = out.when(cond, value)
    if default is None:
        return out
    return out.otherwise(default)


def in_range(c: str | Column, lo, hi) -> Column:
    """Inclusive range; on a partition column this prunes partitions."""
    return col(c).between(F.lit(lo), F.lit(hi))


@reusable
def normalize_title(c: str | Column) -> Column:
    """Lower-case and drop ``: , . & ' !`` so titles compare equal."""
    return F.regexp_replace(F.lower(col(c)), TITLE_PUNCTUATION, "")


@reusable
def normalize_click_device(device: str | Column) -> Column:
    """Device names of the clickstream.

    The original also has a chromecast arm that compares a lower-cased value
    with a mixed-case literal; it can never be true and is left out.
    """
    d = F.lower(col(device))
    return first_match([(d.like("%xbox%"), "xbox"), (d == "ps4", "playstation")], d)


@reusable
def normalize_video_device(device: str | Column) -> Column:
    """D3: device names of the video log (Xfinity and Google TV families)."""
    d = F.lower(col(device))
    return first_match([(d.like("%xfinity%"), "xfinity"), (d.like("%google%tv%"), "android tv")], d)


def first_segment(c: str | Column, sep: str = "|") -> Column:
    """First ``sep``-separated segment; NULL stays NULL.

    ``split_part`` takes a literal delimiter, unlike ``split`` which takes a
    regular expression (where ``|`` would be an empty alternation).
    """
    return F.split_part(col(c), F.lit(sep), F.lit(1))


def binge_kind(binge_type: str | Column, details: str | Column) -> Column:
    """The two documented kinds of binge start, ``SLE`` and ``Cue-Up``."""
    bt = F.lower(col(binge_type))
    d = F.lower(col(details))
    return first_match(
        [
            (bt.like("%sle%binge%"), "SLE"),
            (d.like("%series%cue%up%") | d.like("%programme%cue%up%"), "Cue-Up"),
        ]
    )


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """REGEXP_EXTRACT that is NULL when nothing matches (Spark returns "")."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


@reusable
def extract_click_title(player_event: str | Column, details: str | Column, details_page: str) -> Column:
    """Title named by a click.

    ``details_page`` is the page-name prefix of the app's details pages
    (for example ``"<app>:details:"``); the title follows it, or follows one
    of its sections. Otherwise the title is read from the click details.
    """
    p = col(player_event)
    d = col(details)
    rules = []
    for section in DETAIL_SECTIONS:
        rules.append(
            (p.like(f"%:{section}:%") & d.isNotNull(), F.regexp_replace(p, re.escape(f"{details_page}{section}:"), ""))
        )
    rules.append((p.like("%:details:%") & d.isNotNull(), F.regexp_replace(p, re.escape(details_page), "")))
    rules.append((d.like("%auto-play"), extract_or_null(d, CUE_UP_TITLE)))
    rules.append((d.like("%cue%up%click"), extract_or_null(d, CUE_UP_TITLE)))
    rules.append((d.like("rail%click"), extract_or_null(d, RAIL_TITLE)))
    return first_match(rules)


@reusable
def is_linear_channel(display_name: str | Column, names: Iterable[str] = LINEAR_CHANNEL_NAMES) -> Column:
    """Display names that are linear channels rather than series."""
    dn = col(display_name)
    low = F.lower(dn)
    cond = (
        (F.length(dn) <= 4)
        | low.like("%tv")
        | low.like("%)")
        | low.like("%-dt")
        | low.like("%premium")
        | low.isin(*names)
    )
    for sign in LINEAR_CALL_SIGNS:
        cond = cond | dn.rlike(sign)
    return cond


@reusable
def video_title(display_name: str | Column, program: str | Column) -> Column:
    """Lower-cased display name, or the program when it is ``n/a``."""
    dn = F.lower(col(display_name))
    return F.when(dn == "n/a", F.lower(col(program))).otherwise(dn)


@reusable
def video_action(display_name: str | Column) -> Column:
    """Trailers start manually; everything else is a plain video end."""
    return F.when(F.lower(col(display_name)).like("%trailer%"), MANUAL).otherwise(VIDEO_END)


def local_ts(utc_ts: str | Column, tz: str = NEW_YORK) -> Column:
    """Wall-clock time in ``tz`` of a zone-less UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(utc_ts))


def local_date(utc_ts: str | Column, tz: str = NEW_YORK) -> Column:
    """Calendar day in ``tz`` of a zone-less UTC timestamp."""
    return F.to_date(local_ts(utc_ts, tz))


def local_yesterday(tz: str = NEW_YORK) -> Column:
    """yesterday's date in ``tz`` (the daily job's default day)."""
    # Without a source zone, the session zone is used: right for any session.
    return F.date_sub(F.to_date(F.convert_timezone(None, F.lit(tz), F.current_timestamp())), 1)


def shift_seconds(ts: str | Column, seconds: int) -> Column:
    """Move a timestamp by a whole number of seconds."""
    if seconds == 0:
        return col(ts)
    return F.timestamp_add("SECOND", F.lit(seconds), col(ts))


def blank_or_null(c: str | Column) -> Column:
    return col(c).isNull() | (col(c) == "")
