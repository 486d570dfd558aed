"""SQL route: the domain functions as SQL functions, and the tables as views.

Users of the original write SQL. ``register_functions`` defines the column
functions of ``playtrail.functions`` as temporary SQL-language functions
(``CREATE TEMPORARY FUNCTION ... RETURN expr``); Catalyst inlines their
bodies into the calling plan, so they run inside whole-stage codegen like
any built-in expression (no Python). ``register_views`` exposes inputs and
results as temporary views, and parameterised queries take their dates
through ``spark.sql(query, args={...})``:

    register_functions(spark)
    register_views(spark, attribution=build_attribution(...))
    spark.sql("SELECT start_type, count(*) FROM attribution "
              "WHERE event_date BETWEEN :a AND :b GROUP BY 1", args={"a": d1, "b": d2})

``tests/test_sql.py`` checks every SQL function against its Column twin on
all rows of the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import columns as C
from ..functions.rules import R4


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(arms: list[tuple[str, str]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in arms) + f" ELSE {default} END"


def _extract(d: str, pattern: str) -> str:
    return f"CASE WHEN {d} RLIKE {_q(pattern)} THEN regexp_extract({d}, {_q(pattern)}, 1) END"


def function_bodies(details_page: str = R4.details_page, tz: str = C.NEW_YORK) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, return type, SQL body)."""
    norm = f"regexp_replace(lower(s), {_q(C.TITLE_PUNCTUATION)}, '')"
    names = ", ".join(_q(n) for n in C.LINEAR_CHANNEL_NAMES)
    signs = " OR ".join(f"dn RLIKE {_q(sign)}" for sign in C.LINEAR_CALL_SIGNS)
    title_arms = [
        (f"p LIKE '%:{section}:%' AND d IS NOT NULL", f"replace(p, {_q(details_page + section + ':')}, '')")
        for section in C.DETAIL_SECTIONS
    ]
    title_arms += [
        ("p LIKE '%:details:%' AND d IS NOT NULL", f"replace(p, {_q(details_page)}, '')"),
        ("d LIKE '%auto-play'", _extract("d", C.CUE_UP_TITLE)),
        ("d LIKE '%cue%up%click'", _extract("d", C.CUE_UP_TITLE)),
        ("d LIKE 'rail%click'", _extract("d", C.RAIL_TITLE)),
    ]
    auto, cun, man = _q(C.AUTO_PLAY), _q(C.CLICKED_UP_NEXT), _q(C.MANUAL)
    classes = {
        "r4": [
            ("d LIKE '%series%cue%up%auto%play%'", auto),
            ("lower(bt) LIKE '%sle%binge%'", auto),
            ("d LIKE '%programme%cue%up%auto%play%'", auto),
            ("d LIKE '%series%cue%up%click%'", cun),
            ("d LIKE '%programme%cue%up%click%'", cun),
            ("p LIKE '%details:%' AND d IS NOT NULL", man),
            ("d LIKE '%deeplink%'", man),
            ("d LIKE '%rail%click%'", man),
        ],
        "r2": [
            ("d LIKE '%Series-cue-up%auto-play'", auto),
            ("d LIKE '%Programme-cue-up%auto-play'", auto),
            ("d LIKE '%cue%up%click'", cun),
            ("d LIKE '%dismiss'", _q(C.DISMISS)),
            ("p LIKE '%details:%' AND d IS NOT NULL", man),
            ("d LIKE '%deeplink%'", man),
            ("d LIKE 'rail%click'", man),
        ],
        "r1": [
            ("d LIKE '%auto-play'", auto),
            ("d LIKE '%cue%up%click'", cun),
            ("d LIKE '%dismiss'", _q(C.DISMISS)),
            ("p LIKE '%details:%' AND d IS NOT NULL", man),
            ("d LIKE '%deeplink%'", man),
            ("d LIKE 'rail%click'", man),
        ],
    }
    bodies = {
        "normalize_title": ("s STRING", "STRING", norm),
        "click_device": (
            "device STRING",
            "STRING",
            _case([("lower(device) LIKE '%xbox%'", "'xbox'"), ("lower(device) = 'ps4'", "'playstation'")], "lower(device)"),
        ),
        "video_device": (
            "device STRING",
            "STRING",
            _case(
                [("lower(device) LIKE '%xfinity%'", "'xfinity'"), ("lower(device) LIKE '%google%tv%'", "'android tv'")],
                "lower(device)",
            ),
        ),
        "binge_type": ("s STRING", "STRING", "split_part(s, '|', 1)"),
        "binge_kind": (
            "bt STRING, d STRING",
            "STRING",
            _case(
                [
                    ("lower(bt) LIKE '%sle%binge%'", "'SLE'"),
                    ("lower(d) LIKE '%series%cue%up%' OR lower(d) LIKE '%programme%cue%up%'", "'Cue-Up'"),
                ]
            ),
        ),
        "click_title": ("p STRING, d STRING", "STRING", _case(title_arms)),
        "is_linear_channel": (
            "dn STRING",
            "BOOLEAN",
            f"length(dn) <= 4 OR lower(dn) LIKE '%tv' OR lower(dn) LIKE '%)' OR lower(dn) LIKE '%-dt' "
            f"OR lower(dn) LIKE '%premium' OR lower(dn) IN ({names}) OR {signs}",
        ),
        "video_title": (
            "dn STRING, program STRING",
            "STRING",
            "CASE WHEN lower(dn) = 'n/a' THEN lower(program) ELSE lower(dn) END",
        ),
        "video_action": (
            "dn STRING",
            "STRING",
            f"CASE WHEN lower(dn) LIKE '%trailer%' THEN {man} ELSE {_q(C.VIDEO_END)} END",
        ),
        "local_ts": ("ts TIMESTAMP_NTZ", "TIMESTAMP_NTZ", f"convert_timezone('UTC', {_q(tz)}, ts)"),
        "local_date": ("ts TIMESTAMP_NTZ", "DATE", f"to_date(convert_timezone('UTC', {_q(tz)}, ts))"),
    }
    for name, arms in classes.items():
        bodies[f"click_class_{name}"] = ("d STRING, p STRING, bt STRING", "STRING", _case(arms))
    return bodies


def register_functions(spark: SparkSession, details_page: str = R4.details_page, tz: str = C.NEW_YORK) -> list[str]:
    """Define the domain functions as temporary SQL functions; returns their names."""
    for name, (params, returns, body) in function_bodies(details_page, tz).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return sorted(function_bodies(details_page, tz))


def register_views(spark: SparkSession, **tables: DataFrame) -> list[str]:
    """Expose DataFrames (``clickstream=...``, ``attribution=...``) as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
