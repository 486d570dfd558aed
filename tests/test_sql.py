"""The SQL route: every SQL function equals its Column twin on all rows of
the projected test tables, and a parameterised report runs over a view."""

import pytest
from pyspark.sql import functions as F

from playtrail.functions import columns as C
from playtrail.functions.rules import R1, R2, R4
from playtrail.operators.attribution import build_attribution
from playtrail.plans.catalog import PARAMS
from playtrail.plans.sql import register_functions, register_views
from playtrail.sources.fixture import fixture_tables

from .conftest import SF_MID

PAGE = PARAMS["details_page"]

CLICK_PAIRS = {
    "click_device(device)": lambda: C.normalize_click_device("device"),
    "binge_type(binge_source)": lambda: C.first_segment("binge_source"),
    "binge_kind(binge_type(binge_source), click_details)": lambda: C.binge_kind(C.first_segment("binge_source"), "click_details"),
    "click_title(player_event, lower(click_details))": lambda: C.extract_click_title("player_event", F.lower("click_details"), PAGE),
    "click_title(player_event, click_details)": lambda: C.extract_click_title("player_event", "click_details", PAGE),
    "local_ts(hit_ts)": lambda: C.local_ts("hit_ts"),
    "local_date(hit_ts)": lambda: C.local_date("hit_ts"),
    "click_class_r4(lower(click_details), player_event, binge_type(binge_source))": lambda: R4.classify(
        F.lower("click_details"), F.col("player_event"), C.first_segment("binge_source")
    ),
    "click_class_r2(click_details, player_event, binge_type(binge_source))": lambda: R2.classify(
        F.col("click_details"), F.col("player_event"), C.first_segment("binge_source")
    ),
    "click_class_r1(click_details, player_event, CAST(NULL AS STRING))": lambda: R1.classify(
        F.col("click_details"), F.col("player_event"), F.lit(None).cast("string")
    ),
}
VIDEO_PAIRS = {
    "normalize_title(display_name)": lambda: C.normalize_title("display_name"),
    "video_device(device)": lambda: C.normalize_video_device("device"),
    "is_linear_channel(display_name)": lambda: C.is_linear_channel("display_name"),
    "video_title(display_name, program)": lambda: C.video_title("display_name", "program"),
    "video_action(display_name)": lambda: C.video_action("display_name"),
}


@pytest.fixture(scope="module")
def tables(spark):
    register_functions(spark, details_page=PAGE)
    return fixture_tables(spark, SF_MID)


@pytest.mark.parametrize("expr", sorted(CLICK_PAIRS) + sorted(VIDEO_PAIRS))
def test_sql_function_equals_column_function(spark, tables, expr):
    clicks, videos = tables
    df, make = (clicks, CLICK_PAIRS[expr]) if expr in CLICK_PAIRS else (videos, VIDEO_PAIRS[expr])
    column = make()
    pairs = df.select(F.expr(expr).alias("sql"), column.alias("col"))
    assert pairs.where(~F.col("sql").eqNullSafe(F.col("col"))).count() == 0
    assert pairs.count() > 0


def test_parameterised_report_over_a_view(spark, tables):
    clicks, videos = tables
    built = build_attribution(
        clicks, videos, R4.with_details_page(PAGE),
        from_date=PARAMS["from_date"], to_date=PARAMS["to_date"], map_date=PARAMS["map_date"],
    )
    register_views(spark, attribution=built)
    try:
        rows = spark.sql(
            "SELECT start_type, count(*) AS n FROM attribution WHERE event_date BETWEEN :a AND :b GROUP BY 1",
            args={"a": PARAMS["from_date"], "b": PARAMS["to_date"]},
        ).collect()
    finally:
        spark.catalog.dropTempView("attribution")
    assert {r.start_type: r.n for r in rows} == {"Manual-Selection": 2908, "Clicked-Up-Next": 128, "Auto-Play": 72}
