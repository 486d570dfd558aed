"""On the wide projection every arm of the rules is met at sf0.01, so that the
``*_all_arms`` queries would notice a wrong one."""

import pytest
from pyspark.sql import functions as F

from playtrail.functions import columns as C
from playtrail.functions.rules import _CLASSIFIERS, R1, R2, R4
from playtrail.operators.analytics import return_viewers
from playtrail.operators.attribution import popular_titles
from playtrail.operators.clicks import build_series_map, classify_clicks, clean_clicks, series_counts
from playtrail.plans.catalog import PARAMS, QUERIES, _r4_table
from playtrail.sources.fixture import fixture_tables

from .conftest import SF_MID

PERIOD = PARAMS["from_date"], PARAMS["to_date"]


@pytest.fixture(scope="module")
def wide(spark):
    return fixture_tables(spark, SF_MID, wide=True)


@pytest.mark.parametrize("rules", [R1, R2, R4], ids=["R1", "R2", "R4"])
def test_every_classifier_arm_is_the_first_to_match(wide, rules):
    clicks = classify_clicks(clean_clicks(wide[0], rules, *PERIOD), rules)
    arms = _CLASSIFIERS[rules.classifier](F.col("click_details"), F.col("player_event"), F.col("binge_type"))
    first = C.first_match([(cond, F.lit(n)) for n, (cond, _) in enumerate(arms)])
    met = {r["arm"] for r in clicks.select(first.alias("arm")).distinct().collect()}
    assert set(range(len(arms))) <= met


def test_every_title_section_and_call_sign(wide):
    clicks, videos = wide
    for section in (*C.DETAIL_SECTIONS, "details"):
        assert clicks.where(F.col("player_event").like(f"%:{section}:%")).count() > 0
    names = videos.select("display_name", F.lower("display_name").alias("low"))
    for cond in ("length(low) <= 4", "low LIKE '%tv'", "low LIKE '%)'", "low LIKE '%-dt'", "low LIKE '%premium'",
                 "low = 'kgwn2'", *[f"display_name RLIKE '{s}'" for s in C.LINEAR_CALL_SIGNS]):
        assert names.where(cond).count() > 0, cond


def test_stop_titles_ties_and_nulls(wide):
    clicks, videos = wide
    day = videos.where(F.col("event_date") == F.lit(PARAMS["map_date"]).cast("date"))
    for title in ("yellowstone", "poker face"):
        assert day.where(F.lower("episode_title") == title).count() > 0
    r4, r1 = (build_series_map(videos, PARAMS["map_date"], r) for r in (R4, R1))
    assert series_counts(videos, PARAMS["map_date"], R1).where("episode = 'poker face'").count() > 0
    assert r4.where("episode IN ('yellowstone', 'poker face')").count() == 0
    assert r4.groupBy("episode").count().where("count > 1").count() > 0  # a tie
    assert r1.count() != r4.count()  # the kgwn2 name
    for table, column in ((clicks, "device"), (clicks, "event_date"), (videos, "device"), (videos, "display_name")):
        assert table.where(F.col(column).isNull()).count() > 0
    assert popular_titles(videos, *PERIOD, 1).where(F.col("title").isNull()).count() == 0


def test_title_pairs_have_returning_viewers(spark):
    attribution, _ = _r4_table(spark, SF_MID)
    assert return_viewers(attribution, *PARAMS["title_pairs"][1], *PERIOD).count() > 0
    assert QUERIES["funnel_returning"](spark, SF_MID).where("category LIKE 'Returned%' AND accounts > 0").count() == 1
