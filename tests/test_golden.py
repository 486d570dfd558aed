"""Golden timelines (FIXTURES.md section 3): labels and final watch time
before R4's positive filter, for R4 and R3, on the plain and the chunked
(hot-key) plan."""

import datetime as dt
from dataclasses import replace

import pytest

from playtrail.functions.rules import R3, R4
from playtrail.operators.attribution import build_attribution

from .timelines import DAY, build

TIMELINES = {
    "G1": [("v", "a", 100)],
    "G2": [("v", "a", 100), ("auto", "b"), ("v", "b", 200)],
    "G3": [("v", "a", 100), ("auto", "b"), ("v", "b", 200), ("v", "b", 300)],
    "G4": [("v", "a", 100), ("v", "b", 200)],
    "G4b": [("v", "a", 100), ("v", "b", 200), ("v", "b", 300)],
    "G4c": [("v", "a", 100), ("v", "b", 20)],
    "G5": [("v", "a", 100), ("auto", "c"), ("v", "b", 200)],
    "G6": [("v", "a trailer", 60), ("auto", "b"), ("v", "b", 200)],
    "G7": [("v", "a", 100), ("rail", "b"), ("v", "a", 50)],
    "G8": [("v", "a", 100), ("rail", "a"), ("v", "a", 50)],
    "G9": [("v", "a", 100), ("rail", "x"), ("rail", "a"), ("v", "a", 50)],
    "G10": [("v", "a", 100), ("next", "b"), ("v", "b", 200)],
    "G11": [("v", "a", 100), ("next", "a"), ("v", "a", 200)],
    "G12": [("v", "a", 100), ("v", "b", None), ("v", "b", 40)],
    "G13": [("v", "a", 100), ("v", "b", None), ("v", "c", 40)],
    "X1": [("v", "b", 50, "d1"), ("v", "c", 10, "d2"), ("v", "c", 40, "d1")],
    "X2": [("v", "b", None, "d1"), ("v", "c", 10, "d2"), ("v", "c", 40, "d1")],
}

# Expected rows as (step index, label, final watch time); every row of the
# timeline is listed.
M, A, N, U = "Manual-Selection", "Auto-Play", "Clicked-Up-Next", "Unattributed"
R4_EXPECTED = {
    "G1": [(0, M, 100)],
    "G2": [(0, M, 100), (1, M, 0), (2, A, 200)],
    "G3": [(0, M, 100), (1, M, 0), (2, A, 500), (3, M, 0)],
    "G4": [(0, M, 100), (1, M, 200)],
    "G4b": [(0, M, 100), (1, M, 500), (2, M, 0)],
    "G4c": [(0, M, 100), (1, M, 20)],
    "G5": [(0, M, 100), (1, M, 0), (2, M, 200)],
    "G6": [(0, M, 60), (1, M, 0), (2, M, 200)],
    "G7": [(0, M, 100), (1, M, 0), (2, M, 50)],
    "G8": [(0, M, 100), (1, M, 50), (2, M, 0)],
    "G9": [(0, M, 100), (1, M, 0), (2, M, 50), (3, M, 0)],
    "G10": [(0, M, 100), (1, M, 0), (2, N, 200)],
    "G11": [(0, M, 100), (1, M, 200), (2, M, 0)],
    "G12": [(0, M, 100), (1, M, 40), (2, M, 0)],
    "G13": [(0, M, 100), (1, M, 0), (2, M, 40)],
}
R3_CHANGES = {
    "G4": {1: (U, 200)},
    "G4b": {1: (A, 500)},
    "G5": {2: (A, 200)},
    "G11": {2: (N, 0)},
    "G13": {2: (U, 40)},
}
CROSS_DEVICE = {"X1": {(0, 90), (1, 10), (2, 40)}, "X2": {(0, 0), (1, 10), (2, 40)}}


def _run(spark, rules, hot_key_rows, start_time=dt.time(10, 0)):
    clicks, videos = build(spark, TIMELINES, start_time=start_time)
    df = build_attribution(
        clicks,
        videos,
        replace(rules, positive_only=False),
        from_date=DAY,
        to_date=DAY,
        map_date=DAY,
        hot_key_rows=hot_key_rows,
        all_columns=True,
    )
    rows = df.select("account_id", "event_ts", "video_id", "start_type", "final_watch_time").collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.account_id, r.event_ts, r.video_id)):
        out.setdefault(r.account_id, []).append((r.start_type, r.final_watch_time))
    return out


@pytest.fixture(scope="module")
def results(spark):
    return {
        (name, hot): _run(spark, rules, hot)
        for name, rules in (("R4", R4), ("R3", R3))
        for hot in (None, 1)
    }


@pytest.mark.parametrize("hot", [None, 1], ids=["plain", "chunked"])
@pytest.mark.parametrize("timeline", sorted(R4_EXPECTED))
def test_r4_golden(results, timeline, hot):
    got = results[("R4", hot)][timeline]
    expected = [(label, float(sec)) for _, label, sec in R4_EXPECTED[timeline]]
    assert got == expected


@pytest.mark.parametrize("hot", [None, 1], ids=["plain", "chunked"])
@pytest.mark.parametrize("timeline", sorted(R4_EXPECTED))
def test_r3_golden(results, timeline, hot):
    got = results[("R3", hot)][timeline]
    expected = [(label, float(sec)) for _, label, sec in R4_EXPECTED[timeline]]
    for i, (label, sec) in R3_CHANGES.get(timeline, {}).items():
        expected[i] = (label, float(sec))
    assert got == expected


@pytest.mark.parametrize("hot", [None, 1], ids=["plain", "chunked"])
@pytest.mark.parametrize("timeline", sorted(CROSS_DEVICE))
def test_cross_device_watch_time(results, timeline, hot):
    got = results[("R4", hot)][timeline]
    assert {(i, sec) for i, (_, sec) in enumerate(got)} == {(i, float(s)) for i, s in CROSS_DEVICE[timeline]}


def test_plain_and_chunked_agree_everywhere(results):
    for name in ("R4", "R3"):
        assert results[(name, None)] == results[(name, 1)]


def test_shifting_all_times_within_the_day_changes_nothing(spark, results):
    shifted = _run(spark, R4, None, start_time=dt.time(17, 35, 12))
    assert shifted == results[("R4", None)]
