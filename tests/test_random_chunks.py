"""Randomised plain-versus-chunked comparison on inputs with NULL devices,
NULL seconds, NULL click times, several devices per account and many equal
timestamps. The plain plan is the one checked against the oracle; the
chunked plan must give the same rows for every rule set."""

import datetime as dt
import random
from dataclasses import replace

import pytest

from playtrail.functions.rules import R1, R2, R3, R4
from playtrail.operators.attribution import build_attribution
from playtrail.sources.readers import CLICKSTREAM_COLUMNS, VIDEO_LOG_COLUMNS

DAYS = [dt.date(2024, 3, 4), dt.date(2024, 3, 5)]
UTC = dt.timedelta(hours=5)
TITLES = ["a", "b", "c", "a trailer"]
DEVICES = ["Roku", "Xbox One", None]


def _inputs(seed: int):
    rng = random.Random(seed)
    clicks, videos = [], []
    vid = 0
    for acct in (f"u{seed}-{i}" for i in range(3)):
        for day in DAYS:
            for _ in range(rng.randint(5, 40)):
                ts = dt.datetime.combine(day, dt.time(rng.randint(8, 11), rng.choice([0, 0, 15, 30, 45])))
                dev = rng.choice(DEVICES)
                title = rng.choice(TITLES)
                if rng.random() < 0.6:
                    vid += 1
                    seconds = None if rng.random() < 0.15 else float(rng.choice([5, 20, 40, 300, 1200]))
                    display = "N/A" if rng.random() < 0.05 else title
                    videos.append((acct, day, ts, display, title, f"{title} ep", "N/A", dev, str(vid), seconds, 1.0, False))
                else:
                    kind = rng.choice(["auto", "next", "rail", "deeplink", "details"])
                    details = {
                        "auto": f"Series-Cue-Up||{title}|auto-play",
                        "next": f"Programme-Cue-Up||{title}|click",
                        "rail": f"Rail|{title}|click",
                        "deeplink": "deeplink|x",
                        "details": "details|play|click",
                    }[kind]
                    player = f"app:details:episodes:{title}" if kind in ("details", "deeplink") else "player"
                    hit = ts + UTC
                    revised = None if rng.random() < 0.1 else hit
                    clicks.append((acct, day, revised, hit, player, details, None, dev, None))
    return clicks, videos


@pytest.fixture(scope="module")
def inputs(spark):
    clicks, videos = [], []
    for seed in (1, 2, 3):
        c, v = _inputs(seed)
        clicks += c
        videos += v
    cs = spark.createDataFrame(clicks, ", ".join(f"{k} {t}" for k, t in CLICKSTREAM_COLUMNS.items()))
    vs = spark.createDataFrame(videos, ", ".join(f"{k} {t}" for k, t in VIDEO_LOG_COLUMNS.items()))
    return cs, vs


@pytest.mark.parametrize("rules", [R1, R2, R3, R4], ids=["R1", "R2", "R3", "R4"])
def test_chunked_plan_equals_plain_plan(spark, inputs, rules):
    clicks, videos = inputs
    r = replace(rules, positive_only=False)
    kw = dict(from_date=DAYS[0], to_date=DAYS[-1], map_date=DAYS[0], min_accounts=1, all_columns=True)
    cols = [c for c in r.output_columns if c not in ("island",)] + ["island", "prev_title", "next_title"]

    def rows(hot):
        out = build_attribution(clicks, videos, r, hot_key_rows=hot, **kw).select(*cols).collect()
        return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in row)) for row in out)

    plain = rows(None)
    assert len(plain) > 100
    assert rows(3) == plain
    assert rows(11) == plain
