"""Randomised differential test: generated ``events`` with many equal
timestamps (minute resolution, few accounts), every attribution rule set on
the plain and the chunked plan, against the DuckDB oracle."""

import datetime as dt
import tempfile
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E

NAMES = [
    "attribution_r1",
    "attribution_r2",
    "attribution_r3",
    "attribution_r4",
    "attribution_r1_hot_keys",
    "attribution_r4_hot_keys",
    "attribution_r4_shared_account",
    "funnel",
]


def _events(seed: int, n: int = 3000) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    start = np.datetime64("2024-01-26T00:00")
    minutes = rng.integers(0, 5 * 24 * 60, n)  # 2024-01-26 .. 2024-01-30, whole minutes
    events = pd.DataFrame(
        {
            "event_id": np.arange(n, dtype="int64"),
            "ts": (start + minutes.astype("timedelta64[m]")).astype("datetime64[us]"),
            "user_id": rng.integers(0, 40, n).astype("int64"),
            "event_type": rng.choice(["click", "signup", "error", "view", "purchase"], n),
            "value": np.round(rng.uniform(0.01, 500, n), 2),
            "props": [f'{{"k": {k}}}' for k in rng.integers(0, 100, n)],
        }
    )
    # Rows that differ from another one in their seconds only, and whole repeats.
    twins = events.iloc[:400].assign(value=lambda e: np.round(e["value"] / 2 + 1, 2))
    return pd.concat([events, twins, events.iloc[400:500]], ignore_index=True)


@pytest.fixture(scope="module")
def generated():
    folder = tempfile.mkdtemp(prefix="playtrail-random-", dir="/tmp")
    _events(7).to_parquet(f"{folder}/events.parquet", index=False)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    return folder, con


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_random_events_match_oracle(spark, generated, name):
    folder, con = generated
    df = E.queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) > 0
    assert _bag(rows, df.columns) == _bag(res.fetchall(), res.columns)


def test_generated_data_has_ties(generated):
    _, con = generated
    ties = con.sql(
        "SELECT count(*) FROM (SELECT floor(user_id / 5) AS a, ts FROM events GROUP BY 1, 2 HAVING count(*) > 1)"
    ).fetchall()[0][0]
    assert ties > 50
    assert dt.date(2024, 1, 30) in {r[0] for r in con.sql("SELECT DISTINCT CAST(ts AS DATE) FROM events").fetchall()}
