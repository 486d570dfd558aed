"""The command line parses its jobs (``--help`` starts no Spark session)."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_cli_lists_the_jobs():
    out = subprocess.run(
        [sys.executable, "-m", "playtrail", "--help"], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert out.returncode == 0
    for job in ("attribution", "reload", "delete-day", "prune", "monitor", "funnel"):
        assert job in out.stdout


def test_cli_rejects_a_missing_argument():
    out = subprocess.run(
        [sys.executable, "-m", "playtrail", "attribution", "--clicks", "x"],
        cwd=ROOT, capture_output=True, text=True, timeout=120,
    )
    assert out.returncode != 0 and "required" in out.stderr
