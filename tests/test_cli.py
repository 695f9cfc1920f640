"""Command line entry points."""

import subprocess
import sys

from conftest import ROOT, SF_SMALL


def _run(*args):
    return subprocess.run([sys.executable, "-m", "tripflow", *args], cwd=ROOT, capture_output=True,
                          text=True, timeout=600)


def test_list_shows_registered_queries():
    out = _run("list")
    assert out.returncode == 0 and "gold_daily_borough" in out.stdout.split()


def test_query_runs_one_registered_query():
    out = _run("query", "srv_trips_by_type", "--sf", SF_SMALL, "--show", "5")
    assert out.returncode == 0, out.stderr[-2000:]
    assert "yellow" in out.stdout and "trip_count" in out.stdout
