"""The command line runs the three steps on reference-style snapshot files."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAMPLE = ["4b1c2d", "XYZ42   ", "Norway", 1772138460, 1772138461, 77.125, 21.5, 9144.0,
          False, 201.5, 145.25, 0, None, 9450.5, "2107", False, 0]


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "skyfold", "--master", "local[2]", *args],
                         cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_cli_steps(tmp_path):
    day_dir = tmp_path / "raw" / "ingest_date=2026-02-27"
    day_dir.mkdir(parents=True)
    other = list(SAMPLE)
    other[0], other[1] = "80a1b2", "AIC101"
    for i, states in enumerate([[SAMPLE], [SAMPLE, other]]):
        (day_dir / f"flights_{i}.json").write_text(json.dumps({"time": 1772138472 + i * 120, "states": states},
                                                              indent=2))
    proc, hist, marts = (str(tmp_path / p) for p in ("processed", "history", "marts"))
    res = _run("process", "--landing", str(tmp_path / "raw"), "--processed", proc,
               "--day", "2026-02-27", "--multi-line", "--as-of", "2026-02-27T12:00:00")
    assert res["rows_written"] == 3 and res["documents"] == 2
    assert res["vectors"] == 3 and res["rows_lost"] == 0
    assert res["report"]["row_count"][0]["row_count"] == 3
    assert _run("load", "--processed", proc, "--history", hist, "--day", "2026-02-27")["created"] is True
    again = _run("load", "--processed", proc, "--history", hist, "--day", "2026-02-27", "--count-total")
    assert again["created"] is False and again["total_rows"] == 3
    written = _run("marts", "--history", hist, "--marts", marts)
    assert written == {"fct_flights": 3, "dim_countries": 1, "dim_flight_phases": 1, "agg_flights_daily": 1}
    # retention: every processed day older than 90 days before the as-of date goes
    removed = _run("expire", "--table", proc, "--column", "ingest_date", "--days", "90", "--as-of", "2026-06-30")
    assert removed == {"removed": ["ingest_date=2026-02-27"]}
    kept = _run("expire", "--table", proc, "--column", "ingest_date", "--days", "90", "--as-of", "2026-06-30")
    assert kept == {"removed": []}
