"""Command line: generate a raw zone, then run the batch on it (separate JVMs)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    out = subprocess.run(
        [sys.executable, "-m", "salesmart", *args],
        cwd=ROOT, capture_output=True, text=True, timeout=600,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"},
    )
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_generate_then_batch(scratch):
    run("generate", "--data-dir", scratch, "--rows", "1000")
    summary = json.loads(run("batch", "--data-dir", scratch).strip().splitlines()[-1])
    assert summary["order_count"] == 1000
    def section(name):
        folder = os.path.join(scratch, "document", name)
        for part in sorted(f for f in os.listdir(folder) if f.startswith("part-")):
            with open(os.path.join(folder, part), encoding="utf-8") as f:
                yield from map(json.loads, f)

    assert sum(r["revenue"] for r in section("by_category")) == 1_850_000
    assert len(list(section("by_product"))) == 100 and next(section("by_hour"))["order_hour"] == 10
