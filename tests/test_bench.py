"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    out = subprocess.run(
        [sys.executable, "bench.py"], cwd=ROOT, capture_output=True, text=True, timeout=900,
        env={**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4", "BENCH_DRIVER_MEMORY": "4g"},
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001 and result["metric"]
    assert result["value"] > 0 and all(v >= 0 for v in result["queries"].values()), result["queries"]
    assert "batch_full" in result["queries"] and "q_sales_by_product" in result["queries"]
