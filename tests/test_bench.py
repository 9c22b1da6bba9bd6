"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from conftest import SF0001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"),
                          "top10_questions", "dedup_user_counts"],
                         env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec"
    assert set(d["queries"]) == {"top10_questions", "dedup_user_counts"}
    assert d["value"] > 0 and d["sf"] == 0.001 and "errors" not in d
