import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_WARM_DIR=SF, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="remoteness_corr,outlier_filter")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec["queries"]) == {"remoteness_corr", "outlier_filter"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=0.01)
