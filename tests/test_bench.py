import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
def test_bench_ends_with_one_json_line(tmp_path):
    env = os.environ | {"BENCH_SF_DIR": SF, "BENCH_CPUS": "2", "BENCH_RUNS": "1", "BENCH_QUERIES": "pii_mask", "BENCH_APPLICANTS": "3000", "TMPDIR": str(tmp_path)}
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, str(root / "bench.py")], env=env, cwd=root, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    found = json.loads(done.stdout.strip().splitlines()[-1])
    assert found["unit"] == "sec" and {"pii_mask", "publish_silver_instalments", "publish_dim_applicant"} <= found["queries"].keys()
    assert all(value > 0 for value in found["rows_per_second"].values())
