"""The driver contract: bench.py prints one JSON line; the entry module loads from anywhere."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="check_not_null,ri_clean")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"check_not_null", "ri_clean"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6


def test_entry_module_loads_from_another_directory(tmp_path):
    code = ("import importlib.util;"
            f"s = importlib.util.spec_from_file_location('e', {os.path.join(REPO, '__spark_entry__.py')!r});"
            "m = importlib.util.module_from_spec(s); s.loader.exec_module(m);"
            "print(len(m.queries()), len(m.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=300)
    assert out.returncode == 0, out.stderr
    queries, oracles = map(int, out.stdout.split())
    assert queries >= oracles >= 40  # optional parts add queries, some without SQL
