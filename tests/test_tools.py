"""The spark-submit runner writes answers as parquet and reports failures per answer."""

import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq

ROOT = Path(__file__).resolve().parents[1]


def test_run_all_writes_parquet(tmp_path):
    out = tmp_path / "answers"
    proc = subprocess.run(
        [sys.executable, str(ROOT / "tools" / "run_all.py"), "/root/testdata/sf0.001", str(out), "D01_", "C10_"],
        capture_output=True, text=True, timeout=600,
    )
    assert proc.returncode == 0, proc.stdout + proc.stderr
    assert pq.read_table(out / "D01_total_spend").num_rows > 0
    assert pq.read_table(out / "C10_toppings_text").num_rows == 5


def test_run_all_reports_a_failing_answer(tmp_path):
    proc = subprocess.run(
        [sys.executable, str(ROOT / "tools" / "run_all.py"), str(tmp_path / "missing"), str(tmp_path / "o"), "C10_"],
        capture_output=True, text=True, timeout=600,
    )
    assert proc.returncode == 1 and "FAILED C10_toppings_text" in proc.stdout
