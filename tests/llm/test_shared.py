"""Python workers find the package wherever the driver was started."""

import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[2])
CODE = f"""
import sys
sys.path.insert(0, {REPO!r})
from tavola.session import get_spark
from tavola.llm import personal_data
spark = get_spark("elsewhere", master="local[1]")
df = spark.createDataFrame([(1, "to a.b@c.org now")], "doc_id long, text string")
print("SPANS", personal_data.find(df).first().spans)
"""


def test_workers_import_the_package_from_elsewhere(tmp_path):
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "SPANS email:3:12" in out.stdout, out.stderr[-2000:]
