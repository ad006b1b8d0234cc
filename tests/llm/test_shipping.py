"""Executors get the package from the driver, wherever that found it."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from rollkeeper.session import build_session
from rollkeeper.llm.simhash import with_fingerprint
spark = build_session("ship", "2")
frame = spark.createDataFrame([(1, "a b c d e"), (2, None)], "doc_id long, text string")
print("ROWS", sorted(r.fp == 0 for r in with_fingerprint(frame, ["doc_id"], "fp").collect()))
"""


def test_tasks_import_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS [False, True]" in done.stdout, done.stderr[-2000:]
