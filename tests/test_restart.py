"""Three processes, one checkpoint, one target."""

import os
import subprocess
import sys

JOB = os.path.join(os.path.dirname(os.path.abspath(__file__)), "restart_job.py")


def test_three_processes_add_to_one_target(tmp_path):
    for drop in range(3):
        out = subprocess.run([sys.executable, JOB, str(tmp_path), str(drop)], capture_output=True, text=True, timeout=300)
        assert out.returncode == 0, out.stderr[-2000:]
        want = [(k, f"drop {k}") for k in range(drop + 1)] + [(100, f"drop {drop}")]
        assert f"ROWS {want}" in out.stdout
