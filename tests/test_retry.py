import json
import os
import subprocess
import sys


def test_counts_exact_when_tasks_are_retried():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    proc = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads(proc.stdout.strip().splitlines()[-1])
    # ids 0..3999: every third is NULL (1334 rows), the rest valid
    assert got == {"status": "succeeded", "total_count": 4000, "valid_count": 2666, "invalid_count": 1334,
                   "dlq_count": 1334, "target_rows": 2666}
