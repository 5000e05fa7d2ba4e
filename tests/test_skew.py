"""A key holding a third of all rows must not land in one task: measured from
Spark's event log (per-task shuffle records) in a separate session."""

import json
import os
import subprocess
import sys


def test_hot_entity_and_hot_source_are_not_concentrated():
    here = os.path.dirname(os.path.abspath(__file__))
    r = subprocess.run([sys.executable, os.path.join(here, "skew_probe.py")],
                       capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stderr[-3000:]
    out = json.loads(r.stdout.strip().splitlines()[-1])
    # results are whole: every hot mention counted, caps applied exactly
    assert out["hot_total"] == out["hot_rows"] - 1
    assert out["emitted_hot"] == 5 + 2
    assert out["kept_hot"] == 50_000          # hot ids below 150000: 0, 3, ..., 149997
    assert out["hot_day_mentions"] == 110_000 and out["hot_day_entities"] == 501
    # no task read anywhere near the hot key's share of the rows
    assert out["max_task_shuffle_records"] < out["hot_rows"] // 4, out
