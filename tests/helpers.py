"""Landing files and table contents for the tests."""

from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

FIELDS = [
    "message_id",
    "crane_id",
    "timestamp",
    "hoist_load_kg",
    "vibration_mm_s",
    "crane_model",
    "operational_region",
]


def message(message_id, crane="A", when="2030-05-01T08:00:00Z", load=100.0, vibration=1.0, model="M1", region="R1"):
    return dict(zip(FIELDS, [message_id, crane, when, load, vibration, model, region]))


# Three good readings, one overload, one negative vibration whose crane is seen
# in no other reading.
FIVE = [
    message("m1", "A", "2030-05-01T08:00:00Z", 25000.5, 12.4),
    message("m2", "A", "2030-05-01T08:05:00Z", 45000.0, 45.1),
    message("m3", "B", "2030-05-01T08:00:00Z", 10500.0, 8.2, "M2", "R2"),
    message("m4", "A", "2030-05-01T08:10:00Z", 85000.0, 95.0),
    message("m5", "C", "2030-05-01T08:15:00Z", 5000.0, -5.0, "M2", "R3"),
]


def land(folder, rows, raw_lines=(), name="batch.json"):
    """Write one landing file; ``raw_lines`` go in as they are."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(r) for r in rows] + list(raw_lines)
    (folder / name).write_text("".join(line + "\n" for line in lines))
    return str(folder)


def bag(df, *columns):
    """Rows as a multiset."""
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())
