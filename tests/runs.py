"""What several test modules use: the small tables, and a run of a given day."""

from __future__ import annotations

from datetime import datetime, timezone

from quayside.operators.conform import Run

SF = "/root/testdata/sf0.001"


def run_on(day: int, batch: str | None = None) -> Run:
    return Run("test", batch or f"batch-{day}", datetime(2024, 1, day, 12, tzinfo=timezone.utc))
