"""Points in time for test rows."""

from __future__ import annotations

from datetime import datetime, timedelta


def at(second: int) -> datetime:
    """A moment `second` seconds into 2024, UTC."""
    return datetime(2024, 1, 1) + timedelta(seconds=second)
