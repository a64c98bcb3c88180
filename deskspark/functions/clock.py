"""The run's time stamp: one UTC instant per run."""

from __future__ import annotations

from datetime import datetime, timezone


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stamp(run_ts: datetime) -> str:
    """`run_ts` as an SQL literal without zone, whatever the session zone is."""
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc).replace(tzinfo=None)
    return f"TIMESTAMP_NTZ '{run_ts.isoformat(sep=' ', timespec='microseconds')}'"
