"""Settings of one inbox: window geometry, retention, drain identity."""

from __future__ import annotations

from dataclasses import dataclass

LATEST = "LATEST"
CONFIGURED = "CONFIGURED"


@dataclass(frozen=True)
class InboxConfig:
    """Validated inbox settings; every duration is in whole seconds.

    ``rows_per_file`` is the number of deliveries of one task of a drain or compaction,
    so the size at which a window spreads over several ordered part files. Beyond ``most_small_tasks``
    in a run of a drain, a task has at least ``rows_per_task``, so that tasks do not outgrow the work.
    ``storage_seconds`` is the span of one storage folder; choose it so that a
    folder holds at least some hundred megabytes. ``rebalance_writes`` spends one
    exchange per micro-batch on evenly sized files; without it every task writes a
    file per folder it meets. ``max_windows_per_run`` bounds one run of a drain, not
    the drain: runs follow each other until nothing sealed is left. ``late_output`` makes
    drains log the keys they emit, which the late output compares with.
    ``address_from_bytes`` is the size of stored files from which the last writes are found by
    key alone and payloads are taken by their place in a file instead of being exchanged,
    unless more than ``most_overwritten`` rows, which every task is sent, were overwritten.
    ``idle_seconds`` is how far a source partition may fall behind the stream's newest
    reception before it no longer holds back the stream clock; None lets it do so for ever.
    """

    window_seconds: int = 5
    allowed_lateness_seconds: int = 60
    storage_seconds: int = 3_600
    inbox_ttl_seconds: int = 86_400
    progress_ttl_seconds: int = 604_800
    drain_id: str = "primary"
    bootstrap: str = LATEST
    start_bucket: int = 0
    poll_interval_ms: int = 5_000
    max_windows_per_run: int = 17_280
    rows_per_file: int = 100_000
    rows_per_task: int = 100_000
    most_small_tasks: int = 200
    max_lag: int = 10_000
    rebalance_writes: bool = True
    window_warn_bytes: int = 100 * 1024 * 1024
    address_from_bytes: int = 256 * 1024 * 1024
    most_overwritten: int = 500_000
    late_output: bool = False
    idle_seconds: int | None = None

    def __post_init__(self) -> None:
        if self.window_seconds <= 0:
            raise ValueError("window_seconds must be > 0")
        if self.allowed_lateness_seconds < 0:
            raise ValueError("allowed_lateness_seconds must be >= 0")
        if self.bootstrap not in (LATEST, CONFIGURED):
            raise ValueError(f"bootstrap must be {LATEST} or {CONFIGURED}")
        if not self.drain_id or "/" in self.drain_id:
            raise ValueError("drain_id must be a non-empty path-safe name")
        if self.idle_seconds is not None and self.idle_seconds < 0:
            raise ValueError("idle_seconds must be >= 0")
        for name in (
            "storage_seconds",
            "inbox_ttl_seconds",
            "progress_ttl_seconds",
            "max_windows_per_run",
            "rows_per_file",
            "rows_per_task",
            "most_small_tasks",
        ):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be > 0")
