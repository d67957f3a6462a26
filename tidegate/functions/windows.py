"""Event-time window arithmetic as column expressions and plain scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.config import CONFIGURED, InboxConfig

def bucket_of_seconds(seconds: Column, window_seconds: int) -> Column:
    """Window start of an epoch second; truncates toward zero before 1970."""
    return seconds - seconds % F.lit(window_seconds)


def window_bucket(ts: Column, window_seconds: int) -> Column:
    return bucket_of_seconds(F.unix_seconds(ts), window_seconds)


def storage_bucket(bucket: Column, config: InboxConfig) -> Column:
    """Storage folder of a window: derived from the bucket, so it prunes for any window size."""
    return bucket_of_seconds(bucket, config.storage_seconds)


def seal_time(bucket: Column, config: InboxConfig) -> Column:
    return bucket + F.lit(config.window_seconds + config.allowed_lateness_seconds)


def is_sealed(bucket: Column, now_epoch: int | Column, config: InboxConfig) -> Column:
    """Sealed once ``now`` reaches bucket + window + lateness, boundary included."""
    now = now_epoch if isinstance(now_epoch, Column) else F.lit(now_epoch)
    return now >= seal_time(bucket, config)


def last_sealed_bucket(now_epoch: int, config: InboxConfig) -> int:
    """Highest window start already sealed at ``now_epoch`` (may be negative: none)."""
    horizon = now_epoch - config.window_seconds - config.allowed_lateness_seconds
    return horizon // config.window_seconds * config.window_seconds


def latest_cursor(now_epoch: int, config: InboxConfig) -> int:
    """Cursor that makes the newest sealed window the first one to drain; 0 if none is sealed."""
    newest = last_sealed_bucket(now_epoch, config)
    return max(0, newest - config.window_seconds)


def bootstrap_cursor(last_drained: int | None, now_epoch: int, config: InboxConfig) -> int:
    """Cursor of a run: resume from the ledger, else the configured start, else the latest window.

    A ledger that does not line up with the window size, or a start inside a
    window, would only ever meet empty windows: the first is an error, the
    second is moved to its window start.
    """
    w = config.window_seconds
    if last_drained is not None:
        if last_drained % w:
            raise ValueError(f"ledger bucket {last_drained} is not a multiple of window size {w}")
        return last_drained
    start = config.start_bucket // w * w
    if config.bootstrap == CONFIGURED and start > 0:
        return start - w
    return latest_cursor(now_epoch, config)
