"""One drainer per drain identity: a lease with an epoch that fences the ledger."""

from __future__ import annotations

import time
from dataclasses import dataclass

from tidegate.session import create_file, list_files, read_file, write_file
from tidegate.sources.store import InboxStore


class StaleLease(RuntimeError):
    """Another drainer has taken over; this one must stop."""


def _folder(store: InboxStore, drain_id: str) -> str:
    return f"{store.root}/lease/drain_id={drain_id}"


def _epochs(store: InboxStore, drain_id: str) -> list[int]:
    return [int(n) for n in list_files(store.spark, _folder(store, drain_id)) if n.isdigit()]


@dataclass(frozen=True)
class DrainLease:
    """The right to append to one ledger, until an epoch above it exists.

    An epoch is a file that only one drainer can create. The holder beats while it works; a drainer
    that finds the last beat older than ``seconds`` may create the next epoch. Clocks only
    decide when that is tried, never who holds the lease.
    """

    store: InboxStore
    drain_id: str
    epoch: int
    seconds: int

    @property
    def _beat(self) -> str:
        return f"{_folder(self.store, self.drain_id)}/{self.epoch:010d}.beat"

    def check(self) -> None:
        """Raise if a later epoch exists."""
        newest = max(_epochs(self.store, self.drain_id))
        if newest != self.epoch:
            raise StaleLease(f"epoch {self.epoch} of drain {self.drain_id} was followed by {newest}")

    def renew(self, now: float | None = None) -> None:
        self.check()
        write_file(self.store.spark, self._beat, str(time.time() if now is None else now))

    def release(self) -> None:
        """Let the next drainer in at once."""
        self.check()
        write_file(self.store.spark, self._beat, "0")


def acquire(store: InboxStore, drain_id: str, seconds: int = 300, now: float | None = None) -> DrainLease | None:
    """A lease of the next epoch, or None while another drainer beats or has just been faster."""
    now = time.time() if now is None else now
    folder = _folder(store, drain_id)
    last = max(_epochs(store, drain_id), default=0)
    if last:
        beats = set(list_files(store.spark, folder))
        # An epoch file without a beat is a drainer that has only just come.
        name = f"{last:010d}.beat" if f"{last:010d}.beat" in beats else f"{last:010d}"
        if float(read_file(store.spark, f"{folder}/{name}") or now) + seconds > now:
            return None
    if not create_file(store.spark, f"{folder}/{last + 1:010d}", str(now)):
        return None
    return DrainLease(store, drain_id, last + 1, seconds)
