"""Source replay: an inbox built anew beside the old one, and the switch between them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidegate.config import InboxConfig
from tidegate.session import create_file, delete_dir, list_dirs, list_files, read_file
from tidegate.sources.store import InboxStore

#: Fills a store from the earliest offsets on; returns when all of them are stored.
Fill = Callable[[InboxStore], None]


def _pointers(base: str) -> str:
    return f"{base}/active"


def active_version(spark: SparkSession, base: str) -> tuple[int, str | None]:
    """Number and root of the inbox in use; (0, None) before the first."""
    names = list_files(spark, _pointers(base))
    return (int(names[-1]), f"{base}/{read_file(spark, f'{_pointers(base)}/{names[-1]}')}") if names else (0, None)


def active_store(spark: SparkSession, base: str, config: InboxConfig) -> InboxStore:
    """The inbox in use. A store keeps its root: look again to follow a switch."""
    _, root = active_version(spark, base)
    if root is None:
        raise ValueError(f"no inbox has been built below {base}")
    return InboxStore(spark, root, config)


def rebuild(spark: SparkSession, base: str, config: InboxConfig, fill: Fill, keep_ledgers: bool = True) -> InboxStore:
    """Build a new inbox below ``base`` from the source and make it the one in use.

    Readers and drainers stay with the old inbox until the new one is complete; a fill
    that fails changes nothing. With ``keep_ledgers`` the new inbox starts with the drain ledgers
    and emitted keys of the old one, so windows that were drained stay drained; without,
    they drain again. Of two rebuilds that started from the same inbox one may switch.
    """
    version, old = active_version(spark, base)
    name = f"version={version + 1:06d}-{uuid.uuid4().hex}"
    store = InboxStore(spark, f"{base}/{name}", config)
    fill(store)
    if keep_ledgers and old is not None:
        copy_ledgers(InboxStore(spark, old, config), store)
    if not create_file(spark, f"{_pointers(base)}/{version + 1:010d}", name):
        delete_dir(spark, store.root)
        raise RuntimeError("another rebuild has replaced the inbox meanwhile")
    return store


def copy_ledgers(old: InboxStore, new: InboxStore) -> None:
    """Take over what was drained and emitted; keys keep the names of the runs that emitted them."""
    new.append_progress(old.progress(), "merged")
    for drain in list_dirs(old.spark, old.emitted_path):
        drain_id = drain.split("=", 1)[1]
        new.append_emitted(old.emitted(drain_id).drop("run").distinct(), drain_id, "before-rebuild")


def drop_superseded(spark: SparkSession, base: str) -> list[str]:
    """Delete every inbox below ``base`` but the one in use, once no job reads them and no rebuild is under way."""
    _, root = active_version(spark, base)
    old = [n for n in list_dirs(spark, base) if n.startswith("version=") and f"{base}/{n}" != root]
    for name in old:
        delete_dir(spark, f"{base}/{name}")
    return old


def same_inbox(one: InboxStore, other: InboxStore, now_epoch: int) -> bool:
    """Whether two inboxes hold the same keys and payloads at a time, compared without moving payloads."""
    now = F.timestamp_seconds(F.lit(now_epoch))

    def sums(store: InboxStore):
        row = F.xxhash64("window_bucket", "event_ts", "event_id", "payload").cast("decimal(38,0)")
        return store.inbox(now=now).agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("s")).first()

    return tuple(sums(one)) == tuple(sums(other))
