"""Window files that become visible all at once, empty windows included.

A call of the sink writes its events, in order, to a folder of its own and then a manifest: one
row per window of the call, with its count and the folder. Only a complete manifest (its
``_SUCCESS``) makes a call visible, and readers find files through manifests alone. So a
call that dies before its manifest shows nothing, nothing is moved or renamed, a
window without events leaves a row, and a window that comes again replaces its former self.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.schema import EVENT, EVENT_COLUMNS
from tidegate.session import delete_dir, empty_table, exists, list_dirs

MANIFEST = T.StructType(
    [
        T.StructField("window_bucket", T.LongType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("run", T.StringType()),
    ]
)


@dataclass(frozen=True)
class PublishedWindows:
    spark: SparkSession
    path: str

    def _data(self, drain_id: str) -> str:
        return f"{self.path}/data/drain_id={drain_id}"

    def _manifests(self, drain_id: str) -> str:
        return f"{self.path}/manifest/drain_id={drain_id}"

    def __call__(self, events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        """The sink: events first, the manifest last."""
        run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        events.select(*EVENT_COLUMNS).write.parquet(f"{self._data(drain_id)}/run={run}")
        rows = windows.select("window_bucket", "event_count").withColumn("run", F.lit(run))
        self._publish(rows, drain_id, run)

    def _publish(self, rows: DataFrame, drain_id: str, name: str) -> None:
        rows.select(*MANIFEST.fieldNames()).write.parquet(f"{self._manifests(drain_id)}/name={name}")

    def _complete(self, drain_id: str) -> list[str]:
        base = self._manifests(drain_id)
        return [f"{base}/{n}" for n in list_dirs(self.spark, base) if exists(self.spark, f"{base}/{n}/_SUCCESS")]

    def _published(self, folders: list[str]) -> DataFrame:
        """Every (window, call) that the manifests name."""
        if not folders:
            return empty_table(self.spark, MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(*folders).select(*MANIFEST.fieldNames())

    def windows(self, drain_id: str) -> DataFrame:
        """(window_bucket, event_count, run) of every published window, empty ones included: its last call."""
        return _latest(self._published(self._complete(drain_id)))

    def read(self, drain_id: str, first: int | None = None, last: int | None = None) -> DataFrame:
        """Published events of the windows ``first``..``last``; only folders of calls that own one are read.

        Windows published once need no join; those that came again are taken out of the calls they have left.
        """
        rows = self._published(self._complete(drain_id))
        if first is not None:
            rows = rows.where(F.col("window_bucket") >= first)
        if last is not None:
            rows = rows.where(F.col("window_bucket") <= last)
        owned = _latest(rows)
        # One name per call.
        runs = [r.run for r in owned.where("event_count > 0").select("run").distinct().collect()]
        base = self._data(drain_id)
        if not runs:
            return empty_table(self.spark, EVENT)
        schema = T.StructType([*EVENT.fields, T.StructField("run", T.StringType())])
        reader = self.spark.read.schema(schema).option("basePath", base)
        events = reader.parquet(*[f"{base}/run={run}" for run in sorted(runs)])
        if first is not None:
            events = events.where(F.col("window_bucket") >= first)
        if last is not None:
            events = events.where(F.col("window_bucket") <= last)
        left = rows.join(owned.select("window_bucket", "run"), ["window_bucket", "run"], "left_anti")
        return events.join(left.select("window_bucket", "run"), ["window_bucket", "run"], "left_anti").select(*EVENT_COLUMNS)

    def merge(self, drain_id: str) -> None:
        """Replace all manifests by one. Both say the same, so a reader may meet either or both.

        Calls that still own a window keep the rows of those they have lost: their files hold them.
        """
        folders = self._complete(drain_id)
        if len(folders) > 1:
            rows = self._published(folders)
            rows = rows.distinct().join(_latest(rows).select("run").distinct(), "run", "left_semi")
            self._publish(rows, drain_id, f"{time.time_ns():020d}-{uuid.uuid4().hex}")
            for folder in folders:
                delete_dir(self.spark, folder)

    def clean(self, drain_id: str) -> list[str]:
        """Delete the folders of calls that own no window any more or died before their manifest.

        For the drainer itself, between its drains: a call under way has no manifest yet.
        """
        owners = {r.run for r in self.windows(drain_id).select("run").distinct().collect()}
        base = self._data(drain_id)
        gone = [n for n in list_dirs(self.spark, base) if n.removeprefix("run=") not in owners]
        for name in gone:
            delete_dir(self.spark, f"{base}/{name}")
        return gone


def _latest(rows: DataFrame) -> DataFrame:
    """The last call of each window: names of calls grow with time."""
    order = Window.partitionBy("window_bucket").orderBy(F.col("run").desc())
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
