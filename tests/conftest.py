from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidegate.schema import DELIVERY, EVENT, ORIGIN_COLUMNS  # noqa: E402
from tidegate.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


def instant(epoch_ms: int) -> datetime:
    return datetime.fromtimestamp(epoch_ms / 1000, timezone.utc)


def envelope(event_id: str, ts: str, **data) -> str:
    import json

    inner = {"guid": "g", "operation": "SET", "requestName": "r", "applicationId": "a", **data}
    inner["timestamp"] = ts
    return json.dumps({"specversion": "1.0", "id": event_id, "time": ts, "data": inner})


def deliveries_of(spark, values, arrivals_ms=None, partition=0, first_offset=0):
    rows = [
        (None, v, "t", partition, first_offset + i, instant((arrivals_ms or [0] * len(values))[i]))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, DELIVERY)


def events_of(spark, rows):
    """Rows of (epoch_ms, id[, ingest_ms, offset, payload]) as accepted events at W=5."""
    full = []
    for i, row in enumerate(rows):
        ms, event_id, *rest = row
        ingest, offset, payload = [*rest, *[ms, i, f"p{i}"][len(rest) :]]
        bucket = ms // 1000 // 5 * 5
        full.append(
            (bucket, instant(ms), event_id, "", "", "", "", "", instant(ingest), payload, "t", 0, offset)
        )
    names = [*EVENT.fieldNames(), *ORIGIN_COLUMNS]
    schema = ", ".join(
        f"`{n}` {t}"
        for n, t in zip(
            names,
            [f.dataType.simpleString() for f in EVENT.fields] + ["string", "int", "bigint"],
            strict=True,
        )
    )
    return spark.createDataFrame(full, schema)
