from __future__ import annotations

import json

from conftest import deliveries_of, envelope
from pyspark.sql import functions as F

from tidegate.functions.envelope import decode
from tidegate.functions.timestamps import iso_utc

FULL = {
    "specversion": "1.0",
    "id": "refund-7731",
    "source": "urn:shop:till-4",
    "type": "refund.booked",
    "time": "2025-03-09T14:05:52.000Z",
    "datacontenttype": "application/json",
    "unknown": {"ignored": True},
    "data": {
        "guid": "till-4-0000093",
        "operation": "NEW",
        "requestName": "book refund",
        "applicationId": "shop",
        "timestamp": "2025-03-09T14:05:52.250750Z",
        "slupTimestamp": 1741529152250,
        "clientAddress": "192.0.2.9",
        "fields": [{"name": "x", "value": 1}],
        "other": [],
    },
}


def text(drop=(), data_drop=(), **changes) -> str:
    data_changes = changes.pop("data_changes", {})
    env = {k: v for k, v in FULL.items() if k not in drop}
    if "data" in env:
        env["data"] = {k: v for k, v in FULL["data"].items() if k not in data_drop} | data_changes
    return json.dumps(env | changes)


def decoded(spark, values):
    rows = decode(deliveries_of(spark, values), 5).withColumn("ms", F.unix_millis("event_ts"))
    return [r.asDict() for r in rows.orderBy("offset").collect()]


def reasons(spark, values):
    return [r["reason"] for r in decoded(spark, values)]


def test_full_event_maps_every_field_and_keeps_the_text(spark):
    (row,) = decoded(spark, [text()])
    assert row["reason"] is None
    assert row["value"] == text()
    assert row["ms"] == 1741529152250
    assert row["window_bucket"] == 1741529150
    assert row["event_id"] == "refund-7731"
    assert (row["guid"], row["operation"], row["request_name"]) == ("till-4-0000093", "NEW", "book refund")
    assert (row["application_id"], row["client_address"]) == ("shop", "192.0.2.9")


def test_falls_back_to_the_envelope_time(spark):
    for value in (text(data_drop=["timestamp"]), text(data_changes={"timestamp": ""})):
        (row,) = decoded(spark, [value])
        assert row["ms"] == 1741529152000


def test_missing_fields_become_empty_text(spark):
    only_time = json.dumps({"id": "a", "data": {"timestamp": "2026-07-16T09:41:27Z"}})
    (row,) = decoded(spark, [only_time])
    fields = ("guid", "operation", "request_name", "application_id", "client_address")
    assert [row[f] for f in fields] == [""] * 5


OUTCOMES = [
    ("{not-valid-json", "not_json"),
    ("this-is-not-a-cloud-event", "not_json"),
    (text(drop=["id"]), "missing_id"),
    (text(id=None), "missing_id"),
    (text(id="   "), "missing_id"),
    (text(id=" \t"), "missing_id"),
    (text(id=" "), None),
    (text(drop=["data"]), "missing_data"),
    (text(data=None), "missing_data"),
    (text(drop=["time"], data_drop=["timestamp"]), "no_timestamp"),
    (text(drop=["id", "data"]), "missing_id"),
    ("null", "not_json"),
    ("", "not_json"),
    (None, "not_json"),
    ("[]", "not_json"),
    (f"[{text()}]", "not_json"),
    ('"text"', "not_json"),
    ("12", "not_json"),
    (text().replace('"', "'"), "not_json"),
    (text() + " trailing", None),
    (text(data=[]), "not_json"),
    (text(data=""), "not_json"),
    (text(id={"x": 1}), "not_json"),
    (text(type=["x"]), "not_json"),
    (text(id="{x"), None),
    (text(data_changes={"guid": {"a": 1}}), "not_json"),
    (text(id=12), None),
    (text(id=True), None),
    (text(time="yesterday"), "not_json"),
    (text(time="2026-07-16T09:41:27"), "not_json"),
    (text(time="2026-07-16"), "not_json"),
    (text(time="2026-02-30T00:00:00Z"), "not_json"),
    (text(data_changes={"timestamp": {"a": 1}}), "not_json"),
    (text(data_changes={"timestamp": True}), "not_json"),
    (text(data_changes={"slupTimestamp": "abc"}), "not_json"),
    (text(data_changes={"slupTimestamp": "12"}), None),
    (text(data_changes={"slupTimestamp": ""}), None),
    (text(data_changes={"slupTimestamp": 12.7}), None),
    (text(data_changes={"slupTimestamp": "12.7"}), "not_json"),
    (text(data_changes={"slupTimestamp": 10**20}), "not_json"),
    (text(data_changes={"fields": [1]}), "not_json"),
    (text(data_changes={"fields": {"a": 1}}), "not_json"),
    (text(data_changes={"fields": [{"a": [1, {"b": 2}]}, None]}), None),
    (text(data_changes={"fields": None}), None),
    (text().replace('"NEW"', "NaN"), "not_json"),
    ('{"id":"a","id":"b","data":{"timestamp":"2026-07-16T09:41:27Z"}}', None),
]


def test_outcomes(spark):
    got = reasons(spark, [value for value, _ in OUTCOMES])
    wrong = [(v, want, is_) for (v, want), is_ in zip(OUTCOMES, got, strict=True) if want != is_]
    assert wrong == []


TIMES = [
    ("2026-07-16T09:41:27Z", 1784194887000),
    ("2026-07-16t09:41:27.5z", 1784194887500),
    ("2026-07-16T11:41:27.123456789+02:00", 1784194887123),
    ("2026-07-16T09:41:27+0000", 1784194887000),
    (" 2026-07-16T09:41:27Z ", 1784194887000),
    (1784194887, 1784194887000),
    ("1784194887", 1784194887000),
    (1784194887.25, 1784194887250),
    (0, 0),
]


def test_timestamp_forms(spark):
    rows = decoded(spark, [text(data_changes={"timestamp": stamp}) for stamp, _ in TIMES])
    assert [(r["reason"], r["ms"]) for r in rows] == [(None, ms) for _, ms in TIMES]


def test_last_duplicate_key_wins(spark):
    (row,) = decoded(spark, ['{"id":"a","id":"b","data":{"timestamp":"2026-07-16T09:41:27Z"}}'])
    assert row["event_id"] == "b"


def test_huge_epoch_number_is_rejected_not_raised(spark):
    values = [text(data_changes={"timestamp": n}) for n in (10**30, 9_999_999_999_999, "9" * 40)]
    assert reasons(spark, values) == ["not_json"] * 3


def test_whole_long_text_survives(spark):
    long = "é\"\\\n " * 60_000
    value = text(data_changes={"requestName": long})
    (row,) = decoded(spark, [value])
    assert row["request_name"] == long
    assert row["value"] == value


def test_own_parser(spark):
    def csv(deliveries, window_seconds):
        parts = F.split("value", ",")
        return deliveries.select(
            "*",
            F.when(F.size(parts) != 2, "bad").alias("reason"),
            F.get(parts, F.lit(1)).alias("event_id"),
        )

    rows = decode(deliveries_of(spark, ["1,a", "oops"]), 5, csv).orderBy("offset").collect()
    assert [(r.reason, r.event_id) for r in rows] == [(None, "a"), ("bad", None)]


def test_iso_text_drops_a_zero_fraction(spark):
    times = spark.sql("SELECT timestamp_millis(1784194887120) a, timestamp_millis(1784194887000) b")
    row = times.select(iso_utc(F.col("a")).alias("a"), iso_utc(F.col("b")).alias("b")).first()
    assert (row.a, row.b) == ("2026-07-16T09:41:27.120Z", "2026-07-16T09:41:27Z")


def test_envelope_helper_is_accepted(spark):
    assert reasons(spark, [envelope("x", "2026-07-16T10:00:00Z")]) == [None]
