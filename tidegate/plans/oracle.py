"""Expected answers as ANSI SQL for DuckDB.

Computed arithmetically from ``events`` by the rules of
``sources.synthetic``; the generated delivery text is only written out where
the payload itself is the answer.
"""

from __future__ import annotations

from tidegate.plans.catalog import (
    AFTER,
    AHEAD_PARTITION,
    BEHIND_PARTITION,
    BEHIND_UNTIL,
    IDLE_SECONDS,
    LATE_PARTITION,
    LATE_TTL,
    NOW,
)

LATE_AFTER = 60


def _deliveries(w: int) -> str:
    """Common tables: d = every delivery, ok = accepted, k = keys, u = last write per key."""
    return f"""
WITH copies(copy) AS (VALUES (0), (1), (2)),
d AS (
  SELECT event_id, user_id, event_type, props, copy,
    event_id * 3 + copy AS "offset", CAST(event_id % 6 AS INTEGER) AS "partition",
    epoch_us(ts) AS us, epoch_us(ts) // 1000 AS event_ts_ms,
    epoch_us(ts) // 1000 + (event_id * 37 + copy * 61) % 181 * 1000 AS ingest_ms,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
    epoch_us(ts) // 1000000 // {w} * {w} AS window_bucket,
    event_id % 97 AS kind,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'NEW'
         WHEN event_type IN ('click', 'view') THEN 'SET'
         WHEN event_type = 'error' THEN 'DELETE' END AS operation,
    lpad(CAST(user_id AS VARCHAR), 24, '0') AS guid,
    CASE WHEN user_id % 3 <> 0 THEN 'req-' || (user_id % 7) END AS request,
    CASE WHEN event_id % 4 <> 1 THEN '10.0.' || (user_id % 200) || '.' || (event_id % 250) END AS address
  FROM events JOIN copies
    ON copy = 0 OR (copy = 1 AND event_id % 10 = 0) OR (copy = 2 AND event_id % 50 = 0)
),
ok AS (
  SELECT *, coalesce(request, '') AS request_name, coalesce(address, '') AS client_address,
    "partition" = {LATE_PARTITION} AND window_bucket <= {(NOW - w - LATE_AFTER) // w * w} AS late
  FROM d WHERE kind NOT IN (13, 29, 41, 53)
),
k AS (
  SELECT window_bucket, event_ts_ms, CAST(event_id AS VARCHAR) AS event_id, count(*) AS copies,
    min(ingest_ms) AS first_seen
  FROM ok GROUP BY ALL
),
u AS (
  SELECT * FROM ok
  QUALIFY row_number() OVER (
    PARTITION BY window_bucket, event_ts_ms, event_id
    ORDER BY ingest_ms DESC, "partition" DESC, "offset" DESC) = 1
)
"""


TEXT = r"""
CASE WHEN kind = 13 THEN 'not-json' ELSE
  '{"specversion":"1.0",' || CASE WHEN kind <> 29 THEN '"id":"' || event_id || '",' ELSE '' END ||
  '"source":"urn:events","type":"' || event_type || '",' ||
  CASE WHEN kind <> 53 THEN '"time":"' || iso || '",' ELSE '' END ||
  '"datacontenttype":"application/json"' ||
  CASE WHEN kind = 41 THEN '' ELSE
    ',"data":{"guid":"' || guid || '","operation":"' || operation || '",' ||
    CASE WHEN request IS NOT NULL THEN '"requestName":"' || request || '",' ELSE '' END ||
    '"applicationId":"' || event_type || '",' ||
    CASE WHEN kind NOT IN (53, 61) THEN '"timestamp":"' || iso || '",' ELSE '' END ||
    '"slupTimestamp":' || event_ts_ms ||
    CASE WHEN address IS NOT NULL THEN ',"clientAddress":"' || address || '"' ELSE '' END ||
    ',"fields":[{"props":"' || replace(replace(props, '\', '\\'), '"', '\"') || '"}]}'
  END || '}'
END
"""

PLAIN = f"""window_bucket, event_ts_ms, CAST(event_id AS VARCHAR) AS event_id, guid, operation,
  request_name, event_type AS application_id, client_address, ingest_ms, {TEXT} AS payload"""

KEYS = "window_bucket, event_ts_ms, CAST(event_id AS VARCHAR) AS event_id"

REASON = """CASE kind WHEN 13 THEN 'not_json' WHEN 29 THEN 'missing_id'
  WHEN 41 THEN 'missing_data' WHEN 53 THEN 'no_timestamp' END"""


def _iso(ms: str) -> str:
    """ISO text of epoch milliseconds, fraction left out when zero."""
    whole = f"strftime(make_timestamp(({ms}) // 1000 * 1000000), '%Y-%m-%dT%H:%M:%S')"
    part = f"CASE WHEN ({ms}) % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(({ms}) % 1000 AS VARCHAR), 3, '0') END"
    return f"{whole} || {part} || 'Z'"


LINE = f"""window_bucket AS "windowBucket", {_iso('event_ts_ms')} AS "eventTs",
  CAST(event_id AS VARCHAR) AS "eventId", guid, operation, request_name AS "requestName",
  event_type AS "applicationId", client_address AS "clientAddress",
  {_iso('ingest_ms')} AS "ingestTime", {TEXT} AS payload"""


def _ledger(w: int, now: int) -> str:
    """Further tables: l = ledger of a drain at ``now`` that met all but the late partition's events."""
    newest = (now - w - LATE_AFTER) // w * w
    return f""", emitted AS (
  SELECT window_bucket, event_ts_ms, event_id FROM k WHERE CAST(event_id AS BIGINT) % 6 <> {LATE_PARTITION}
),
span AS (
  SELECT unnest(generate_series(min(window_bucket), {newest}, {w})) AS window_bucket FROM emitted
),
l AS (
  SELECT span.window_bucket, count(emitted.event_id) AS event_count
  FROM span LEFT JOIN emitted USING (window_bucket) GROUP BY ALL
)
"""


def _gapfilled(w: int) -> str:
    return _deliveries(w) + f""", span AS (
  SELECT unnest(generate_series(min(window_bucket), max(window_bucket), {w})) AS window_bucket FROM k
)
SELECT span.window_bucket, count(k.event_id) AS event_count
FROM span LEFT JOIN k USING (window_bucket) GROUP BY ALL"""


def _drained(drained_at: str) -> str:
    """Gap-filled ledger over all hourly windows, every delivery stored."""
    return _deliveries(3600) + f""", span AS (
  SELECT unnest(generate_series(min(window_bucket), {{last}}, 3600)) AS window_bucket FROM k
)
SELECT 'primary' AS drain_id, span.window_bucket, count(k.event_id) AS event_count,
  CAST({drained_at} AS BIGINT) AS drained_at
FROM span LEFT JOIN k USING (window_bucket) GROUP BY ALL"""


N, H = _deliveries(5), _deliveries(3600)
INBOX = N + f"SELECT {PLAIN} FROM u"
LETTERS = N + f"""SELECT CAST(event_id AS VARCHAR) AS key, {TEXT} AS value, {REASON} AS reason,
  'cloud-events' AS topic, "partition", "offset" FROM d WHERE kind IN (13, 29, 41, 53)"""
# The deliveries of the store in which one source partition has stopped and one is ahead.
UNEVEN = f"""CASE "partition" WHEN {BEHIND_PARTITION} THEN {BEHIND_UNTIL} WHEN {AHEAD_PARTITION} THEN {AFTER} ELSE {NOW} END"""
LAG = N + f""", c AS (
  SELECT "partition", max("offset") + 1 AS committed_offset FROM d WHERE ingest_ms // 1000 < {UNEVEN} GROUP BY ALL
), e AS (
  SELECT "partition", max("offset") + 1 AS end_offset FROM d GROUP BY ALL
), lag AS (
  SELECT 'cloud-events' AS topic, "partition", committed_offset, end_offset,
    greatest(0, end_offset - committed_offset) AS lag
  FROM c JOIN e USING ("partition")
)
"""
CLOCK = H + f""", i AS (
  SELECT * FROM ok WHERE ingest_ms // 1000 < {UNEVEN}
), seen AS (
  SELECT "partition", max(ingest_ms) AS last_seen FROM d WHERE ingest_ms // 1000 < {UNEVEN} GROUP BY ALL
), high AS (
  SELECT "partition", max(event_ts_ms) // 1000 AS high FROM i GROUP BY ALL
), clock AS (
  SELECT CAST(NULL AS BIGINT) AS idle_seconds, min(high) AS clock, count(*) AS partitions FROM high
  UNION ALL
  SELECT {IDLE_SECONDS}, min(high) FILTER (WHERE last_seen >= (SELECT max(last_seen) FROM seen) - {IDLE_SECONDS * 1000}),
    count(*)
  FROM high JOIN seen USING ("partition")
)
"""

ORACLE: dict[str, str] = {
    "scan_deliveries": N
    + f"""SELECT CAST(event_id AS VARCHAR) AS key, {TEXT} AS value, 'cloud-events' AS topic,
      "partition", "offset", ingest_ms AS arrival_ms FROM d""",
    "scan_window": H
    + f"SELECT {PLAIN} FROM u WHERE window_bucket = (SELECT max(window_bucket) FROM u)",
    "scan_progress": H
    + _ledger(3600, NOW)
    + f"SELECT 'primary' AS drain_id, window_bucket, event_count, CAST({NOW} AS BIGINT) AS drained_at FROM l",
    "scan_dead_letters": N
    + f"""SELECT CAST(event_id AS VARCHAR) AS key, {TEXT} AS value, "partition", "offset"
      FROM d WHERE kind IN (13, 29, 41, 53) ORDER BY "partition", "offset" LIMIT 20""",
    "sample_inbox": N + f"SELECT {KEYS}, operation FROM u ORDER BY 1, 2, 3 LIMIT 20",
    "parse_events": N
    + """SELECT "offset", window_bucket, event_ts_ms, CAST(event_id AS VARCHAR) AS event_id, guid,
      operation, request_name, event_type AS application_id, client_address, ingest_ms FROM ok""",
    "parse_texts": "SELECT doc_id, source, text, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
    "resolve_event_ts": N
    + 'SELECT "offset", event_ts_ms, us AS sent_micros, kind = 61 AS from_envelope FROM ok',
    "null_to_empty": N
    + """SELECT request_name, count(*) AS events,
      count(*) FILTER (WHERE client_address = '') AS without_address FROM ok GROUP BY ALL""",
    "payload_verbatim": N + f'SELECT "offset", {TEXT} AS payload FROM ok',
    "ingest_time": N
    + 'SELECT "offset", ingest_ms, (event_id * 37 + copy * 61) % 181 * 1000 AS delay_ms FROM ok',
    "window_bucket": """SELECT event_id, epoch_us(ts) // 1000000 // 5 * 5 AS bucket_5,
      epoch_us(ts) // 1000000 // 7 * 7 AS bucket_7,
      epoch_us(ts) // 1000000 // 3600 * 3600 AS bucket_3600 FROM events""",
    "tumbling_window": """SELECT epoch_us(ts) // 1000000 // 5 * 5 AS window_bucket, count(*) AS events
      FROM events GROUP BY ALL""",
    "seal_time": N + "SELECT DISTINCT window_bucket, window_bucket + 65 AS sealed_after FROM k",
    "sink_json": N + f"SELECT {LINE} FROM u",
    "valid_events": N
    + """SELECT 'cloud-events' AS topic, "partition", "offset", CAST(event_id AS VARCHAR) AS event_id FROM ok""",
    "dead_letters": LETTERS,
    "reject_reasons": N
    + f"SELECT {REASON} AS reason, count(*) AS deliveries FROM d WHERE kind IN (13, 29, 41, 53) GROUP BY ALL",
    "blank_id": "SELECT event_id, event_id % 4 <> 3 AS blank FROM events",
    "key_lookup": N
    + """SELECT window_bucket, event_ts_ms, event_id, CAST(1 AS BIGINT) AS stored_rows, copies
      FROM k ORDER BY copies DESC, window_bucket, event_ts_ms, event_id LIMIT 1""",
    "sealed_windows": N
    + f"""SELECT window_bucket, count(*) AS event_count, CAST(sum(copies) AS BIGINT) AS deliveries,
      window_bucket + 65 AS sealed_after FROM k WHERE {NOW} >= window_bucket + 65 GROUP BY ALL""",
    "live_rows": N + f"SELECT {KEYS} FROM u WHERE ingest_ms > CAST({NOW} - 86400 AS BIGINT) * 1000",
    "replay_range": H + f"SELECT {KEYS} FROM u WHERE window_bucket >= {NOW} // 3600 * 3600",
    "inbox_ttl": H + f"SELECT {KEYS} FROM u WHERE ingest_ms > CAST({NOW} + 129600 - 86400 AS BIGINT) * 1000",
    "late_arrivals": N + 'SELECT "offset", CAST(event_id AS VARCHAR) AS event_id, window_bucket FROM ok WHERE late',
    "late_behind_ledger": N
    + f"SELECT {KEYS} FROM u WHERE window_bucket <= ({NOW} - {5 + LATE_AFTER}) // 5 * 5",
    "late_data_kept": N
    + """SELECT window_bucket, count(*) AS writes, count(*) FILTER (WHERE late) AS late_writes
      FROM ok GROUP BY ALL""",
    "windows_gapfilled": _gapfilled(3600),
    "windows_gapfilled_narrow": _gapfilled(5),
    "undrained_windows": H
    + _ledger(3600, NOW)
    + """SELECT window_bucket, count(*) AS event_count FROM k
      WHERE window_bucket NOT IN (SELECT window_bucket FROM l) GROUP BY ALL""",
    "drain_reconcile": H
    + _ledger(3600, NOW)
    + """, a AS (
        SELECT window_bucket, count(DISTINCT (event_ts_ms, event_id)) AS actual FROM ok
        WHERE ingest_ms > (SELECT min(window_bucket) + 86400 FROM emitted) * 1000 GROUP BY ALL)
      SELECT window_bucket, event_count AS recorded, coalesce(actual, 0) AS actual,
        coalesce(actual, 0) - event_count AS late_rows
      FROM l FULL JOIN a USING (window_bucket)""",
    "late_side_output": N
    + _ledger(5, NOW)
    + f"""SELECT {PLAIN} FROM u
      WHERE window_bucket IN (SELECT window_bucket FROM l)
        AND (window_bucket, event_ts_ms, CAST(event_id AS VARCHAR)) NOT IN
          (SELECT (window_bucket, event_ts_ms, event_id) FROM emitted)""",
    "late_output_ticks": N
    + _ledger(5, NOW)
    + f"""SELECT CAST(CASE WHEN event_id % 4 < 2 THEN 0 ELSE 1 END AS INTEGER) AS tick, {KEYS} FROM u
      WHERE "partition" = {LATE_PARTITION} AND window_bucket IN (SELECT window_bucket FROM l)
        AND ingest_ms > CAST({NOW - LATE_TTL} AS BIGINT) * 1000""",
    "offset_lag": LAG + "SELECT * FROM lag",
    "lag_summary": LAG
    + """SELECT max(lag) AS largest_lag, CAST(sum(lag) AS BIGINT) AS total_lag,
      count(*) AS partitions, CAST(10000 AS BIGINT) AS max_lag FROM lag""",
    "stream_throughput": "SELECT CAST(1 AS BIGINT) AS batches, count(*) AS source_rows, true AS has_rate FROM events",
    "stream_clock": CLOCK + "SELECT * FROM clock",
    "window_counts": H
    + """SELECT window_bucket, count(*) AS event_count, CAST(sum(copies) AS BIGINT) AS deliveries
      FROM k GROUP BY ALL""",
    "last_drained": H
    + f"""SELECT 'primary' AS drain_id, max({(NOW - 3660) // 3600 * 3600}::BIGINT) AS last_bucket FROM k
      UNION ALL
      SELECT 'replay', min(window_bucket) + 864000 FROM k""",
    "ingest_counters": N
    + """SELECT (SELECT count(*) FROM ok) AS success, (SELECT count(*) FROM d) - (SELECT count(*) FROM ok) AS parse_error,
      (SELECT count(*) FROM ok WHERE late) AS late_arrival, CAST(1 AS BIGINT) AS write_error""",
    "throughput": N
    + """SELECT count(*) AS deliveries, (max(ingest_ms) - min(ingest_ms)) / 1000 AS elapsed_seconds,
      count(*) / ((max(ingest_ms) - min(ingest_ms)) / 1000) AS per_second FROM ok""",
    "latency_percentiles": N
    + """, r AS (SELECT ingest_ms - event_ts_ms AS latency_ms,
        row_number() OVER (ORDER BY ingest_ms - event_ts_ms) AS rn, count(*) OVER () AS n FROM ok)
      SELECT CAST(p AS DOUBLE) AS p, latency_ms FROM r JOIN (VALUES (0.5), (0.95), (0.99)) t(p)
      ON rn = floor(n * CAST(p AS DOUBLE)) + 1""",
    "window_size_audit": H
    + f"""SELECT window_bucket, count(*) AS event_count,
      CAST(sum(strlen({TEXT})) AS BIGINT) AS payload_bytes,
      sum(strlen({TEXT})) > 8000 AS oversized FROM u GROUP BY ALL""",
    "dedup_stats": N
    + """SELECT CAST(sum(copies) AS BIGINT) AS deliveries, count(*) AS distinct_events,
      CAST(sum(copies - 1) AS BIGINT) AS redeliveries, max(copies) AS max_copies FROM k""",
    "upsert_latest": INBOX,
    "ordered_window": H
    + """SELECT window_bucket, event_id,
      row_number() OVER (PARTITION BY window_bucket ORDER BY event_ts_ms, event_id) AS position FROM k""",
    "newest_windows": H
    + """SELECT window_bucket, count(*) AS event_count, CAST(sum(copies) AS BIGINT) AS deliveries
      FROM k GROUP BY ALL ORDER BY window_bucket DESC LIMIT 10""",
    "write_inbox": INBOX,
    "compacted_inbox": INBOX,
    "write_dead_letters": LETTERS,
    "drain_files": H + f"SELECT window_bucket, {LINE} FROM u",
    "published_windows": H
    + f""", span AS (
        SELECT unnest(generate_series(min(window_bucket), {(AFTER - 3660) // 3600 * 3600}, 3600)) AS window_bucket FROM k)
      SELECT span.window_bucket, count(k.event_id) AS event_count, count(k.event_id) AS events
      FROM span LEFT JOIN k USING (window_bucket) GROUP BY ALL""",
    "source_replay": INBOX,
    "latency_estimates": "SELECT CAST(p AS DOUBLE) AS p, true AS within FROM (VALUES (0.5), (0.95), (0.99)) t(p)",
    "redelivery_estimates": N + "SELECT CAST(sum(copies) AS BIGINT) AS deliveries, true AS within FROM k",
    "pluggable_sink": H + "SELECT window_bucket, operation, count(*) AS events FROM u GROUP BY ALL",
    "record_progress": _drained(str(AFTER)).format(last="max(window_bucket)"),
    "stream_ingest": INBOX,
    "stream_ingest_metrics": N
    + f"""SELECT (SELECT count(*) FROM ok WHERE "partition" = {LATE_PARTITION}) AS success,
      (SELECT count(*) FROM d WHERE "partition" = {LATE_PARTITION} AND kind IN (13, 29, 41, 53)) AS parse_error,
      (SELECT count(*) FROM ok WHERE late) AS late_arrival""",
    "drain_cycle": _drained(
        f"CASE WHEN span.window_bucket + 3660 <= {NOW} THEN {NOW} ELSE {AFTER} END"
    ).format(last=(AFTER - 3660) // 3600 * 3600),
    "bootstrap_cursor": H
    + f""", rules AS (
        SELECT 'latest' AS rule, max({(NOW - 3660) // 3600 * 3600}::BIGINT) AS bucket, true AS is_ledger_first FROM k
        UNION ALL SELECT 'start_zero', max({(NOW - 3660) // 3600 * 3600}::BIGINT), true FROM k
        UNION ALL SELECT 'configured', min(window_bucket), true FROM k
        UNION ALL SELECT 'inside_a_window', min(window_bucket), true FROM k
        UNION ALL SELECT 'resume', max({(NOW - 3660) // 3600 * 3600}::BIGINT) + 3600, false FROM k)
      SELECT * FROM rules""",
    "drain_backlog": N
    + f""", span AS (
        SELECT unnest(generate_series(min(window_bucket), {(AFTER - 65) // 5 * 5}, 5)) AS window_bucket FROM k)
      SELECT span.window_bucket, count(k.event_id) AS event_count
      FROM span LEFT JOIN k USING (window_bucket) GROUP BY ALL""",
    "drain_by_stream_clock": CLOCK
    + """, ends AS (
        SELECT CASE WHEN idle_seconds IS NULL THEN 'patient' ELSE 'hasty' END AS drain_id,
          (clock - 3660) // 3600 * 3600 AS last FROM clock
      ), span AS (
        SELECT drain_id, unnest(generate_series((SELECT min(window_bucket) FROM i), last, 3600)) AS window_bucket FROM ends
      ), counted AS (
        SELECT window_bucket, count(DISTINCT (event_ts_ms, event_id)) AS n FROM i GROUP BY ALL
      )
      SELECT drain_id, window_bucket, coalesce(n, 0) AS event_count FROM span LEFT JOIN counted USING (window_bucket)""",
    "drain_order": H
    + "SELECT window_bucket, CAST(row_number() OVER (ORDER BY window_bucket) AS INTEGER) AS nth FROM k GROUP BY window_bucket",
    "replay_windows": H + f"SELECT {KEYS} FROM u WHERE window_bucket >= {NOW // 3600 * 3600}",
    "split_large_windows": H + f"SELECT {KEYS} FROM u",
    "seal_by_event_time": H
    + """SELECT window_bucket, count(*) AS deliveries FROM ok
      GROUP BY window_bucket
      HAVING (window_bucket + 3600) * 1000 <= (SELECT max(event_ts_ms) FROM ok) - 60000""",
}
