"""Envelope decoding: delivery text to event columns plus a rejection reason.

Built-in functions only; written as SQL text where an expression is long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.timestamps import strict_instant, to_millis
from tidegate.functions.windows import window_bucket
from tidegate.schema import CORRUPT, ENVELOPE

# Why a delivery becomes a dead letter, in the order they are tested.
NOT_JSON = "not_json"
MISSING_ID = "missing_id"
MISSING_DATA = "missing_data"
NO_TIMESTAMP = "no_timestamp"

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

BLANK = r"^\p{javaWhitespace}*$"

# Envelope field and the event column it becomes; empty text when missing.
OPTIONAL_FIELDS = [
    ("guid", "guid"),
    ("operation", "operation"),
    ("requestName", "request_name"),
    ("applicationId", "application_id"),
    ("clientAddress", "client_address"),
]

TEXT_FIELDS = [
    "specversion",
    "id",
    "source",
    "type",
    "datacontenttype",
    "data.guid",
    "data.operation",
    "data.requestName",
    "data.applicationId",
    "data.clientAddress",
]


def read_envelope(value: Column) -> Column:
    return F.from_json(value, ENVELOPE, JSON_OPTIONS)


def is_blank(text: Column) -> Column:
    """Null, empty or only Unicode white space."""
    return text.isNull() | text.rlike(BLANK)


def null_to_empty(text: str) -> Column:
    return F.expr(f"coalesce({text}, '')")


def json_kind(value: str, path: str) -> str:
    """SQL text for the JSON type name at ``path``; meant for the rare texts that need it."""
    return f"schema_of_variant(try_variant_get(try_parse_json({value}), '$.{path}', 'variant'))"


def _holds_container(value: str, envelope: str) -> str:
    """A text field given as an object or array, which the JSON reader turns into text."""
    tests = [
        f"((startswith({envelope}.{path}, '{{') OR startswith({envelope}.{path}, '['))"
        f" AND {json_kind(value, path)} RLIKE '^(OBJECT|ARRAY)')"
        for path in TEXT_FIELDS
    ]
    return " OR ".join(tests)


def _bad_integer(value: str, envelope: str, path: str) -> str:
    """Not an integer that fits 64 bits; a JSON number with a fraction is allowed, such text is not."""
    text = f"trim({envelope}.{path})"
    return rf"""(
        {text} <> ''
        AND NOT ({text} RLIKE r'^[+-]?\d+$' AND try_cast({text} AS BIGINT) IS NOT NULL)
        AND NOT ({text} RLIKE r'^-?\d+\.\d+([eE][+-]?\d+)?$'
                 AND coalesce({json_kind(value, path)} RLIKE '^(DECIMAL|DOUBLE)', false)))"""


Parser = Callable[[DataFrame, int], DataFrame]


def envelope_parser(deliveries: DataFrame, window_seconds: int) -> DataFrame:
    """Default parser: append ``reason`` and the event fields to deliveries.

    Any function of this shape can be passed to ``decode`` instead. Each
    projection computes what the next one uses more than once, so the text and
    both timestamps are parsed a single time.
    """
    parsed = (
        deliveries.withColumn("_env", read_envelope(F.col("value")))
        .withColumns(
            {
                "_time": strict_instant("_env.time"),
                "_data_time": strict_instant("_env.data.timestamp"),
            }
        )
        .withColumn("_instant", F.expr("coalesce(_data_time, _time)"))
    )
    undecodable = f"""
        _env IS NULL OR _env.{CORRUPT} IS NOT NULL
        OR (trim(_env.time) <> '' AND _time IS NULL)
        OR (trim(_env.data.timestamp) <> '' AND _data_time IS NULL)
        OR {_bad_integer("value", "_env", "data.slupTimestamp")}
        OR {_holds_container("value", "_env")}"""
    reason = rf"""
        CASE WHEN {undecodable} THEN '{NOT_JSON}'
             WHEN _env.id IS NULL OR _env.id RLIKE r'{BLANK}' THEN '{MISSING_ID}'
             WHEN _env.data IS NULL THEN '{MISSING_DATA}'
             WHEN _instant IS NULL THEN '{NO_TIMESTAMP}' END"""
    return parsed.select(
        *deliveries.columns,
        F.expr(reason).alias("reason"),
        window_bucket(F.col("_instant"), window_seconds).alias("window_bucket"),
        to_millis(F.col("_instant")).alias("event_ts"),
        F.col("_env.id").alias("event_id"),
        *[null_to_empty(f"_env.data.{path}").alias(name) for path, name in OPTIONAL_FIELDS],
    )


def decode(deliveries: DataFrame, window_seconds: int, parser: Parser = envelope_parser) -> DataFrame:
    """Parsed deliveries behind a generator.

    The optimizer pushes a later filter on ``reason`` through projections,
    which would parse every text once more inside the filter; it cannot push
    one through a generator.
    """
    return parser(deliveries, window_seconds).selectExpr("inline(array(struct(*)))")
