"""Strict instants in, ISO-8601 UTC text out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instant forms an envelope may carry.
ISO_INSTANT = (
    r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2}|\+00(00)?)$"
)
EPOCH_NUMBER = r"^[+-]?\d{1,13}(\.\d{1,17})?(E\d{1,2})?$"


def strict_instant(text: str) -> Column:
    """Timestamp of an ISO instant with a zone, or of epoch seconds; null for anything else.

    ``text`` names a column or field.
    """
    return F.expr(f"""
        CASE
          WHEN trim({text}) RLIKE r'{ISO_INSTANT}' THEN try_cast(upper(trim({text})) AS TIMESTAMP)
          WHEN trim({text}) RLIKE r'{EPOCH_NUMBER}' THEN timestamp_micros(
            try_cast(try_cast(trim({text}) AS DECIMAL(27, 9)) * 1000000 AS BIGINT))
        END""")


def to_millis(ts: Column) -> Column:
    """Stored precision: milliseconds, rounded down."""
    return F.date_trunc("MILLISECOND", ts)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with ``Z``; the fraction is left out when it is zero. Needs a UTC session."""
    fraction = F.when(F.unix_millis(ts) % 1000 == 0, "").otherwise(F.date_format(ts, ".SSS"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def epoch_micros_ntz(ts: Column) -> Column:
    """Epoch microseconds of a zoneless timestamp read as UTC, whatever the session zone is."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)
