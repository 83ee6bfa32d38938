"""Scalar column functions.

Run-metric times look like ``2024-06-29T23:15:32.889GMT`` (Spark's REST format):
they are read by turning the ``GMT`` suffix into ``Z`` and casting, and written from the
milliseconds since 1970, so neither depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_rest_time(c) -> Column:
    return F.to_timestamp(F.regexp_replace(_col(c), F.lit("GMT$"), F.lit("Z")))


def rest_time_string(c) -> Column:
    """A timestamp as a REST time, in UTC whatever the session time zone."""
    ms = F.unix_millis(_col(c).cast("timestamp"))
    seconds = F.floor(ms / F.lit(1000)).cast("decimal(18,6)")
    zero = F.lit(0)
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    text = utc.cast("string")
    millis = F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis, F.lit("GMT"))


def duration_ms(start, end) -> Column:
    """Milliseconds from ``start`` to ``end``; NULL when either is missing."""
    return F.unix_millis(_col(end)) - F.unix_millis(_col(start))


def json_long_or_zero(c, field: str) -> Column:
    """A top-level JSON field as BIGINT, 0 when the field (or the text) is missing."""
    return F.coalesce(F.get_json_object(_col(c), f"$.{field}").cast("bigint"), F.lit(0).cast("bigint"))


def field_or_zero(c) -> Column:
    """A possibly absent numeric (nested) field, 0 when absent."""
    return F.coalesce(_col(c), F.lit(0).cast("bigint"))
