"""Column functions shared by sources, operators and reports (all JVM-side built-ins)."""

from graphloom.functions.scalar import (
    duration_ms,
    json_long_or_zero,
    parse_rest_time,
    rest_time_string,
)

__all__ = ["duration_ms", "json_long_or_zero", "parse_rest_time", "rest_time_string"]
