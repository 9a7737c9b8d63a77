"""Readers of telemetry and of the two catalogues."""

from .catalogues import load_rules, load_sensors, sensor_frame
from .telemetry import (
    from_payloads,
    from_table,
    read_csv,
    read_json,
    read_stream,
    with_time_seq,
)

__all__ = [
    "from_payloads",
    "from_table",
    "load_rules",
    "load_sensors",
    "read_csv",
    "read_json",
    "read_stream",
    "sensor_frame",
    "with_time_seq",
]
