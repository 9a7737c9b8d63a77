"""Text outputs: packed nominal lines and alarm lines, published together."""

from .publish import Publication, recover
from .text import alarm_lines, nominal_lines, pack_nominal, read_lines, write_alarms, write_nominal

__all__ = [
    "Publication",
    "alarm_lines",
    "nominal_lines",
    "pack_nominal",
    "read_lines",
    "recover",
    "write_alarms",
    "write_nominal",
]
