"""Incremental evaluation of a stream with carried state."""

from .incremental import Monitor
from .keyed import KeyedMonitor
from .progress import Progress

__all__ = ["KeyedMonitor", "Monitor", "Progress"]
