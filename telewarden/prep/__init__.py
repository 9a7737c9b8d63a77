"""Jobs that prepare telemetry: copies, new times, grids."""

from .jobs import best_batch, grid, replicate, retime

__all__ = ["best_batch", "grid", "replicate", "retime"]
