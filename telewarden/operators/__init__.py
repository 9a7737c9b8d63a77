"""Data operators: sanitizing, per-sensor scan, firing, correlation, split, packing."""
