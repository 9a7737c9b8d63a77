"""Rendering of readings in the two text outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_value(name: str) -> Column:
    """Shortest decimal text: plain from 1e-5 up to 1e16, else like ``1.5e-7``.

    Spark's own cast already prints that for 1e-3 <= |x| < 1e7, the usual case.
    """
    trim = r"regexp_replace(cast(try_cast(cast({0} AS string) AS decimal(38,{1})) AS string), r'(\.\d+?)0+$', '$1')"
    return F.expr(
        f"""CASE
        WHEN {name} = 0 OR (abs({name}) >= 1e-3D AND abs({name}) < 1e7D)
            THEN cast({name} AS string)
        WHEN abs({name}) >= 1e7D AND abs({name}) < 1e16D THEN {trim.format(name, 10)}
        WHEN abs({name}) >= 1e-5D AND abs({name}) < 1e-3D THEN {trim.format(name, 25)}
        ELSE lower(replace(cast({name} AS string), '.0E', 'E'))
        END"""
    )


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
