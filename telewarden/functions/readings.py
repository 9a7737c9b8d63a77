"""Parsing of raw text readings, and arrival slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing field.
NULL_TOKENS = ("", "NA", "NaN", "null")

# ISO-8601 date and time, with seconds, fraction and zone optional.
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"
)
NOT_IN_A_NUMBER = "[^0-9.eE+-]"


def null_tokens(field: Column) -> Column:
    return F.when(~field.isin(*NULL_TOKENS), field)


def is_number(name: str) -> Column:
    """Whether a text is a finite decimal number; the cast alone takes ``5d`` or ``nan``."""
    return F.expr(
        f"""coalesce(abs(try_cast({name} AS double)) < double('Infinity'), false)
        AND NOT {name} RLIKE '{NOT_IN_A_NUMBER}'"""
    )


def event_time(name: str) -> Column:
    """Timestamp, or null where the text is no ISO-8601 date and time.

    The plain cast reads the usual forms but also ``10:00`` or ``2026``; fixed places of
    the separators settle ``yyyy-MM-ddTHH:mm:ssZ`` and a pattern all other forms. Minutes
    followed by a zone are what the cast cannot read.
    """
    return F.expr(
        f"""CASE
        WHEN length({name}) = 20 AND endswith({name}, 'Z')
            AND substr({name}, 5, 1) = '-' AND substr({name}, 8, 1) = '-'
            AND substr({name}, 14, 1) = ':' AND substr({name}, 17, 1) = ':'
            THEN try_cast({name} AS timestamp)
        WHEN {name} RLIKE r'{ISO_TIMESTAMP}' THEN coalesce(
            try_cast({name} AS timestamp),
            try_to_timestamp(replace({name}, ' ', 'T'), "yyyy-MM-dd'T'HH:mm[XXX][XX]"))
        END"""
    )


def slice_of(seq: Column, slice_rows: int) -> Column:
    """Arrival slice of a reading, named by its first possible ``seq``.

    ``seq`` is unique, so a slice never holds more than ``slice_rows`` rows. It is never
    null, so joins on it add no null filter and all readers can share one shuffle.
    """
    start = seq - seq % F.lit(slice_rows).cast("bigint")
    return F.coalesce(start, F.lit(0).cast("bigint"))
