"""Integrity filter: keep well-formed readings, quarantine the rest with a reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import (
    NULL_TOKENS,
    event_time,
    is_known_priority,
    is_number,
    normal_priority,
    null_tokens,
)
from ..schemas import ARRIVAL, CORRUPT, MANDATORY, REJECTS, TELEMETRY


# Reasons in the order of the checks.
REASONS = ("malformed", "schema_missing_field", "schema_priority", "type_value", "type_timestamp")


class Sanitized(NamedTuple):
    clean: DataFrame
    rejects: DataFrame


def mark(raw: DataFrame) -> DataFrame:
    """Every row with its reason, null for a clean one; the mandatory columns must be there."""
    return _named(raw).withColumn("reject_reason", _reason(_number(raw), CORRUPT in raw.columns))


def counted(marked: DataFrame, observation: Observation) -> DataFrame:
    """The same rows; running them counts all rows and the rejects by reason."""
    reasons = (F.count_if(F.col("reject_reason") == r).alias(r) for r in REASONS)
    return marked.observe(observation, F.count(F.lit(1)).alias("rows"), *reasons)


def split(marked: DataFrame) -> Sanitized:
    """Clean readings and rejects of marked rows."""
    extra = [ARRIVAL] if ARRIVAL in marked.columns else []
    clean = marked.filter(F.col("reject_reason").isNull()).select(
        "timestamp",
        "sensor_id",
        F.col("value").try_cast("double").alias("value"),
        _priority().alias("priority"),
        event_time("timestamp").alias("event_time"),
        "seq",
        *extra,
    )
    return Sanitized(clean, _rejects(marked))


def packets_of(marked: DataFrame) -> DataFrame:
    """Clean readings and rejects in one frame: ``reason`` and ``text`` (the raw value) tell a reject."""
    good = F.col("reject_reason").isNull()
    extra = [ARRIVAL] if ARRIVAL in marked.columns else []
    return marked.select(
        *(F.when(good, F.col(name)).otherwise(null_tokens(F.col(name))).alias(name) for name in ("timestamp", "sensor_id")),
        F.when(good, F.col("value").try_cast("double")).alias("value"),
        F.when(~good, null_tokens(F.col("value").cast("string"))).alias("text"),
        F.when(good, _priority()).otherwise(null_tokens(F.col("priority"))).alias("priority"),
        F.col("reject_reason").alias("reason"),
        F.when(good, event_time("timestamp")).alias("event_time"),
        "seq",
        _line(marked).alias("line"),
        *extra,
    )


def _rejects(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("reject_reason").isNotNull()).select(
        null_tokens(F.col("timestamp")).alias("timestamp"),
        null_tokens(F.col("sensor_id")).alias("sensor_id"),
        null_tokens(F.col("value").cast("string")).alias("value"),
        null_tokens(F.col("priority")).alias("priority"),
        "seq",
        "reject_reason",
        _line(marked).alias("line"),
    )


def _line(marked: DataFrame) -> Column:
    """The text of a reject that was damaged as a whole."""
    if CORRUPT not in marked.columns:
        return F.lit(None).cast("string")
    return F.when(F.col("reject_reason") == "malformed", F.col(CORRUPT))


def sanitize(raw: DataFrame) -> Sanitized:
    """Clean readings and rejects; a missing mandatory column leaves nothing."""
    spark = raw.sparkSession
    if any(name not in raw.columns for name in MANDATORY):
        return Sanitized(
            spark.createDataFrame([], TELEMETRY), spark.createDataFrame([], REJECTS)
        )
    named = _named(raw)
    number = _number(raw)
    clean = named.filter(
        F.col("timestamp").isNotNull()
        & _present("sensor_id")
        & number
        & is_known_priority(_priority())
        & event_time("timestamp").isNotNull()
    ).select(
        "timestamp",
        "sensor_id",
        F.col("value").try_cast("double").alias("value"),
        _priority().alias("priority"),
        event_time("timestamp").alias("event_time"),
        "seq",
        *([ARRIVAL] if ARRIVAL in raw.columns else []),
    )
    return Sanitized(clean, _rejects(mark(raw)))


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("rows"))


def _named(raw: DataFrame) -> DataFrame:
    """The telemetry columns, with a priority and an arrival number in any case."""
    return raw.select(
        *MANDATORY,
        (F.col("priority") if "priority" in raw.columns else F.lit(None))
        .cast("string")
        .alias("priority"),
        F.col("seq") if "seq" in raw.columns else F.monotonically_increasing_id().alias("seq"),
        *(name for name in (CORRUPT, ARRIVAL) if name in raw.columns),
    )


def _number(raw: DataFrame) -> Column:
    """Whether the value is a finite number. A null token is none, like any other text."""
    if dict(raw.dtypes)["value"] == "string":
        return is_number("value")
    return F.coalesce(F.abs(F.col("value").cast("double")) < float("inf"), F.lit(False))


def _present(name: str) -> Column:
    return F.coalesce(~F.col(name).isin(*NULL_TOKENS), F.lit(False))


def _priority() -> Column:
    return normal_priority(null_tokens(F.col("priority")))


def _reason(number: Column, has_corrupt: bool) -> Column:
    """First failing check; a damaged line counts as malformed if fields are gone."""
    value = F.col("value").cast("string")
    missing = ~(_present("timestamp") & _present("sensor_id")) | null_tokens(value).isNull()
    reason = F
    if has_corrupt:
        reason = reason.when(missing & F.col(CORRUPT).isNotNull(), "malformed")
    return (
        reason.when(missing, "schema_missing_field")
        .when(~is_known_priority(_priority()), "schema_priority")
        .when(~number, "type_value")
        .when(event_time("timestamp").isNull(), "type_timestamp")
    )
