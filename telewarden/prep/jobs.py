"""Data preparation as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import event_time
from ..operators.numbering import Stage, row_numbers

# Length of yyyy-MM-ddTHH:mm:ssZ; retiming replaces such times, other rows keep what they have.
ISO_LENGTH = 20


def replicate(df: DataFrame, copies: int, span: int, shift_seconds: int = 0) -> DataFrame:
    """The whole body ``copies`` times, copy after copy; ``span`` exceeds every ``seq``.

    With a shift, each copy's ISO timestamps move on by that many seconds.
    """
    copied = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    if shift_seconds:
        moved = F.to_timestamp("timestamp") + F.make_interval(
            secs=F.col("copy") * shift_seconds
        )
        copied = copied.withColumn("timestamp", _iso(moved))
    return copied.withColumn("seq", F.col("copy").cast("bigint") * span + F.col("seq")).drop("copy")


def retime(df: DataFrame, base: str, per_second: int, stage: Stage) -> DataFrame:
    """Replace ISO timestamps by ``base`` + floor(row / per_second) seconds."""
    numbered = row_numbers(df, stage)
    whole = ((F.col("row") - F.col("row") % per_second) / per_second).cast("bigint")
    moved = F.timestamp_seconds(F.unix_seconds(F.to_timestamp(F.lit(base))) + whole)
    good = (F.length("timestamp") == ISO_LENGTH) & event_time("timestamp").isNotNull()
    return numbered.withColumn(
        "timestamp", F.when(good, _iso(moved)).otherwise(F.col("timestamp"))
    ).drop("row")


def grid(timestamps: DataFrame, sensors: list[str]) -> DataFrame:
    """Every timestamp with every catalogue sensor."""
    return timestamps.select(
        "timestamp", F.explode(F.array(*(F.lit(s) for s in sensors))).alias("sensor_id")
    )


def best_batch(results: DataFrame) -> DataFrame:
    """Batch size with the smallest time, its throughput, and peak memory in MB."""
    return results.agg(
        F.min_by("batch_size", F.struct("seconds", "batch_size")).alias("batch_size"),
        F.min("seconds").alias("seconds"),
        F.min_by("rows", F.struct("seconds", "batch_size")).alias("rows"),
        F.min_by("max_kb", F.struct("seconds", "batch_size")).alias("max_kb"),
    ).select(
        "batch_size",
        "seconds",
        (F.col("rows") / F.col("seconds")).alias("rows_per_second"),
        (F.col("max_kb") / 1024).alias("max_mb"),
    )


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
