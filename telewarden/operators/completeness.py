"""Which catalogue sensors are missing at which timestamp, and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import Stage, row_numbers

#: Sensors of a word of a bitmap.
WORD = 64


def sensor_counts(df: DataFrame) -> DataFrame:
    """Distinct sensors and readings per timestamp."""
    return (
        df.groupBy("timestamp", "sensor_id")
        .agg(F.count("*").alias("n"))
        .groupBy("timestamp")
        .agg(F.count("*").alias("sensors"), F.sum("n").alias("readings"))
    )


def missing_readings(df: DataFrame, catalogue: DataFrame, stage: Stage) -> DataFrame:
    """One row per (timestamp, catalogue sensor) without a reading; ``catalogue`` has ``sensor_id``.

    Catalogue sensors are numbered. The sensors seen at a timestamp are bits of words, combined
    before the shuffle, and are taken away from the catalogue's words; only bits that are left become
    rows. The catalogue stays a table, and no set of sensors is gathered anywhere.
    """
    numbers = row_numbers(catalogue.select("sensor_id").distinct(), stage, ["sensor_id"], "sensors")
    place = {"word": F.floor(F.col("row") / WORD), "bit": (F.col("row") % WORD).cast("int")}
    numbers = stage(numbers.withColumns(place).select("sensor_id", "word", "bit"), "numbers")
    one = F.expr("shiftleft(1L, bit)")
    expected = stage(numbers.groupBy("word").agg(F.bit_or(one).alias("expected")), "expected")
    words = expected.count()
    if not words:
        return df.select("timestamp", "sensor_id").limit(0)
    # Readings of other sensors make their timestamp known but set no bit.
    met = df.select("timestamp", "sensor_id").join(numbers, "sensor_id", "left")
    seen = met.groupBy("timestamp", F.coalesce("word", F.lit(0)).alias("word"))
    seen = stage(seen.agg(F.coalesce(F.bit_or(one), F.lit(0)).alias("seen")), "seen")
    moments = seen.select("timestamp").distinct()
    every = moments.select("timestamp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(words - 1).cast("long"))).alias("word"))
    left = every.join(seen, ["timestamp", "word"], "left").join(expected, "word")
    left = left.withColumn("missing", F.col("expected").bitwiseAND(F.bitwise_not(F.coalesce("seen", F.lit(0)))))
    bits = F.expr(f"filter(sequence(0, {WORD - 1}), b -> getbit(missing, b) = 1)")
    open_ = left.filter("missing <> 0").select("timestamp", "word", F.explode(bits).alias("bit"))
    return open_.join(numbers, ["word", "bit"]).select("timestamp", "sensor_id")


def unknown_sensors(df: DataFrame, sensors: list[str]) -> DataFrame:
    """Readings per sensor that the catalogue does not list."""
    return (
        df.filter(~F.col("sensor_id").isin(sensors))
        .groupBy("sensor_id")
        .agg(F.count("*").alias("readings"))
    )


def batch_metrics(df: DataFrame, alarms: DataFrame, batch: Column) -> DataFrame:
    """Rows and alarms per batch; ``batch`` is computed from ``seq`` on both frames."""
    rows = df.groupBy(batch.alias("batch")).agg(F.count("*").alias("rows"))
    fired = alarms.groupBy(batch.alias("batch")).agg(F.count("*").alias("alarms"))
    return rows.join(fired, "batch", "left").select(
        "batch", "rows", F.coalesce("alarms", F.lit(0).cast("bigint")).alias("alarms")
    )
