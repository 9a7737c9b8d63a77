"""Packing and writing. Outputs are folders of ordered, semicolon-separated part files."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import fmt_value, slice_of
from ..operators.numbering import INDEX
from ..plans.evaluate import SLICE_ROWS
from ..schemas import ALARMS
from ..session import exists, observed, remove

logger = logging.getLogger(__name__)

# Longest text of a row in bytes, with room for the other columns.
MAX_BYTES = (1 << 31) - (1 << 16)


def nominal_pieces(valid: DataFrame) -> DataFrame:
    """Readings of one (timestamp, sensor, arrival slice) as one text, by arrival.

    A slice is bounded, and so is what a piece gathers.
    """
    if "seq" not in valid.columns:
        valid = valid.withColumn("seq", F.monotonically_increasing_id())
    if "slice" not in valid.columns:
        valid = valid.withColumn("slice", slice_of(F.col("seq"), SLICE_ROWS))
    text = F.concat("sensor_id", F.lit(":"), fmt_value("value"))
    return (
        valid.select("timestamp", "sensor_id", "slice", "seq", text.alias("text"))
        .groupBy("timestamp", "sensor_id", "slice")
        .agg(F.expr("listagg(text, '|') WITHIN GROUP (ORDER BY seq)").alias("piece"))
    )


def join_pieces(pieces: DataFrame, ordered: bool = False) -> DataFrame:
    """``timestamp, status, sensor_string``: one line per timestamp, sorted by sensor, then arrival.

    ``ordered`` spreads the pieces by ranges of timestamps, which leaves the lines in global
    order without another shuffle. A line that is longer than a row can hold is an error that
    names its timestamp.
    """
    if ordered:
        pieces = pieces.repartitionByRange("timestamp")
    part = F.struct("sensor_id", "slice", "piece")
    too_long = F.concat(F.lit("the nominal line is longer than a row holds: "), "timestamp")
    line = F.when(F.col("bytes") > MAX_BYTES, F.raise_error(too_long)).otherwise(
        F.array_join(F.col("parts.piece"), "|")
    )
    packed = (
        pieces.groupBy("timestamp")
        .agg(
            F.sort_array(F.collect_list(part)).alias("parts"),
            F.sum(F.octet_length("piece") + 1).alias("bytes"),
        )
        .select("timestamp", F.lit("NOMINAL").alias("status"), line.alias("sensor_string"))
    )
    return packed.sortWithinPartitions("timestamp") if ordered else packed


def pack_nominal(valid: DataFrame, ordered: bool = False) -> DataFrame:
    """One line per timestamp, packed in two levels."""
    return join_pieces(nominal_pieces(valid), ordered)


def nominal_lines(packed: DataFrame) -> DataFrame:
    return packed.select(F.concat_ws(";", "timestamp", "status", "sensor_string").alias("value"))


def alarm_lines(alarms: DataFrame) -> DataFrame:
    return alarms.select(F.concat_ws(";", *ALARMS.fieldNames()).alias("value"))


def write_nominal(valid: DataFrame, path: str, mode: str = "append", stage=None) -> int:
    """Write packed lines in timestamp order; the number of lines comes back.

    ``stage`` keeps the pieces, which the range shuffle reads twice.
    """
    if not valid.columns:
        return 0
    pieces = nominal_pieces(valid)
    if stage:
        pieces = stage(pieces, "pieces")
    return _write_lines(nominal_lines(join_pieces(pieces, ordered=True)), path, mode)


def write_alarms(alarms: DataFrame, path: str, mode: str = "append") -> int:
    """Write sorted alarm lines; a frame without the five columns is refused."""
    if not alarms.columns:
        return 0
    missing = [name for name in ALARMS.fieldNames() if name not in alarms.columns]
    if missing:
        logger.error("alarms not written, missing columns: %s", ", ".join(missing))
        return 0
    return _write_lines(alarm_lines(alarms), path, mode)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Written lines with their ``file`` and ``position`` in it; an output without any has no folder."""
    if not exists(spark, path):
        return spark.createDataFrame([], "line string, file string, position bigint")
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(INDEX))
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), place.alias("position")
    )


def _write_lines(lines: DataFrame, path: str, mode: str) -> int:
    """One pass: count while writing; an empty frame leaves no folder behind."""
    spark = lines.sparkSession
    before = exists(spark, path)
    counted = Observation()
    lines.observe(counted, F.count(F.lit(1)).alias("lines")).write.mode(mode).text(path)
    written = observed(counted, "lines")
    if not written and not before:
        remove(spark, path)
    return written
