"""Telemetry readers.

Each returns raw readings: text columns (a bad value survives until it is sanitized)
plus ``seq``, a unique increasing arrival number. Rule evaluation follows ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import INDEX, running_sum
from ..schemas import ARRIVAL, CORRUPT, PACKET
from ..session import Staging

# A file's numbers begin after the bytes of all earlier files, with room for this many rows each:
# a task that reads many small files counts its rows through all of them.
FILE_ROOM = 1 << 31


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header, every column as text. Files whose header differs are refused."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in [*names, CORRUPT]]
    )
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # With pruning a short line goes unnoticed if an unread column is what it lacks.
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    return _with_file_seq(lines, path)


def read_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON packet per line."""
    packets = (
        spark.read.schema(PACKET)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return _with_file_seq(packets, path)


def read_stream(
    spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Packets, or CSV lines with a header, landing in a folder.

    A CSV file whose header is not that of the packets, in their order, is refused. ``arrival`` orders splits by the time their file was written, its name and their place in it.
    """
    reader = (
        spark.readStream.schema(PACKET)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        rows = reader.option("header", True).option("enforceSchema", False).option("columnPruning", False).csv(path)
    else:
        rows = reader.format(fmt).load(path)
    written = F.lpad(F.unix_micros("_metadata.file_modification_time").cast("string"), 20, "0")
    start = F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")
    return rows.select("*", F.concat_ws(" ", written, "_metadata.file_path", start).alias(ARRIVAL))


def from_payloads(records: DataFrame, payload: Column, offset: Column, arrival: Column | None = None) -> DataFrame:
    """Packets that come as a JSON payload beside an offset, as brokers hand them over; batch or stream.

    A payload that is no JSON object is kept whole as damaged text. ``offset`` numbers the records;
    with ``arrival``, text that sorts, it does so only among equal ones, such as those of one file.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    packet = F.from_json(payload.cast("string"), PACKET, options)
    rows = records.select(
        packet.alias("packet"), offset.cast("bigint").alias("seq"), *([] if arrival is None else [arrival.alias(ARRIVAL)])
    )
    return rows.select("packet.*", *rows.columns[1:])


def from_table(
    df: DataFrame,
    timestamp: Column,
    sensor_id: Column,
    value: Column,
    seq: Column,
    priority: Column | None = None,
) -> DataFrame:
    """Any table as raw readings; ``seq`` must be a unique increasing bigint."""
    return df.select(
        seq.cast("bigint").alias("seq"),
        timestamp.alias("timestamp"),
        sensor_id.alias("sensor_id"),
        value.alias("value"),
        (F.lit(None).cast("string") if priority is None else priority).alias("priority"),
    )


def with_time_seq(df: DataFrame, order: list[str | Column], stage) -> DataFrame:
    """Number readings by a total order (event time first) instead of by arrival.

    One range shuffle spreads the order evenly over tasks. The frame is staged because
    the numbers depend on sampled range bounds and every reader must see the same ones.
    """
    numbered = (
        df.drop("seq").orderBy(*order).withColumn("seq", F.monotonically_increasing_id())
    )
    return stage(numbered, "time_seq")


def _position() -> Column:
    """Place of a row in its file.

    The row counter of a Spark partition stays below half the split size, so adding it
    to the split's byte offset keeps line order across splits.
    """
    return F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(INDEX))


def _with_file_seq(df: DataFrame, path: str | list[str]) -> DataFrame:
    """Arrival number: files in name order, then line order.

    Files are numbered by a Spark job over their names and lengths.
    """
    spark = df.sparkSession
    columns = df.columns
    files = spark.read.format("binaryFile").load(path)
    files = files.select(
        F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_size") + FILE_ROOM).alias("room")
    )
    if len(files.head(2)) < 2:
        return df.select(*columns, _position().alias("seq"))
    numbers = running_sum(files, ["file"], "room", Staging(spark), "files").select("file", "before")
    read = df.select(*columns, F.col("_metadata.file_path").alias("file"), _position().alias("position"))
    first_seq = F.coalesce("before", F.raise_error(F.lit("reading of an unlisted file")))
    return read.join(numbers, "file", "left").select(*columns, (first_seq + F.col("position")).alias("seq"))
