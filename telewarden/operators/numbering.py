"""Running numbers over a whole frame without a window over all rows.

The frame is spread by ranges of the order and staged with each row's place: its partition and its
index there. What comes before a partition is known from one total per partition.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Stage = Callable[[DataFrame, str], DataFrame]

# monotonically_increasing_id: the partition above these bits, the index in it below.
INDEX_BITS = 33
INDEX = (1 << INDEX_BITS) - 1


def placed(df: DataFrame, order: list[str], stage: Stage, name: str) -> DataFrame:
    """The staged frame in order, with ``place``. Every reader sees the same places."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.withColumn("place", F.monotonically_increasing_id()), name)


def _with_offset(df: DataFrame, weight: Column) -> DataFrame:
    """Adds ``part`` and ``offset``, the weight of all earlier partitions."""
    spark = df.sparkSession
    part = F.shiftright("place", INDEX_BITS).alias("part")
    totals = sorted((r.part, r.total) for r in df.groupBy(part).agg(F.sum(weight).alias("total")).collect())
    before = [0, *accumulate(total for _, total in totals)]
    offsets = spark.createDataFrame(
        [(number, offset) for (number, _), offset in zip(totals, before)], "part int, offset bigint"
    )
    # One row per shuffle partition, whatever the data.
    return df.withColumn("part", part.cast("int")).join(F.broadcast(offsets), "part")


def row_numbers(df: DataFrame, stage: Stage, order: list[str] | None = None, name: str = "rows") -> DataFrame:
    """``row``: 0-based place in the order (``seq`` by default)."""
    numbered = _with_offset(placed(df, order or ["seq"], stage, name), F.lit(1))
    row = F.col("offset") + F.col("place").bitwiseAND(F.lit(INDEX))
    return numbered.withColumn("row", row).drop("part", "offset", "place")


def running_sum(df: DataFrame, order: list[str], weight: str, stage: Stage, name: str) -> DataFrame:
    """``before``: the sum of ``weight`` over all rows that come earlier in the order."""
    weighted = _with_offset(placed(df, order, stage, name), F.col(weight))
    earlier = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    return weighted.withColumn("before", before).drop("part", "offset", "place")


def counted_rows(df: DataFrame, name: str) -> DataFrame:
    """``name``: how many rows the task has read before this one; streams have no other number.

    It rises along each split of a file, so (split, number) is the order in which packets were written.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])

    def number(batches):
        before = 0
        for batch in batches:
            counts = pa.array(np.arange(before, before + len(batch)), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, name])
            before += len(batch)

    return df.mapInArrow(number, schema)
