"""Sharding: best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are a group and stay together. Groups go, from the largest to the smallest, to
the tightest shard that still has room (the first of equally tight ones), or to a new shard. The room
left is kept in a balanced search tree. Groups of one size are alike, so the packing needs only how
many groups of each size there are: Spark counts them, the packing places all of a size at a time, and
Spark numbers the groups in the same order and looks each one up. Sizes keep ``SIGNIFICANT`` bits,
rounded up, so there are at most 1.6 million different ones below 2^63 bytes, whatever the data; a size up to 65,536
bytes is exact. Nothing else comes to the driver.

``pack`` uses as few shards of a fixed capacity as the method finds; a group above the capacity has a
shard of its own. ``near_equal`` has a fixed number of shards: groups above the fair share get a shard
each, and the others share the rest at the smallest capacity found that suffices.

A null text is the empty text. Rows are never dropped: repeated rows and rows without key are placed
and numbered like any other. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial
from random import Random

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import row_numbers
from ..session import Staging

#: Leading bits of a group's size that count; what lies below is rounded up.
SIGNIFICANT = 16


class Rooms:
    """Shards by room left and number, in a treap: runs of neighbouring shards with equal room are one node."""

    def __init__(self):
        self.root, self.random = None, Random(1)

    def _split(self, node, key):
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[4] > b[4]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, room: int, first: int, number: int) -> None:
        if room > 0 and number > 0:
            low, high = self._split(self.root, (room, first))
            self.root = self._merge(self._merge(low, [(room, first), number, None, None, self.random.random()]), high)

    def tightest(self, size: int) -> tuple[int, int, int] | None:
        """Takes out the run of shards with the least room for the size: room, first shard, number of shards."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        path, node = None, high
        while node[2] is not None:
            path, node = node, node[2]
        if path is None:
            high = node[3]
        else:
            path[2] = node[3]
        self.root = self._merge(low, high)
        return *node[0], node[1]


#: The groups from ``first`` on, counted over all sizes in falling order, go to shards from ``shard`` on, ``each`` to a shard.
Step = tuple[int, int, int]


def packed(classes: Iterable[tuple[int, int]], capacity: int, first: int = 0, shard: int = 0) -> tuple[list[Step], int]:
    """Steps for the groups of (size, count) in falling order of size, and the number after the last shard."""
    rooms, steps = Rooms(), []
    for size, count in classes:
        while count:
            found = rooms.tightest(size)
            if found:
                room, begin, number = found
                each = room // size
            else:
                each = max(1, capacity // size)
                room, begin, number = capacity, shard, -(-count // each)
                shard += number
            used = min(number, -(-count // each))
            placed = min(count, used * each)
            full, rest = divmod(placed, each)
            steps.append((first, begin, each))
            rooms.add(room - each * size, begin, full)
            if rest:
                rooms.add(room - rest * size, begin + full, 1)
            rooms.add(room, begin + used, number - used)
            first += placed
            count -= placed
    return steps, shard


def least(classes: list[tuple[int, int]], shards: int) -> list[Step]:
    """Steps for a fixed number of shards of nearly the same size."""
    total = sum(size * count for size, count in classes)
    steps, alone, rest = [], 0, []
    for size, count in classes:
        while count and shards - alone > 1 and size * (shards - alone) > total:
            steps.append((alone, alone, 1))
            alone, count, total = alone + 1, count - 1, total - size
        if count:
            rest.append((size, count))
    if not rest:
        return steps

    def tried(more: int):
        found, end = packed(rest, low + more, alone, alone)
        return found if end <= shards else None

    low = max(-(-total // (shards - alone)), rest[0][0])
    bad, good = -1, 0
    while (found := tried(good)) is None:
        bad, good = good, max(1, 2 * good)
    while good - bad > 1:
        middle = (good + bad) // 2
        if (better := tried(middle)) is not None:
            found, good = better, middle
        else:
            bad = middle
    return steps + found


def rounded(size: str) -> Column:
    """The size rounded up to its leading bits."""
    low = f"greatest(length(bin({size})) - {SIGNIFICANT}, 0)"
    return F.expr(f"shiftleft(shiftright({size} + shiftleft(1L, {low}) - 1, {low}), {low})")


def looked_up(batches, steps):
    """h, g, size and shard of groups with their number, from the steps in order of the numbers."""
    first, begin, each = steps
    for batch in batches:
        row = batch.column(3).to_numpy()
        at = np.searchsorted(first, row, "right") - 1
        shard = begin[at] + (row - first[at]) // each[at]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shard, pa.int32())], ["h", "g", "size", "shard"])


def counted(batches):
    """Adds the task's number and, for each row, how many rows of its shard came before in the task."""
    seen: dict[int, int] = {}
    part = TaskContext.get().partitionId()
    for batch in batches:
        shard = batch.column(3).to_numpy()
        order = np.argsort(shard, kind="stable")
        own, start, size = np.unique(shard[order], return_index=True, return_counts=True)
        local = np.empty(len(shard), np.int64)
        before = np.array([seen.get(s, 0) for s in own.tolist()], np.int64)
        local[order] = np.arange(len(shard)) - np.repeat(start, size) + np.repeat(before, size)
        seen.update(zip(own.tolist(), (before + size).tolist()))
        columns = [*batch.columns, pa.array(np.full(len(shard), part), pa.int32()), pa.array(local)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "size", "crc", "shard", "part", "local"])


def _placed(spark: SparkSession, docs: DataFrame, key: str, text: str, planned) -> DataFrame:
    staging = Staging(spark)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("crc"),
        F.xxhash64(whole).alias("h"),
        F.xxhash64(F.lit(1), whole).alias("g"),
    )
    rows = staging(rows, "rows")
    groups = rows.groupBy("h", "g", "size").agg((F.count("*") * F.col("size")).alias("whole"))
    groups = groups.select("h", "g", "size", (-rounded("whole")).alias("down"))
    groups = row_numbers(groups, staging, ["down", "h", "g"], "groups")
    sizes = groups.groupBy("down").count().toPandas().sort_values("down")
    steps = planned([(-int(s), int(n)) for s, n in zip(sizes["down"], sizes["count"])]) or [(0, 0, 1)]
    shared = spark.sparkContext.broadcast(tuple(np.array(x, np.int64) for x in zip(*steps)))
    of = groups.select("h", "g", "size", "row").mapInArrow(lambda b: looked_up(b, shared.value), "h long, g long, size long, shard int")
    kind = rows.schema["key"].dataType.simpleString()
    dealt = rows.join(of, ["h", "g", "size"]).select("key", "size", "crc", "shard")
    dealt = staging(dealt.mapInArrow(counted, f"key {kind}, size long, crc long, shard int, part int, local long"), "dealt")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    offsets = offsets.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return dealt.join(offsets, ["shard", "part"]).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("offset") + F.col("local")).alias("slot")
    )


def pack(spark: SparkSession, docs: DataFrame, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, shard and slot of each row, in as few shards of ``capacity`` bytes as found."""
    return _placed(spark, docs, key, text, lambda classes: packed(classes, capacity)[0])


def near_equal(spark: SparkSession, docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, shard and slot of each row, in ``shards`` shards of nearly equal size."""
    return _placed(spark, docs, key, text, partial(least, shards=shards))
