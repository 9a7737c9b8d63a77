"""Helpers shared by the operators: Arrow batches, flat texts, hashed words, linked components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Staging

#: Bytes of text handled at once inside a task.
SLICE_BYTES = 2 << 20


def held_out(key: Column | str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text is divisible by 5."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of one text column, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(sizes)]):
            yield batch.slice(start, end - start)


def map_text(
    df: DataFrame, work: Callable[[], Callable], schema: str, columns: list[str], limit: int = SLICE_BYTES
) -> DataFrame:
    """Give Arrow slices of ``columns``, the last of which is the text, to what ``work`` makes once a task.

    What it makes takes a record batch and gives some; if it has ``last``, that gives the final ones.
    """

    def run(batches):
        step = work()
        for part in slices(batches, len(columns) - 1, limit):
            yield from step(part)
        if hasattr(step, "last"):
            yield from step.last()

    return df.select(*columns).mapInArrow(run, schema)


def strings(array: pa.Array) -> list[str]:
    """Texts of a column; null is the empty text."""
    return [x or "" for x in array.to_pylist()]


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins and ends."""
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    array = pc.fill_null(array, "").cast(pa.large_string())
    _, places, data = array.buffers()
    bounds = np.frombuffer(places, np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of runs, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring bounds, zero where there are none."""
    if values.ndim == 1:
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return total[bounds[1:]] - total[bounds[:-1]]
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0)
    return out


#: Odd multipliers that mix hashes.
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), MULTIPLY, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def runs(marks: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of equal non-zero marks; a cut also ends a run."""
    change = np.empty(len(marks) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(marks[1:], marks[:-1], out=change[1:-1])
    change[cuts] = True
    edges = np.flatnonzero(change)
    keep = marks[edges[:-1]] != 0
    return edges[:-1][keep], edges[1:][keep]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    inside = np.zeros(len(data) + 1, np.int32)
    inside[starts] += 1
    inside[ends] -= 1
    body = np.cumsum(inside[:-1]) > 0
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = (data[body].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    first = np.cumsum(lengths) - lengths
    return mixed(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def linked(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """For each of n nodes the smallest node that links a-b lead to."""
    labels = np.arange(n) if labels is None else labels
    while len(a):
        low = np.minimum(labels[a], labels[b])
        high = np.maximum(labels[a], labels[b])
        if (open_ := low < high).any():
            a, b = a[open_], b[open_]
            np.minimum.at(labels, high[open_], low[open_])
            while not np.array_equal(labels, nxt := labels[labels]):
                labels = nxt
        else:
            break
    return labels


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """Connected components of links (a, b): node and component, the smallest node reachable.

    Each round gives every node the smallest label among its neighbours, and the node that names a
    component the smallest label that any of its members hears; then every node takes the label of
    its label. So whole components are hooked to lower ones and chains shorten by more than half.
    Rounds go on until no node hears a lower label than its own. The joins' smaller side has one row
    per node; minima are combined before the shuffle. Rounds are written tables.
    """
    both = edges.select("a", "b").filter("a != b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = staging(both, f"{name}_links")
    state = staging(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), f"{name}_0")
    for turn in count(1):
        heard = (
            both.join(state, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        told = staging(state.join(heard, "node").select("node", "component", "heard"), f"{name}_{turn}_heard")
        if told.filter("heard < component").isEmpty():
            return state
        hooks = told.groupBy(F.col("component").alias("node")).agg(F.min("heard").alias("hook"))
        lower = told.join(hooks, "node", "left").select("node", F.least("component", "heard", "hook").alias("via"))
        lower = staging(lower, f"{name}_{turn}_lower")
        jump = lower.select(F.col("node").alias("via"), F.col("via").alias("component"))
        state = staging(lower.join(jump, "via").select("node", "component"), f"{name}_{turn}")


def dealt(rows: DataFrame, keys: list[str], who: str, most: int, staging: Staging, name: str, counted: DataFrame | None = None) -> DataFrame:
    """Deal the rows of each key into pairs of parts, so that any two rows of a key meet in some pair.

    A key with at most ``most`` rows is one part. A larger one has several, chosen by the hash of
    ``who``, and each row goes to the pairs (p, q), p <= q, of its part with every part. Rows of the
    same part are to be compared in the pair (p, p) alone. ``counted`` may be the bare key columns.
    """
    sizes = (rows if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / most).cast("int").alias("parts")
    large = staging(sizes.filter(F.col("n") > most).select(*keys, parts), name)
    return (
        rows.join(large, keys, "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64(who), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("p", F.least("part", "other"))
        .withColumn("q", F.greatest("part", "other"))
        .drop("parts", "other")
    )


def together(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the same keys side by side in one partition."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def whole_runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal values in the first columns, with the bounds of the runs."""
    rest: list[pa.RecordBatch] = []

    def ready(table: pa.Table, final: bool):
        change = np.zeros(max(len(table) - 1, 0), bool)
        for i in range(keys):
            values = table.column(i).to_numpy()
            change |= values[1:] != values[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        return starts, len(table) if final else int(starts[-1])

    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([*rest, batch])
        starts, cut = ready(table, False)
        if cut:
            yield table.slice(0, cut).combine_chunks(), starts
        rest = table.slice(cut).combine_chunks().to_batches()
    if rest:
        table = pa.Table.from_batches(rest)
        starts, cut = ready(table, True)
        yield table, np.append(starts, cut)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session."""
    context = spark.sparkContext
    if getattr(context, "_telewarden_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="telewarden-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._telewarden_shipped = True
