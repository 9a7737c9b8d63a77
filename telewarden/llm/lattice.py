"""Embedding near-duplicates by lattice hashing on E8.

In each table a unit vector is projected to two blocks of eight numbers, and each block is decoded
to the nearest E8 lattice point; both points together are its home cell. It is also listed in the
neighbouring cells that lie nearest (a probe moves one block by one of the 240 shortest lattice
vectors). Two vectors meet in a table if the home of one is among the cells of the other; those that
meet are verified by cosine in double precision. A linked pair is counted in the first table where
it meets and in one cell of it only, so the counts need no list of pairs. What leaves a task is a
count for each vector and a star for each set of linked vectors. Equal vectors are one node first;
cells with many nodes are dealt to pairs of parts.

Vectors that are null or zero, or hold null or non-finite numbers, link with nothing, and neither
do vectors of different length with each other. A row without vec_id has no component and links
with nothing. Rows that repeat a vec_id with different vectors count as one node. An empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Staging
from .common import components, dealt, linked, mixed, together, whole_runs

#: With these numbers unrelated vectors meet in one pair of 400, and vectors at a cosine of 0.9 are found in 0.95 of all
#: cases, whether they have eight numbers or hundreds.
TABLES = 7
#: Numbers that a table's lattice decodes, in blocks of eight.
BLOCKS = 2
#: Cells beside the home in which a vector is listed.
PROBES = 4
#: Usual length of the eight numbers of a projected unit vector; lattice points are at least 1.41 apart.
LENGTH = 1.3
#: Nodes of a cell that are compared in one go; larger cells are dealt to pairs of parts.
GROUP = 512
SEED = 20240


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum."""
    point = np.rint(x)
    odd = point.sum(axis=1) % 2 != 0
    off = x - point
    worst = np.abs(off).argmax(axis=1)
    row = np.arange(len(x))
    point[row, worst] += np.where(off[row, worst] >= 0, 1, -1) * odd
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points, doubled so that they are whole numbers."""
    whole = nearest_d8(x)
    half = nearest_d8(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], half, whole)).astype(np.int64)


def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-2, 2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((-1, 1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out, np.int64)


def projection(size: int, table: int, block: int) -> np.ndarray:
    """Eight random directions, orthogonal where there is room, scaled to ``LENGTH``."""
    random = np.random.default_rng((SEED, size, table, block))
    drawn = random.standard_normal((size, 8))
    if size < 8:
        return drawn * LENGTH / np.sqrt(8)
    return np.linalg.qr(drawn)[0] * LENGTH * np.sqrt(size / 8)


def cells(units: np.ndarray) -> np.ndarray:
    """For each vector and table the home cell and then the probes, as hashes of 32 bits.

    Cells that share a hash are one cell, in which a few more vectors are compared.
    """
    out = np.empty((len(units), TABLES, 1 + PROBES), np.int32)
    moves = shortest()
    with np.errstate(over="ignore"):
        for table in range(TABLES):
            points, offers, gaps = [], [], []
            for block in range(BLOCKS):
                x = units @ projection(units.shape[1], table, block)
                point = nearest_e8(x)
                rest = x - point / 2
                gap = ((moves / 2) ** 2).sum(axis=1) - 2 * rest @ (moves / 2).T
                best = np.argpartition(gap, PROBES, axis=1)[:, :PROBES]
                points.append(point)
                offers.append(best)
                gaps.append(np.take_along_axis(gap, best, axis=1))
            gap, offer = np.concatenate(gaps, axis=1), np.concatenate(offers, axis=1)
            order = np.argsort(gap, axis=1, kind="stable")[:, :PROBES]
            home = np.concatenate(points, axis=1)
            out[:, table, 0] = hashed(home, table, units.shape[1])
            for probe in range(PROBES):
                column = order[:, probe]
                move = moves[np.take_along_axis(offer, column[:, None], axis=1)[:, 0]]
                point = home.copy().reshape(len(units), BLOCKS, 8)
                point[np.arange(len(units)), column // PROBES] += move
                out[:, table, 1 + probe] = hashed(point.reshape(len(units), -1), table, units.shape[1])
    return out


def hashed(points: np.ndarray, table: int, size: int) -> np.ndarray:
    h = np.full(len(points), table * 1_000_003 + size, np.uint64)
    for column in points.T:
        h = mixed(h * np.uint64(31) + column.astype(np.uint64) + np.uint64(1))
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def unit(vectors: np.ndarray) -> np.ndarray:
    """In double precision, scaled to length one in two steps, so that squares neither overflow nor vanish."""
    vectors = vectors.astype(float)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def celled(batches):
    """node, times, the vector's bytes and all its cells, for rows of node, times and vector."""
    for batch in batches:
        for start in range(0, len(batch), 2000):
            part = batch.slice(start, 2000)
            vectors = part.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own_values = values[first[rows][:, None] + np.arange(size)]
                columns = [part.column(i).take(pa.array(rows)) for i in (0, 1)]
                columns.append(pa.array([x.tobytes() for x in own_values], pa.binary()))
                columns.append(pa.array([c.tobytes() for c in cells(unit(own_values))], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["node", "times", "vector", "cells"])


def listed(batches, bare: bool):
    """A row for each cell of each vector: t, cell, and then all that ``celled`` gives."""
    times = TABLES * (1 + PROBES)
    for batch in batches:
        for start in range(0, len(batch), 2000):
            part = batch.slice(start, 2000)
            own = np.frombuffer(b"".join(part.column(3).to_pylist()), np.int32)
            columns = [
                pa.array(np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), 1 + PROBES), len(part))),
                pa.array(own),
            ]
            if not bare:
                again = pa.array(np.repeat(np.arange(len(part)), times))
                columns += [column.take(again) for column in part.columns]
            yield pa.RecordBatch.from_arrays(columns, ["t", "cell", "node", "times", "vector", "cells"][: len(columns)])


def meets(homes_of: np.ndarray, cells_of: np.ndarray) -> np.ndarray:
    return (homes_of[:, None] == cells_of).any(axis=1)


def compared(batches, least: float, number: str):
    """Counts (a, null, n) and stars (a, b, 0) of the rows (t, cell, p, q, part, node, times, vector, cells)."""
    for table, bounds in whole_runs(batches, 4):
        t, cell, p, q, part, node, times = (table.column(i).to_numpy() for i in range(7))
        total = np.zeros(len(node), np.int64)
        labels = np.arange(len(node))
        vectors_of, cells_of = table.column(7).to_pylist(), table.column(8).to_pylist()
        for begin, end in zip(bounds, bounds[1:]):
            if end - begin < 2:
                continue
            own = np.frombuffer(b"".join(cells_of[begin:end]), np.int32).reshape(end - begin, TABLES, 1 + PROBES)
            units = unit(np.frombuffer(b"".join(vectors_of[begin:end]), number).reshape(end - begin, -1))
            ids, parts, turn, here = node[begin:end], part[begin:end], t[begin], cell[begin]
            home = own[:, turn, 0] == here
            for start in range(0, end - begin, 256):
                cosine = units[start : start + 256] @ units.T
                a, b = np.nonzero(cosine >= least)
                a += start
                fits = (a < b) & (home[a] | home[b]) & (ids[a] != ids[b])
                fits &= (parts[a] != parts[b]) | (p[begin] == q[begin])
                a, b = a[fits], b[fits]
                a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
                earlier = np.zeros(len(a), bool)
                for k in range(turn):
                    earlier |= meets(own[a, k, 0], own[b, k]) | meets(own[b, k, 0], own[a, k])
                chosen = np.where(meets(own[a, turn, 0], own[b, turn]), own[a, turn, 0], own[b, turn, 0])
                once = ~earlier & (chosen == here)
                a, b = a[once], b[once]
                np.add.at(total, begin + a, times[begin + b])
                np.add.at(total, begin + b, times[begin + a])
                labels = linked(len(node), begin + a, begin + b, labels)
        while not np.array_equal(labels, nxt := labels[labels]):
            labels = nxt
        counted, tied = np.flatnonzero(total), np.flatnonzero(labels != np.arange(len(labels)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([node[counted], node[labels[tied]]])),
                pa.array(np.concatenate([node[counted], node[tied]]), mask=np.arange(len(counted) + len(tied)) < len(counted)),
                pa.array(np.concatenate([total[counted], np.zeros(len(tied), np.int64)])),
            ],
            ["a", "b", "n"],
        )


def near_duplicates(
    spark: SparkSession, vectors: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """key, n_links (others linked directly), component_id (smallest key reachable) and kept (it is its own)."""
    staging = Staging(spark)
    kind = vectors.schema[vector].dataType.simpleString()
    kind, number = ("float", "f4") if kind == "array<float>" else ("double", "f8")
    rows = vectors.select(F.col(key).cast("long").alias("node"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    fine = F.coalesce(fine, F.lit(False)) & F.col("node").isNotNull()
    marked = rows.filter(fine).withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), "v")})
    named = staging(marked.select("node", "h", "g"), "vectors")
    nodes = marked.groupBy("h", "g").agg(F.min("node").alias("node"), F.count("*").alias("times"), F.first("v").alias("v"))
    nodes = staging(nodes, "nodes")
    plain = nodes.select("node", "times", "v").mapInArrow(celled, "node long, times long, vector binary, cells binary")
    plain = staging(plain, "cells")
    bare = plain.mapInArrow(partial(listed, bare=True), "t int, cell int")
    full = plain.mapInArrow(partial(listed, bare=False), "t int, cell int, node long, times long, vector binary, cells binary")
    parts = dealt(full, ["t", "cell"], "node", GROUP, staging, "large_cells", bare)
    order = together(parts.select("t", "cell", "p", "q", "part", "node", "times", "vector", "cells"), ["t", "cell", "p", "q"])
    found = staging(order.mapInArrow(partial(compared, least=least, number=number), "a long, b long, n long"), "found")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    reached = components(found.filter("b is not null"), staging, "reached")
    classes = staging(
        nodes.select("h", "g", "node", "times")
        .join(counts, "node", "left")
        .join(reached, "node", "left")
        .select(
            "h", "g", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ),
        "classes",
    )
    linked_rows = named.join(classes, ["h", "g"]).select("node", "n_links", "component_id")
    alone = rows.filter(~fine).select("node", F.lit(0).cast("long").alias("n_links"), F.col("node").alias("component_id"))
    out = linked_rows.unionByName(alone)
    kept = F.coalesce(F.col("node") == F.col("component_id"), F.lit(False))
    return out.select(F.col("node").alias(key), "n_links", "component_id", kept.alias("kept"))
