"""SimHash near-duplicates: pigeonhole blocks of the fingerprint, then the Hamming distance.

A fingerprint is cut into ``BLOCKS`` runs of bits. Fingerprints that differ in at most ``distance``
bits agree in ``BLOCKS - distance`` whole runs, so every choice of that many runs is a table, and
close pairs share a key of about 32 bits in one of them. Equal fingerprints are one node first. The
nodes of a key are compared in numpy; what leaves a task is a star for each set of linked nodes, not
its pairs. Keys with many nodes are dealt to pairs of parts, so no task holds a whole one.

Null and empty texts have the fingerprint zero and are linked like any other. A row without doc_id
has no component and links with nothing. A doc_id names one text: rows that repeat it get the same
result, a row each; should it have several texts, their fingerprints may count as linked. An empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Staging
from .common import components, dealt, flat, linked, map_text, together, unused, whole_runs

#: Bits of the blocks of a 64-bit fingerprint.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Nodes of a key that are compared in one go; larger keys are dealt to pairs of parts.
GROUP = 2048
#: Hashes that are spread into bits at once.
SPREAD = 1 << 14
SEED = 42


def fingerprint(words: list[bytes], shingle: int, digest) -> int:
    """Majority of the bits of the hashes of all word shingles, repeats included."""
    if not words:
        return 0
    size = min(shingle, len(words))
    texts = map(b" ".join, zip(*(words[i:] for i in range(size))))
    hashes = np.fromiter(map(digest, texts, repeat(SEED)), np.uint64, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), SPREAD):
        part = hashes[start : start + SPREAD].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and fp, the fingerprint as a signed 64-bit number."""
    kind = docs.schema[key].dataType.simpleString()

    def work():
        from xxhash import xxh64_intdigest

        def step(batch):
            data, bounds = flat(batch.column(1))
            data, bounds = data.tobytes(), bounds.tolist()
            found = [fingerprint(data[a:b].lower().split(), shingle, xxh64_intdigest) for a, b in zip(bounds, bounds[1:])]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["key", "fp"])

        return step

    return map_text(docs, work, f"key {kind}, fp long", [key, text]).withColumnRenamed("key", key)


def masks(distance: int) -> list[int]:
    """Bits of each table's key, as signed numbers."""
    ends = np.cumsum(BLOCKS).tolist()
    blocks = [(1 << end) - (1 << (end - size)) for end, size in zip(ends, BLOCKS)]
    chosen = [sum(c) for c in combinations(blocks, len(BLOCKS) - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def close(batches, distance: int):
    """Stars of linked nodes among the rows (table, bits, p, q, part, node, fp) of each key and pair of parts."""
    for table, bounds in whole_runs(batches, 4):
        p, q, part, node, fp = (table.column(i).to_numpy() for i in range(2, 7))
        sizes = np.diff(bounds)
        labels = np.arange(len(fp))

        def link(a, b, labels):
            near = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= distance
            near &= (part[a] != part[b]) | (p[a] == q[a])
            return linked(len(fp), a[near], b[near], labels)

        end = np.repeat(bounds[1:], sizes)
        small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= 64), sizes))
        step = 1
        while len(small := small[small + step < end[small]]):
            labels = link(small, small + step, labels)
            step += 1
        for run in np.flatnonzero(sizes > 64):
            rows = np.arange(bounds[run], bounds[run + 1])
            for first in range(0, len(rows), 64):
                left = rows[first : first + 64]
                right = rows[first:]
                a, b = np.repeat(left, len(right)), np.tile(right, len(left))
                labels = link(a[a < b], b[a < b], labels)
        while not np.array_equal(labels, nxt := labels[labels]):
            labels = nxt
        out = np.flatnonzero(labels != np.arange(len(labels)))
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(node[labels[out]]), pa.array(node[out])], ["a", "b"])


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text",
    staging: Staging | None = None,
) -> DataFrame:
    """key, fp and component_id: the smallest key reachable over fingerprints at most ``distance`` bits apart."""
    staging = staging or Staging(spark)
    marked = staging(fingerprints(docs, shingle, key, text).withColumnRenamed(key, "node"), "fingerprints")
    nodes = staging(marked.filter("node is not null").groupBy("fp").agg(F.min("node").alias("node")), "nodes")
    tables = F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks(distance))))
    keyed = nodes.select(F.explode(tables).alias("at"), "node", "fp").select("at.t", "at.bits", "node", "fp")
    parts = dealt(keyed, ["t", "bits"], "fp", GROUP, staging, "large_keys")
    rows = together(parts.select("t", "bits", "p", "q", "part", "node", "fp"), ["t", "bits", "p", "q"])
    stars = staging(rows.mapInArrow(partial(close, distance=distance), "a long, b long"), "stars")
    reached = components(stars, staging, "reached")
    classes = staging(
        nodes.join(reached, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")), "classes"
    )
    return marked.join(classes, "fp", "left").select(
        F.col("node").alias(key), "fp", F.when(F.col("node").isNotNull(), F.col("component_id")).alias("component_id")
    )


def hexadecimal(fp: str = "fp"):
    """The fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one document for each component, the one whose key names it.

    Rows without key stay. Of rows that repeat a kept key one stays.
    """
    staging = Staging(spark)
    found = near_duplicates(spark, docs, shingle, distance, key, text, staging)
    name = unused(docs, "other_key")
    keys = found.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(name))
    keys = keys.agg(F.bool_or(F.col(key) == F.col("component_id")).alias("kept"), F.count("*").alias("times"))
    # What goes is usually the smaller part, and the texts stay where they are if Spark can broadcast it.
    other = staging(keys.filter("NOT kept OR times > 1"), "other")
    same = F.col(key) == F.col(name)
    single = docs.join(other.select(name), same, "left_anti")
    several = docs.join(other.filter("kept").select(name), same, "left_semi").dropDuplicates([key])
    return single.unionByName(several)
