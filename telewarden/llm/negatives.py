"""Hard-negative mining by Fagin's threshold algorithm.

Vectors become whole numbers, so scores (inner products) are exact. Every block of candidates has a
list per dimension, sorted by that dimension. For an anchor each list is read from the end that its
sign asks for: candidates met there for the first time are scored in full by random access. The score
that a candidate at the place reached in all lists would have is the threshold: nothing unread scores
higher. Reading stops once the threshold lies strictly below the k-th score of every window of scores
asked for, or below the window itself. What an earlier block has found counts in the next one, so
later blocks stop sooner.

Two searches of that kind follow each other: an anchor's best rows of its own label are its positives,
and each positive's score spans the window in which the best rows of other labels are sought. Anchors
and candidates are dealt to blocks, and every block of anchors meets every block of candidates; a
block holds ``CELLS`` numbers at most, or one row.

Rows without key, label or vector, or with a null or non-finite number in it, take no part, and nor do
rows with numbers so large that a score would not fit 64 bits. Vectors of different length don't
meet. Rows that repeat a key count once, with the least label and vector. Equal scores are ordered by
key. An empty table, or one without anchors, gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Staging

#: A vector's numbers are multiplied by this and rounded down.
SCALE = 256
#: Best rows of the same label, and of other labels for each of them.
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (30, 90)
#: Numbers of a block.
CELLS = 1 << 18
#: Places of the sorted lists that are read at first; each further step reads as many as all before.
STEP = 16
#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


class Block:
    """Candidates with their numbers and sorted lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray):
        # Ties of scores go to the smaller key, so rows are kept in order of keys.
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.numbers = ids[order], labels[order], numbers[order]
        #: For each dimension the rows from the largest number to the smallest.
        self.lists = np.argsort(-self.numbers, axis=0, kind="stable").T.astype(np.int32)
        self.floats = self.numbers.astype(float)
        self.largest = int(np.abs(self.numbers).max(initial=0))

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products, by double precision where that is exact."""
        if self.largest * int(np.abs(anchor).sum()) < EXACT:
            return (self.floats[rows] @ anchor.astype(float)).astype(np.int64)
        return self.numbers[rows] @ anchor


class Best:
    """The best rows of each of an anchor's windows so far: scores falling, then keys rising."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        # An empty window is settled from the start.
        self.low, self.high, self.k = np.where(low <= high, low, HIGHEST), high, k
        self.scores = [np.empty(0, np.int64)] * len(low)
        self.ids = [np.empty(0, np.int64)] * len(low)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w in range(len(self.low)):
            bar = self.bar(w)
            fits = (scores >= bar) & (scores <= self.high[w])
            if fits.any():
                all_scores = np.concatenate([self.scores[w], scores[fits]])
                all_ids = np.concatenate([self.ids[w], ids[fits]])
                order = np.lexsort((all_ids, -all_scores))[: self.k]
                self.scores[w], self.ids[w] = all_scores[order], all_ids[order]

    def bar(self, w: int) -> int:
        """A candidate with a lower score changes nothing."""
        return int(self.scores[w][-1]) if len(self.scores[w]) == self.k else int(self.low[w])

    def settled(self, threshold: int) -> bool:
        """Nothing that scores the threshold or less can enter a window."""
        return all(threshold < self.bar(w) for w in range(len(self.low)))


def search(block: Block, key: int, label: int, anchor: np.ndarray, best: Best, same: bool) -> None:
    """The threshold algorithm for one anchor in one block."""
    size = len(block.ids)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    used = np.concatenate([up, down])
    weights = anchor[used].tolist()
    unread = np.ones(size, bool)
    done = 0
    while done < size:
        # With no list to read, all scores are zero and all rows are read at once.
        end = min(size, 2 * done if done else STEP) if len(used) else size
        met = np.zeros(size, bool) if len(used) else unread.copy()
        # Lists are read from the front where the anchor's number is positive, else from the back.
        met[block.lists[up, done:end]] = True
        met[block.lists[down, size - end : size - done]] = True
        new = np.flatnonzero(met & unread)
        unread[new] = False
        good = new[((block.labels[new] == label) == same) & (block.ids[new] != key)]
        if len(good):
            best.add(block.scores(good, anchor), block.ids[good])
        done = end
        reached = block.numbers[np.concatenate([block.lists[up, done - 1], block.lists[down, size - done]]), used]
        # Python's numbers, as the sum may pass 64 bits although no row's score does.
        if best.settled(sum(map(int.__mul__, weights, reached.tolist()))):
            return


def numbers_of(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), size).astype(np.int64)


def searched(batches, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Best rows (anchor, window, id, score) of each group of sorted rows (size, part, of, kind, id, label, numbers, low, high).

    Within a group anchors (kind 0) come before candidates (kind 1).
    """
    here, anchors = None, []

    def found():
        columns = [[], [], [], []]
        for key, *_, best in anchors:
            for w, (scores, ids) in enumerate(zip(best.scores, best.ids)):
                columns[0] += [key] * len(ids)
                columns[1] += [w] * len(ids)
                columns[2] += ids.tolist()
                columns[3] += scores.tolist()
        if columns[0]:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["anchor", "window", "id", "score"])

    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
        starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if len(batch) else []
        for start, end in zip(starts, [*starts[1:], len(batch)]):
            size, *group, kind = keys[:, start].tolist()
            if here != (size, *group):
                yield from found()
                here, anchors = (size, *group), []
            run = batch.slice(start, end - start)
            ids, labels = (run.column(i).to_numpy() for i in (4, 5))
            if kind == 0:
                own = numbers_of(run.column(6), size)
                for i in range(len(run)):
                    low, high = (run.column(c)[i].values.to_numpy() for c in (7, 8))
                    anchors.append((int(ids[i]), int(labels[i]), own[i], Best(low, high, k)))
            elif anchors:
                most = max(1, CELLS // max(size, 1))
                for begin in range(0, len(run), most):
                    part = slice(begin, begin + most)
                    numbers = numbers_of(run.column(6).slice(begin, most), size)
                    if same:
                        blocks = {x: Block(ids[part][m], labels[part][m], numbers[m]) for x in {a[1] for a in anchors} if (m := labels[part] == x).any()}
                    else:
                        whole = Block(ids[part], labels[part], numbers)
                    for key, label, anchor, best in anchors:
                        block = blocks.get(label) if same else whole
                        if block is not None:
                            search(block, key, label, anchor, best, same)
    yield from found()


def best_rows(rows: DataFrame, anchors: DataFrame, sizes: DataFrame, k: int, same: bool) -> DataFrame:
    """anchor, window, rank, id and score: the k best rows of each window of each anchor.

    ``sizes`` has for each length of vectors the number of parts of candidates and of blocks of anchors.
    """
    names = ["size", "part", "of", "kind", "id", "label", "numbers", "low", "high"]
    bounds = "array<long>"

    def dealt(df: DataFrame, kind: int, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        df = df.join(F.broadcast(sizes), "size").withColumn("kind", F.lit(kind))
        df = df.withColumn(own, F.pmod(F.xxhash64("id"), F.col(own_parts)).cast("int"))
        df = df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)))
        return df.select(*names)

    plain = rows.withColumns({"low": F.lit(None).cast(bounds), "high": F.lit(None).cast(bounds)})
    both = dealt(anchors, 0, "of", "blocks", "part", "parts").unionByName(dealt(plain, 1, "part", "parts", "of", "blocks"))
    both = both.repartition("size", "part", "of").sortWithinPartitions("size", "part", "of", "kind")
    found = both.mapInArrow(partial(searched, k=k, same=same), "anchor long, window int, id long, score long")
    by = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def usable(rows: DataFrame, key: str, label: Column, vector: str) -> DataFrame:
    """id, label, size and numbers (whole, as bytes) of the rows that take part, one for each key."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Squares of the largest numbers, summed over the vector, must fit 64 bits.
    small = F.forall(vector, lambda x: (F.abs(x.cast("double")) * SCALE + 1) * F.sqrt(F.greatest(F.size(vector), F.lit(1))) < 2.0**31)
    out = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.when(fine & small, scaled).alias("numbers"))
    out = out.filter("id is not null and label is not null and numbers is not null")
    return out.groupBy("id").agg(F.min(F.struct("label", "numbers")).alias("row")).select("id", "row.label", "row.numbers")


def packed_numbers(batches):
    """Numbers as bytes, four for each; those of ``usable`` fit."""
    for batch in batches:
        values = [np.asarray(x, np.int32).tobytes() for x in batch.column(2).to_pylist()]
        sizes = pa.array([len(v) // 4 for v in values], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], sizes, pa.array(values, pa.binary())], ["id", "label", "size", "numbers"])


def hard_negatives(
    spark: SparkSession, vectors: DataFrame, anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of each mined negative.

    ``anchor`` says of a key whether it is one; ``label`` is an expression of the table's columns.
    """
    staging = Staging(spark)
    rows = usable(vectors, key, label, vector).mapInArrow(packed_numbers, "id long, label long, size int, numbers binary")
    rows = staging(rows, "rows")
    anchors = rows.withColumnRenamed("id", key).filter(anchor).withColumnRenamed(key, "id")
    of_size = F.greatest(F.col("size"), F.lit(1)) / F.lit(float(CELLS))

    def count(which, name):
        return F.greatest(F.ceil(F.count(which) * F.first(of_size)), F.lit(1)).cast("int").alias(name)

    own = rows.withColumnRenamed("id", key).withColumn("own", F.when(anchor, 1))
    per_size = own.groupBy("size").agg(count("own", "blocks"), F.greatest(F.ceil(F.count("*") * F.first(of_size)), F.lit(1)).alias("cells"))
    # So many parts that there are as many pairs of blocks to work on as blocks of candidates.
    sizes = staging(per_size.select("size", "blocks", F.ceil(F.col("cells") / F.col("blocks")).cast("int").alias("parts")), "sizes")

    def windows(low: Column, high: Column) -> dict[str, Column]:
        return {"low": low.cast("array<long>"), "high": high.cast("array<long>")}

    whole = windows(F.array(F.lit(LOWEST)), F.array(F.lit(HIGHEST)))
    positives = staging(best_rows(rows, anchors.withColumns(whole), sizes, POSITIVES, True), "positives")
    spans = positives.groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("at"))
    # The least and the greatest whole score whose hundredfold lies between the bounds.
    low = F.transform("at.score", lambda s: F.ceil(s.cast("decimal(20,0)") * WINDOW[0] / 100))
    high = F.transform("at.score", lambda s: F.floor(s.cast("decimal(20,0)") * WINDOW[1] / 100))
    asked = anchors.join(spans.withColumns(windows(low, high)).drop("at"), "id")
    negatives = best_rows(rows, asked, sizes, NEGATIVES, False)
    named = positives.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    return negatives.join(named, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
