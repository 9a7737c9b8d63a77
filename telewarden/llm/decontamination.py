"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and bytes beyond ASCII, with A-Z as a-z. Every run of ``SEED``
words of a benchmark item is a seed if it is rare, that is, if words as frequent as its own, counted
over all documents, would stand side by side by chance less than ``RARE`` times a word; each item's
``LEAST`` rarest runs are seeds in any case. Where a run is not rare, the shortest longer one that is
rare is a seed, so that seeds cover the places of items of frequent words too. Counting words and not runs keeps a passage rare that has
been copied into many documents. Runs of a document that may be seeds (a bitmap of fixed size says
so) make windows with as many words around them as the longest item has. Windows and items that
share a seed are joined by Spark and aligned by words.

A seed that more than ``SHARED`` items have, such as an instruction that stands in all questions, says
little of any of them. There the join asks for one word more, one of the item's telling words. Words
of an item inside an alignment that have no partner lower its score, so if the telling words, the
rarest ones that few items have, were all without, no stretch of the item could reach the score of a
match, even if all its other words had a partner. Items whose common words alone reach it are joined
by the seed as before. So the same pairs match, and pairs that share a common seed alone are not
aligned.

An item matches if the alignment scores ``SHARE`` of its words or ``LONG`` words, whichever is less,
but ``EVIDENCE`` words at least: a shorter item must stand in the document whole and unedited. Items of fewer than ``SEED`` words match nothing. Null texts are empty. Rows without doc_id or
item_id are left out of the result; rows that repeat an id count as one, with the best score. An
empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Staging
from .common import flat, map_text, mixed, run_hashes, runs, unused

SEED = 3
#: Items that share a seed, or a word, beyond which it is common.
SHARED = 8
RARE = 1e-6
LEAST = 8
SHARE = 0.5
LONG = 40
#: The least score of a match; a shorter item needs all its words.
EVIDENCE = 8
#: Alignment scores; a match is 1.
MISMATCH = -1.0
GAP = -1.0
#: Bits of the bitmap of words and of seeds: 128 KB and 2 MB.
WORD_BITS = 20
SEED_BITS = 24
#: The row that counts all words, and the word that stands for any.
ALL = 0
SLICE = 2 << 20


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and each byte with A-Z as a-z."""
    letter, low = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    letter[128:] = 1
    for c in range(128):
        letter[c] = chr(c).isalnum()
    low[65:91] += 32
    return letter, low


def words(array: pa.Array):
    """Hashes, begins and ends of the words of all texts, bounds of texts among the words and among the bytes, bytes."""
    data, bounds = flat(array)
    letter, low = tables()
    if not len(data):
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(bounds), np.int64), bounds, data
    data = low[data]
    starts, ends = runs(letter[data], bounds[:-1])
    return run_hashes(data, starts, ends), starts, ends, np.searchsorted(starts, bounds), bounds, data


def run_of(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of SEED words, and whether it lies inside one text."""
    n = max(len(hashes) - SEED + 1, 0)
    total = np.zeros(n, np.uint64)
    for i in range(SEED):
        total = total * np.uint64(1_000_003) + hashes[i : n + i]
    inside = np.ones(n, bool)
    for i in range(1, SEED):
        cut = bounds[1:-1] - i
        inside[cut[(cut >= 0) & (cut < n)]] = False
    return mixed(total), inside


def bitmap(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bits of the hashes of a column, combined by Spark; 2^bits of them."""
    bit = F.shiftrightunsigned(F.col(column), 64 - bits)
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    parts = rows.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("word"), one.alias("one"))
    table = parts.groupBy("word").agg(F.bit_or("one").alias("ones")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[table["word"].to_numpy(np.int64)] = table["ones"].to_numpy(np.int64)
    return out.view(np.uint64)


def marked(hashes: np.ndarray, bits_set: np.ndarray, bits: int) -> np.ndarray:
    at = hashes >> np.uint64(64 - bits)
    return (bits_set[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def power_sum(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words at each of the places, as ``run_of`` has it."""
    total = np.zeros(len(at), np.uint64)
    for i in range(size):
        total = total * np.uint64(1_000_003) + hashes[at + i]
    return mixed(total)


def item_words(items: DataFrame) -> DataFrame:
    """item, version (a hash of the words), n_words and the word hashes of each item with SEED words or more."""

    def work():
        def step(batch):
            hashes, _, _, texts, _, _ = words(batch.column(1))
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(texts, pa.int32()), pa.array(hashes.view(np.int64)))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "words"])

        return step

    kind = items.schema["item"].dataType.simpleString()
    found = map_text(items, work, f"item {kind}, words array<long>", ["item", "text"], SLICE)
    found = found.filter(F.size("words") >= SEED).select("item", F.xxhash64("words").alias("version"), F.size("words").alias("n_words"), "words")
    return found.dropDuplicates(["item", "version"])


def chosen(chances: np.ndarray) -> list[tuple[int, int]]:
    """Begin and size of the runs of an item that are seeds, from the logarithms of its words' frequencies."""
    n, bar = len(chances), math.log(RARE)
    total = np.concatenate([[0.0], np.cumsum(chances)])
    runs_of_seed = total[SEED:] - total[:-SEED]
    found = {(int(i), SEED) for i in np.argsort(runs_of_seed, kind="stable")[:LEAST]}
    reached = 0
    for begin in range(n - SEED + 1):
        # The sums fall from word to word, so the first that is low enough is found by bisection.
        end = max(begin + SEED, int(np.searchsorted(-total, -(total[begin] + bar))))
        if end <= n:
            found.add((begin, end - begin))
            reached = max(reached, end)
    if reached < n and total[n] <= bar:
        begin = min(n - SEED, int(np.searchsorted(-total, -(total[n] - bar), "right")) - 1)
        found.add((begin, n - begin))
    return sorted(found)


class Counts:
    """Counts of the marked words of a task's texts, and of all its words."""

    def __init__(self, bits_set: np.ndarray):
        self.bits_set, self.found, self.all = bits_set, [], 0

    def __call__(self, batch):
        hashes = words(batch.column(0))[0]
        self.all += len(hashes)
        self.found.append(np.unique(hashes[marked(hashes, self.bits_set, WORD_BITS)], return_counts=True))
        if len(self.found) >= 32:
            self.found = [self._joined()]
        return ()

    def _joined(self):
        if not self.found:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        keys, back = np.unique(np.concatenate([k for k, _ in self.found]), return_inverse=True)
        return keys, np.bincount(back, np.concatenate([n for _, n in self.found]), len(keys)).astype(np.int64)

    def last(self):
        keys, counts = self._joined()
        columns = [pa.array(np.append(keys.view(np.int64), ALL)), pa.array(np.append(counts, self.all))]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n"])


def least_score(n: Column) -> Column:
    """The score from which an item of n words matches."""
    return F.least(F.greatest(n * SHARE, F.least(n, F.lit(EVIDENCE))), F.lit(float(LONG)))


def most_without(item: np.ndarray, missing: np.ndarray) -> float:
    """The score that no alignment passes if these words of the item have no partner in the window."""
    worth = np.where(np.isin(item, missing), max(MISMATCH, GAP), 1.0)
    total = np.concatenate([[0.0], np.cumsum(worth)])
    return float((total - np.minimum.accumulate(total)).max())


def telling(batches):
    """item and word: one of these words stands in each window that the item matches; ``ALL`` if there is none such.

    Rows are item, words, logarithms of their frequencies, and how many items have each.
    """
    for batch in batches:
        items, found = [], []
        for i in range(len(batch)):
            own, chances, shared = (batch.column(k)[i].values.to_numpy() for k in (1, 2, 3))
            n = len(own)
            needed = math.ceil(min(max(n * SHARE, min(n, EVIDENCE)), LONG))
            special, first = np.unique(own[shared <= SHARED], return_index=True)
            special = special[np.argsort(chances[shared <= SHARED][first], kind="stable")]
            if most_without(own, special) >= needed:
                rare = np.array([ALL])
            else:
                enough = bisect_left(range(len(special)), True, key=lambda k: most_without(own, special[:k]) < needed)
                rare = special[:enough]
            items += [i] * len(rare)
            found.append(rare)
        words_of = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(items, pa.int64())), pa.array(words_of)], ["item", "word"])


def seeds(docs: DataFrame, every: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """run, size, prefix (its first SEED words as a run) and item of the rare runs of the items; item and telling words."""
    places = every.select("item", "version", F.posexplode("words").alias("place", "word"))
    vocabulary = staging(places.groupBy("word").agg(F.count_distinct("item").alias("items")), "vocabulary")
    bits_set = bitmap(vocabulary, "word", WORD_BITS)
    counted = map_text(docs, lambda: Counts(bits_set), "word long, n long", ["text"], SLICE)
    counted = staging(counted.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    total = (counted.filter(F.col("word") == ALL).agg(F.sum("n").alias("n")).first().n or 0) + 1
    known = vocabulary.join(counted, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"), "items")
    known = staging(known, "frequencies")
    chance = F.least(F.log((F.col("n") + 1) / F.lit(float(total))), F.lit(0.0))
    at = F.struct("place", "word", chance.alias("chance"), "items")
    rows = places.join(known, "word").groupBy("item", "version").agg(F.sort_array(F.collect_list(at)).alias("at"))
    rows = staging(rows.select("item", F.col("at.word").alias("words"), F.col("at.chance").alias("chances"), "at.items"), "item_rows")

    def run(batches):
        for batch in batches:
            items, found = [], []
            for i in range(len(batch)):
                own = batch.column(1)[i].values.to_numpy().view(np.uint64)
                for begin, size in chosen(batch.column(2)[i].values.to_numpy()):
                    at = np.array([begin])
                    items.append(i)
                    found.append((power_sum(own, at, size)[0], size, power_sum(own, at, SEED)[0]))
            of, size, prefix = (np.array([f[k] for f in found], t) for k, t in enumerate((np.uint64, np.int32, np.uint64)))
            columns = [pa.array(of.view(np.int64)), pa.array(size), pa.array(prefix.view(np.int64)), batch.column(0).take(pa.array(items, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["run", "size", "prefix", "item"])

    kind = every.schema["item"].dataType.simpleString()
    found = rows.select("item", "words", "chances").mapInArrow(run, f"run long, size int, prefix long, item {kind}")
    words_of = rows.select("item", "words", "chances", "items").mapInArrow(telling, f"item {kind}, word long")
    return staging(found.distinct(), "seeds"), words_of.distinct()


def candidates(found: DataFrame, rare: DataFrame, telling_words: DataFrame, staging: Staging) -> DataFrame:
    """doc, begin and item of windows and items that share a seed, and a telling word where the seed is common."""
    common = staging(rare.groupBy("run").agg(F.count("*").alias("n")).filter(F.col("n") > SHARED).select("run"), "common_seeds")
    held = staging(found.select("doc", "begin", F.explode("runs").alias("run")).distinct(), "held_seeds")
    own = held.join(rare.select("run", "item").join(common, "run", "left_anti"), "run").select("doc", "begin", "item")
    many = held.join(common, "run", "left_semi")
    kind = found.schema["doc"].dataType.simpleString()

    def work():
        def step(batch):
            hashes, _, _, texts, _, _ = words(batch.column(3))
            sizes = np.diff(texts)
            row = np.repeat(np.arange(len(batch)), sizes)
            # Each word of a window once, and the word that stands for any.
            pairs = np.unique(np.stack([row, hashes.view(np.int64)]), axis=1)
            row = np.concatenate([pairs[0], np.arange(len(batch))])
            word = np.concatenate([pairs[1], np.full(len(batch), ALL)])
            take = pa.array(row)
            columns = [batch.column(i).take(take) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(word)], ["doc", "begin", "run", "word"])

        return step

    texts = many.join(found.select("doc", "begin", "text"), ["doc", "begin"])
    at = map_text(texts, work, f"doc {kind}, begin long, run long, word long", ["doc", "begin", "run", "text"], SLICE)
    wanted = rare.select("run", "item").join(common, "run", "left_semi").join(telling_words, "item")
    return own.unionByName(at.join(staging(wanted, "wanted"), ["run", "word"]).select("doc", "begin", "item")).distinct()


def windows(docs: DataFrame, prefixes: np.ndarray, bits_set: np.ndarray, sizes: list[int], around: int) -> DataFrame:
    """doc, begin (its first word), text and the runs of each window around runs that may be seeds.

    Runs of all sizes are looked up where their first SEED words may begin a seed.
    """
    kind = docs.schema["doc"].dataType.simpleString()

    def work():
        def step(batch):
            hashes, starts, ends, texts, _, data = words(batch.column(1))
            found, inside = run_of(hashes, texts)
            open_ = np.flatnonzero(inside & marked(found, prefixes, SEED_BITS)) if len(found) else np.empty(0, np.int64)
            if not len(open_):
                return
            room = texts[np.searchsorted(texts, open_, "right")] - open_
            at, of = [], []
            for size in sizes:
                own = open_[room >= size]
                hashed = found[own] if size == SEED else power_sum(hashes, own, size)
                known = marked(hashed, bits_set, SEED_BITS)
                at.append(own[known])
                of.append(hashed[known])
            at, of = np.concatenate(at), np.concatenate(of)
            if not len(at):
                return
            order = np.argsort(at, kind="stable")
            at, of = at[order], of[order]
            owner = np.searchsorted(texts, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (np.diff(at) > 2 * around)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            begin = np.maximum(at[first] - around, texts[owner[first]])
            end = np.minimum(at[last] + SEED + around, texts[owner[first] + 1])
            cut = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[begin], ends[end - 1])]
            columns = [batch.column(0).take(pa.array(owner[first])), pa.array((begin - texts[owner[first]]).astype(np.int64))]
            bounds = np.append(first, len(at)).astype(np.int32)
            columns += [pa.array(cut, pa.string()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(of.view(np.int64)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "begin", "text", "runs"])

        return step

    return map_text(docs, work, f"doc {kind}, begin long, text string, runs array<long>", ["doc", "text"], SLICE)


def aligned(item: np.ndarray, window: np.ndarray) -> tuple[float, int]:
    """Best local alignment score, and where in the window it ends."""
    steps = -GAP * np.arange(1, len(window) + 1)
    row, best, place = np.zeros(len(window) + 1), 0.0, 0
    for word in item:
        step = np.maximum(row[:-1] + np.where(window == word, 1.0, MISMATCH), row[1:] + GAP)
        step = np.maximum(step, 0)
        row[1:] = np.maximum(np.maximum.accumulate(step + steps) - steps, 0)
        top = int(row.argmax())
        if row[top] > best:
            best, place = float(row[top]), top
    return best, place


def scored(pairs: DataFrame) -> DataFrame:
    """score, n_words of the item and end (the word after the match) of each pair of window and item."""
    names = ["doc", "item", "begin", "window", "text"]
    kinds = {n: pairs.schema[n].dataType.simpleString() for n in names}

    def work():
        def step(batch):
            own, _, _, of_items, _, _ = words(batch.column(4))
            other, _, _, of_windows, _, _ = words(batch.column(3))
            begin = batch.column(2).to_numpy()
            found = [
                (*aligned(own[of_items[i] : of_items[i + 1]], other[of_windows[i] : of_windows[i + 1]]), of_items[i + 1] - of_items[i])
                for i in range(len(batch))
            ]
            score, place, size = (np.array(x) for x in zip(*found)) if found else ([], [], [])
            columns = [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(size, pa.int64())]
            columns.append(pa.array(begin + np.array(place, np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "item", "score", "n_words", "end"])

        return step

    schema = f"doc {kinds['doc']}, item {kinds['item']}, score double, n_words long, end long"
    return map_text(pairs, work, schema, names, SLICE)


def matches(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, score (aligned words less edits), item_words and end_word of each match."""
    staging = Staging(spark)
    docs = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).filter("doc is not null")
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).filter("item is not null")
    every = staging(item_words(items), "item_words")
    longest = every.agg(F.max("n_words").alias("n")).first().n or 0
    rare, telling_words = seeds(docs, every, staging)
    sizes = sorted(r.size for r in rare.select("size").distinct().collect())
    bits = [bitmap(rare, column, SEED_BITS) for column in ("prefix", "run")]
    found = staging(windows(docs, *bits, sizes, longest), "windows") if sizes else staging(docs.limit(0).selectExpr("doc", "0L begin", "text", "array(0L) runs"), "windows")
    shared = candidates(found, rare, telling_words, staging)
    pairs = shared.join(found.select("doc", "begin", F.col("text").alias("window")), ["doc", "begin"]).join(items, "item")
    good = scored(pairs).filter((F.col("n_words") >= SEED) & (F.col("score") >= least_score(F.col("n_words"))))
    best = good.groupBy("doc", "item").agg(F.max(F.struct("score", "n_words", "end")).alias("best"))
    return best.select(
        F.col("doc").alias(key), F.col("item").alias(item), "best.score",
        F.col("best.n_words").alias("item_words"), F.col("best.end").alias("end_word"),
    )


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the documents that match no benchmark item; rows without key stay."""
    name = unused(docs, "matched_key")
    bad = matches(spark, docs, benchmark, key, text).select(F.col(key).alias(name)).distinct()
    return docs.join(Staging(spark)(bad, "matched"), F.col(key) == F.col(name), "left_anti")
