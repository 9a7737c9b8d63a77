"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Words are runs of letters and digits or runs of other signs, hashed to ``BUCKETS``. Every bucket has
a sparse random index vector. A word's vector is the sum of the index vectors of its neighbours in
all documents, scaled to length one. A document is the mean and the spread of its word vectors and
the mean likeness of neighbouring ones. A two-layer network in numpy learns the labels from at most ``TRAIN_ROWS`` labelled documents, those
with the smallest hashes of their ids; a tenth of them is kept back to fit the temperature that
calibrates its probabilities.

Null and empty texts pool to zeros and get the network's score for those. With fewer than two
labelled rows, or one label only, the score is the smoothed share of label 1. Repeated rows get the
same score, a row each; rows that repeat a label count once, with the larger label. An empty table
gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Staging
from .common import flat, held_out, map_text, mixed, run_hashes, runs, slices, sums

BUCKETS = 1 << 13
DIMENSIONS = 32
#: Non-zero entries of an index vector.
ENTRIES = 2
#: Most labelled rows that the network learns from.
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.3
#: Bytes of text whose word vectors are held at once.
POOLED_BYTES = 2 << 20
SEED = 7


def classes() -> np.ndarray:
    """0 for white space, 1 for letters, digits and bytes beyond ASCII, 2 for other signs."""
    out = np.full(256, 2, np.uint8)
    out[128:] = 1
    for c in range(128):
        if chr(c).isalnum():
            out[c] = 1
        elif chr(c).isspace():
            out[c] = 0
    return out


def buckets(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word of all texts, and the bounds of each text among them."""
    data, bounds = flat(array)
    starts, ends = runs(classes()[data], bounds[:-1]) if len(data) else (np.empty(0, np.int64),) * 2
    found = (run_hashes(data, starts, ends) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    return found, np.searchsorted(starts, bounds)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    h = mixed(np.arange(1, BUCKETS * ENTRIES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    places = (h % np.uint64(DIMENSIONS)).astype(np.int64).reshape(BUCKETS, ENTRIES)
    signs = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0).reshape(BUCKETS, ENTRIES)
    return places, signs


class Neighbours:
    """Sums the index vectors of the neighbours of each word of a task's texts."""

    def __init__(self):
        self.places, self.signs = index_vectors()
        self.total = np.zeros(BUCKETS * DIMENSIONS)

    def __call__(self, batch):
        words, bounds = buckets(batch.column(0))
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        near = owner[1:] == owner[:-1]
        left, right = words[:-1][near], words[1:][near]
        for word, other in ((left, right), (right, left)):
            for entry in range(ENTRIES):
                at = word * DIMENSIONS + self.places[other, entry]
                self.total += np.bincount(at, self.signs[other, entry], BUCKETS * DIMENSIONS)
        return ()

    def last(self):
        table = self.total.reshape(BUCKETS, DIMENSIONS).astype(np.int64)
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *(pa.array(table[used, i]) for i in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *(f"v{i}" for i in range(DIMENSIONS))])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Vectors of all buckets, learnt from all texts; of fixed size."""
    names = [f"v{i}" for i in range(DIMENSIONS)]
    schema = "bucket int, " + ", ".join(f"{n} long" for n in names)
    partial = map_text(docs, Neighbours, schema, [text])
    total = partial.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    out = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    values = total[names].to_numpy(np.float64)
    norms = np.linalg.norm(values, axis=1, keepdims=True)
    out[total["bucket"].to_numpy(np.int64)] = values / np.where(norms > 0, norms, 1)
    return out


def pooled(vectors: np.ndarray, array: pa.Array) -> np.ndarray:
    """Mean and spread of the word vectors of each text, and how alike neighbouring words are."""
    words, bounds = buckets(array)
    own = vectors[words]
    alike = np.zeros((len(words), 2), np.float32)
    alike[1:, 0] = (own[1:] * own[:-1]).sum(axis=1)
    alike[1:, 1] = words[1:] == words[:-1]
    alike[bounds[:-1][np.diff(bounds) > 0]] = 0  # first words have no neighbour before them
    count = np.maximum(np.diff(bounds), 1)[:, None]
    mean = sums(own, bounds) / count
    square = sums(own * own, bounds) / count
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, spread, sums(alike, bounds) / count], axis=1).astype(np.float64)


class Network:
    """Two layers with a temperature; inputs are standardised."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.mean) / self.scale
        back = random.random(len(y)) < 0.1
        if len(set(y[~back])) < 2 or len(set(y[back])) < 2:
            back[:] = False
        z_fit, y_fit = z[~back], y[~back].astype(float)
        self.layers = [
            random.standard_normal((z.shape[1], HIDDEN)) / np.sqrt(z.shape[1]), np.zeros(HIDDEN),
            random.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1),
        ]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.layers]
        turn = 0
        for _ in range(EPOCHS):
            order = random.permutation(len(y_fit))
            for start in range(0, len(order), 128):
                turn += 1
                rows = order[start : start + 128]
                for i, slope in enumerate(self._slopes(z_fit[rows], y_fit[rows])):
                    first, second = moments[i]
                    first += 0.1 * (slope - first)
                    second += 0.001 * (slope * slope - second)
                    rate = 0.003 * np.sqrt(1 - 0.999**turn) / (1 - 0.9**turn)
                    self.layers[i] = self.layers[i] - rate * first / (np.sqrt(second) + 1e-8)
        self.temperature = 1.0
        kept = back if back.any() else ~back
        logits, truth = self._logits(z[kept]), y[kept].astype(float)
        tried = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in tried]
        self.temperature = float(tried[int(np.argmin(loss))])

    def _logits(self, z):
        a, b, c, d = self.layers
        return np.tanh(z @ a + b) @ c + d[0]

    def _slopes(self, z, y):
        a, b, c, d = self.layers
        hidden = np.tanh(z @ a + b)
        error = (1 / (1 + np.exp(-np.clip(hidden @ c + d[0], -40, 40))) - y) / len(y)
        inner = np.outer(error, c) * (1 - hidden * hidden)
        return z.T @ inner + 1e-4 * a, inner.sum(axis=0), hidden.T @ error + 1e-4 * c, np.array([error.sum()])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        logits = self._logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


class Constant:
    """The smoothed share of label 1, where there is too little to learn from."""

    def __init__(self, y: np.ndarray):
        self.share = (float(y.sum()) + 1) / (len(y) + 2)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


class Model:
    """Word vectors and network; about a megabyte."""

    def __init__(self, vectors: np.ndarray, network):
        self.vectors, self.network = vectors, network

    def score(self, array: pa.Array) -> np.ndarray:
        return self.network(pooled(self.vectors, array))


def fit(spark, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from the labelled documents that are not held out."""
    staging = Staging(spark)
    vectors = word_vectors(docs, text)
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).dropna()
    rows = rows.filter(~held_out("key")).groupBy("key").agg(F.max("label").alias("label"))
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.join(docs.select("key").distinct(), "key", "left_semi").orderBy(F.xxhash64("key"), "key").limit(TRAIN_ROWS)
    rows = staging(rows, "train")
    chosen = docs.join(F.broadcast(rows), "key")  # at most TRAIN_ROWS numbers

    def work():
        def step(batch):
            x = pooled(vectors, batch.column(2)).astype(np.float32)
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], ["key", "label", "x"])

        return step

    kind = docs.schema["key"].dataType.simpleString()
    features = map_text(chosen, work, f"key {kind}, label int, x array<float>", ["key", "label", "text"], POOLED_BYTES)
    table = features.dropDuplicates(["key"]).toPandas().sort_values("key")
    y = table["label"].to_numpy(np.int64)
    if len(set(y)) < 2:
        return Model(vectors, Constant(y))
    return Model(vectors, Network(np.stack(table["x"].to_numpy()).astype(float), y))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of each row."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        own = shared.value

        def step(batch):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.score(batch.column(1)))], ["key", "score"])

        return step

    return map_text(docs, work, f"key {kind}, score double", [key, text], POOLED_BYTES).withColumnRenamed("key", key)


def accepted(docs: DataFrame, model: Model, least: float = THRESHOLD, text: str = "text") -> DataFrame:
    """All columns of the rows whose score reaches ``least``."""
    shared, place, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text), docs.columns

    def run(batches):
        for batch in slices(batches, place, POOLED_BYTES):
            good = shared.value.score(batch.column(place)) >= least
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns], names)

    return docs.mapInArrow(run, docs.schema)
