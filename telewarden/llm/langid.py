"""Language identification by mixture inference.

For each language the byte trigrams of words are counted, hashed to ``BUCKETS``, over all training
texts. A document is a mixture of languages: each word has a likelihood in every language, the
product of its trigrams' probabilities, and expectation-maximisation estimates the proportions. The
set of languages grows from the best single one, each time by the one that promises most, as long as
the log-likelihood gains more than the penalty for one more proportion.

A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was
learnt. Ties go to the language that comes first by name. Repeated rows get the same result, a row
each. An empty table gives an empty one. The model has one row of probabilities for each language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, held_out, map_text, runs, strings, sums

BUCKETS = 1 << 13
#: Added to each count.
SMOOTH = 0.5
ROUNDS = 8
#: Bytes of text whose likelihoods are held at once.
HELD_BYTES = 2 << 20
UNKNOWN = "und"


def letters() -> np.ndarray:
    """Small ASCII letters and bytes beyond ASCII as they are, capital letters as small ones, 0 for the rest."""
    out = np.zeros(256, np.uint32)
    out[128:] = np.arange(128, 256)
    for c in range(ord("a"), ord("z") + 1):
        out[c] = out[c - 32] = c
    return out


def trigrams(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the trigrams around each letter, the bounds of words among them, and of texts among the words."""
    data, bounds = flat(array)
    if not len(data):
        return np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros(len(bounds), np.int64)
    letter = letters()[data]
    starts, ends = runs((letter > 0).astype(np.uint8), bounds[:-1])
    before, after = np.zeros_like(letter), np.zeros_like(letter)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    before[starts], after[ends - 1] = 0, 0
    codes = (before << np.uint32(16)) | (letter << np.uint32(8)) | after
    places = ((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    sizes = np.concatenate([[0], np.cumsum(ends - starts)])
    return places[letter > 0], sizes, np.searchsorted(starts, bounds)


class Counts:
    """Trigram counts of a task's texts by language."""

    def __init__(self):
        self.table: dict[str, np.ndarray] = {}

    def __call__(self, batch):
        places, words, texts = trigrams(batch.column(1))
        bounds = words[texts]
        langs = batch.column(0).to_pylist()
        for lang in set(langs):
            own = np.repeat(np.array([x == lang for x in langs]), np.diff(bounds))
            self.table[lang] = self.table.get(lang, 0) + np.bincount(places[own], minlength=BUCKETS)
        return ()

    def last(self):
        for lang, counts in self.table.items():
            used = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


class Model:
    """Log-probabilities of the buckets by language."""

    def __init__(self, langs: list[str], logs: np.ndarray):
        self.langs, self.logs = langs, logs

    def mixtures(self, array: pa.Array) -> np.ndarray:
        """Proportions of the languages in each text; zeros where there are no words."""
        places, words, texts = trigrams(array)
        out = np.zeros((len(texts) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(texts))
        if not len(full):
            return out
        values = np.add.reduceat(self.logs[places], words[:-1], axis=0)
        top = values.max(axis=1, keepdims=True)
        likely = np.exp(values - top)
        bounds = np.append(texts[full], texts[-1])
        single = sums(values.astype(np.float64), bounds)
        best = single.argmax(axis=1)
        share = np.zeros((len(full), len(self.langs)))
        share[np.arange(len(full)), best] = 1
        base = sums(top[:, 0].astype(np.float64), bounds)
        reached = single.max(axis=1) - base
        active = np.arange(len(full))
        sizes = np.diff(bounds)
        for _ in range(len(self.langs) - 1):
            if not len(active):
                break
            rows = np.repeat(np.isin(np.arange(len(full)), active), sizes)
            own, cut = likely[rows], np.concatenate([[0], np.cumsum(sizes[active])])
            owner = np.repeat(np.arange(len(active)), sizes[active])
            trial = share[active]
            mix = np.maximum((own * trial[owner]).sum(axis=1), 1e-300)
            promise = np.where(trial > 0, -1, sums(own / mix[:, None], cut))
            added = promise.argmax(axis=1)
            trial = trial * 0.9
            trial[np.arange(len(active)), added] = 0.1
            for _ in range(ROUNDS):
                weight = own * trial[owner]
                weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-300)
                trial = sums(weight, cut) / sizes[active][:, None]
            gained = sums(np.log(np.maximum((own * trial[owner]).sum(axis=1), 1e-300)), cut)
            better = gained - reached[active] > 1 + np.log(np.maximum(sizes[active], 2))
            share[active[better]], reached[active[better]] = trial[better], gained[better]
            active = active[better]
        out[full] = share
        return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from all texts with a language that are not held out."""
    rows = docs.filter(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    table = map_text(rows, Counts, "lang string, bucket int, n long", ["lang", "text"], HELD_BYTES)
    table = table.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(table["lang"]))
    counts = np.full((BUCKETS, len(langs)), SMOOTH)
    order = {x: i for i, x in enumerate(langs)}
    counts[table["bucket"].to_numpy(np.int64), table["lang"].map(order).to_numpy(np.int64)] += table["n"].to_numpy(float)
    return Model(langs, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score (the proportion of that language) and langs, the selected set with proportions."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def work():
        own = shared.value

        def step(batch):
            texts = strings(batch.column(1))
            shares = own.mixtures(batch.column(1)) if own.langs else np.zeros((len(texts), 1))
            known = [bool(own.langs) and any(map(str.isalpha, t)) for t in texts]
            best = shares.argmax(axis=1)
            chosen = [own.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = [float(min(1.0, s.max())) if k else 0.0 for s, k in zip(shares, known)]
            sets = [[{"lang": own.langs[i], "share": float(s[i])} for i in np.flatnonzero(s)] if k else [] for s, k in zip(shares, known)]
            columns = [batch.column(0), pa.array(chosen, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(found))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "lang_pred", "score", "langs"])

        return step

    schema = f"key {kind}, lang_pred string, score double, langs array<struct<lang:string,share:double>>"
    return map_text(docs, work, schema, [key, text], HELD_BYTES).withColumnRenamed("key", key)
