"""Byte-level BPE: batched merge rounds over flat arrays, and the way back.

Texts are cut before spaces that follow other than white space, where no piece of the split pattern
can cross. Distinct chunks are numbered; only chunks not met before are split and merged. All their
symbols lie in one array. A round looks up every neighbouring pair by binary search in the sorted
pair keys, takes each word's lowest rank and merges it throughout the word. Words of more than
``LONG`` bytes would need many rounds over all their symbols; theirs are linked, a round merges the
lowest rank there is in all of them, and only pairs that have changed are looked up again.

Null text is empty text: no ids, and the empty text comes back. Strings of added tokens become
their ids. Repeated rows, ties and extra columns pass unchanged; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, gather, lists, map_text, strings

#: Fixed: the split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks remembered by a Python worker; beyond it the memory starts anew, ids stay the same.
REMEMBERED = 300_000
NONE = np.iinfo(np.int32).max
#: Bytes of a word that is merged with others of its kind by links; ids are the same.
LONG = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tables of a vocabulary file: byte ids, sorted pair keys with rank and result, token bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            raw = file.read()
        self.digest = hashlib.sha256(raw).hexdigest()
        model = json.loads(raw)
        ids = model["model"]["vocab"]
        self.added = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.size = max([*ids.values(), *self.added.values()]) + 1
        letters = byte_letters()
        value = {c: b for b, c in enumerate(letters)}
        self.byte_ids = np.array([ids[c] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.results = np.array([ids[a + b] for a, b in pairs], np.int64)
        content = [b""] * self.size
        for token, i in ids.items():
            content[i] = bytes(value[c] for c in token)
        for token, i in self.added.items():
            content[i] = token.encode()
        self.lengths = np.array([len(c) for c in content], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(content), np.uint8)


class Numbers(dict):
    """Gives each key the next number when it is first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Chunks:
    """Numbers the chunks of texts. A chunk without its leading space is a plain key; one that has none is (chunk,)."""

    gap = re.compile(r"\s ")

    def __init__(self, added: dict[str, int]):
        import regex

        self.number = Numbers()
        self.split = regex.compile(PATTERN).findall
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.names = tuple(added)

    def keys(self, text: str) -> list:
        if any(name in text for name in self.names):
            out = []
            for i, part in enumerate(self.added.split(text)):
                out += [(part, True)] if i % 2 else self.plain(part)
            return out
        return self.plain(text)

    def plain(self, text: str) -> list:
        if self.gap.search(text):
            return [w[1:] if w[0] == " " else (w,) for w in self.split(text)]
        out = text.split(" ")
        out[0] = (out[0],)
        return out

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunk numbers of all texts, and the bounds of each text among them."""
        get, keys, parts = self.number.__getitem__, self.keys, []
        for text in texts:
            own = keys(text)
            parts.append(np.fromiter(map(get, own), np.int32, len(own)))
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        return np.concatenate([*parts, np.empty(0, np.int32)]), bounds

    def words(self, start: int) -> tuple[list[list[str]], dict[int, str]]:
        """Pieces of the pattern of the chunks numbered from ``start``; added tokens by number."""
        out, special = [], {}
        for n, key in enumerate(islice(self.number, start, None)):
            if type(key) is str:
                out.append([" " + key] if key.isalpha() else self.split(" " + key))
            elif len(key) == 2:
                special[n] = key[0]
                out.append([])
            else:
                out.append(self.split(key[0]))
        return out, special


def pair_ranks(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs of symbols, found in the sorted keys; ``NONE`` where no pair merges."""
    if not len(vocabulary.keys):
        return np.full(len(left), NONE, np.int32)
    pair = left * vocabulary.size + right
    place = np.minimum(np.searchsorted(vocabulary.keys, pair), len(vocabulary.keys) - 1)
    return np.where(vocabulary.keys[place] == pair, vocabulary.ranks[place], NONE).astype(np.int32)


def merge_linked(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Like ``merge``; each round takes the places of one rank from a queue and follows links to their neighbours."""
    lengths = np.array([len(w) for w in words], np.int64)
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    edge = np.flatnonzero(np.diff(owner)) + 1
    after[edge - 1], before[edge] = -1, -1
    after[-1:] = -1
    ranks = np.full(n, NONE, np.int32)
    alive = np.ones(n, bool)
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def look_up(at: np.ndarray) -> None:
        ranks[at] = NONE
        at = at[after[at] >= 0]
        ranks[at] = pair_ranks(vocabulary, symbols[at], symbols[after[at]])
        at = at[ranks[at] < NONE]
        own = ranks[at]
        order = np.argsort(own, kind="stable")
        at, own = at[order], own[order]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        for rank, part in zip(own[starts].tolist(), np.split(at, starts[1:])):
            if rank not in waiting:
                waiting[rank] = []
                heappush(queue, rank)
            waiting[rank].append(part)

    look_up(np.arange(n))
    while queue:
        rank = heappop(queue)
        at = np.unique(np.concatenate(waiting.pop(rank)))
        at = at[alive[at] & (ranks[at] == rank)]
        if not len(at):
            continue
        new_run = np.ones(len(at), bool)  # in runs like aaa every other pair merges, from the left
        new_run[1:] = after[at[:-1]] != at[1:]
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        gone = after[at]
        far = after[gone]
        symbols[at] = vocabulary.results[rank]
        alive[gone] = False
        after[at] = far
        before[far[far >= 0]] = at[far >= 0]
        left = before[at]
        look_up(np.unique(np.concatenate([at, left[left >= 0]])))
    return symbols[alive].astype(np.int32), np.bincount(owner[alive], minlength=len(words))


def merge(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and the number of ids of each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    long = np.flatnonzero(lengths > LONG)
    if len(long):
        ids, sizes = merge_linked(vocabulary, [words[i] for i in long])
        short = np.flatnonzero(lengths <= LONG)
        rest, rest_sizes = merge(vocabulary, [words[i] for i in short])
        counts = np.empty(len(words), np.int64)
        counts[long], counts[short] = sizes, rest_sizes
        starts = np.empty(len(words), np.int64)
        starts[long] = np.cumsum(sizes) - sizes
        starts[short] = len(ids) + np.cumsum(rest_sizes) - rest_sizes
        return np.concatenate([ids, rest])[gather(starts, counts)], counts
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    done_symbols, done_owner = [], []
    while len(symbols):
        ranks = np.full(len(symbols), NONE, np.int32)
        inside = owner[1:] == owner[:-1]
        ranks[:-1][inside] = pair_ranks(vocabulary, symbols[:-1], symbols[1:])[inside]
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        lowest = np.minimum.reduceat(ranks, begins)
        sizes = np.diff(begins, append=len(owner))
        lowest = np.repeat(lowest, sizes)
        open_ = lowest < NONE
        if not open_.all():
            done_symbols.append(symbols[~open_])
            done_owner.append(owner[~open_])
            symbols, owner, ranks, lowest = symbols[open_], owner[open_], ranks[open_], lowest[open_]
        at = np.flatnonzero(ranks == lowest)
        if not len(at):
            break
        new_run = np.diff(at, prepend=-2) != 1  # in runs like aaa every other pair merges, from the left
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        symbols[at] = vocabulary.results[lowest[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    if not done_symbols:
        return np.empty(0, np.int32), np.zeros(len(words), np.int64)
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return symbols[order].astype(np.int32), np.bincount(owner, minlength=len(words))


class Encoder:
    """Texts to ids and back, remembering the ids of chunks."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.chunks = vocabulary, Chunks(vocabulary.added)
        self._forget()

    def _forget(self):
        self.chunks.number.clear()
        self.ids, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self):
        known = len(self.lengths)
        if known == len(self.chunks.number):
            return
        pieces, special = self.chunks.words(known)
        counts = np.array([len(p) for p in pieces])
        distinct = Numbers()
        which = np.array([distinct[w] for p in pieces for w in p], np.int64)
        ids, sizes = merge(self.vocabulary, [w.encode() for w in distinct])
        starts = np.cumsum(sizes) - sizes
        own = ids[gather(starts[which], sizes[which])]
        total = np.concatenate([[0], np.cumsum(sizes[which])])
        ends = np.cumsum(counts)
        lengths = total[ends] - total[ends - counts]
        if special:
            at = np.fromiter(special, np.int64, len(special))
            lengths[at] = 1
            before = np.cumsum(lengths) - lengths
            spread = np.empty(int(lengths.sum()), np.int32)
            normal = np.ones(len(spread), bool)
            normal[before[at]] = False
            spread[normal] = own
            spread[before[at]] = [self.vocabulary.added[t] for t in special.values()]
            own = spread
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, own])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the bounds of each text among them."""
        if len(self.lengths) > REMEMBERED:
            self._forget()
        numbers, bounds = self.chunks.numbers(texts)
        self._learn()
        sizes = self.lengths[numbers]
        ids = self.ids[gather(self.starts[numbers], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of id runs; bytes that are no UTF-8 become the replacement letter."""
        sizes = self.vocabulary.lengths[ids]
        data = self.vocabulary.bytes[gather(self.vocabulary.starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this Python worker, which outlives a task."""
    if vocabulary.digest not in _ENCODERS:
        _ENCODERS[vocabulary.digest] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.digest]


def encode(spark: SparkSession, docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """key, ids (array of int) and, if asked for, decoded: the text that the ids stand for."""
    kind = docs.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast(Vocabulary(path))  # as large as the vocabulary file

    def work():
        own = encoder(shared.value)

        def step(batch):
            ids, bounds = own.encode(strings(batch.column(1)))
            columns = [batch.column(0), lists(ids, bounds, pa.int32())]
            if decoded:
                columns.append(pa.array(own.decode(ids, bounds), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"][: len(columns)])

        return step

    out = map_text(docs, work, f"key {kind}, ids array<int>" + ", decoded string" * decoded, [key, text])
    return out.withColumnRenamed("key", key)


def decode(spark: SparkSession, rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """key and text of rows with key and ids; null ids are the empty text."""
    kind = rows.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        own = encoder(shared.value)
        for batch in batches:
            ids = [np.array(x or [], np.int64) for x in batch.column(1).to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
            texts = own.decode(np.concatenate([*ids, np.empty(0, np.int64)]), bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    return rows.select(key, "ids").mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id", *more: str) -> DataFrame:
    """Token counts and hashes of ids and decoded texts, with more columns if asked for."""
    return encoded.select(
        key,
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
