"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie. A node's failure link leads to the node reached after the longest pieces
have been popped off the front of what the node spells, and the number of popped pieces is known
beforehand. Reading a word is then one walk: follow the letter, or pop and follow the failure link.
No piece is built. All distinct words of a slice of texts walk together in numpy.

Words are the pieces of the vocabulary's split pattern, as UTF-8 bytes; each is covered from the
left by the longest vocabulary entry each time. A word that cannot be covered counts as one unknown
token. Null and empty texts have no words. Repeated rows, ties and extra columns pass unchanged; an
empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import REMEMBERED, Chunks, Numbers, byte_letters
from .common import map_text, strings


def byte_entries(path: str) -> list[bytes]:
    """Entries of a byte-level vocabulary file, without the added tokens."""
    with open(path, "rb") as file:
        model = json.loads(file.read())
    value = {c: b for b, c in enumerate(byte_letters())}
    added = {x["content"] for x in model["added_tokens"]}
    return [bytes(value[c] for c in token) for token in model["model"]["vocab"] if token not in added]


class Automaton:
    """Trie edges as sorted keys (node, byte), failure links and numbers of popped pieces."""

    def __init__(self, entries: list[bytes]):
        self.digest = hashlib.sha256(b"\0".join(sorted(entries))).hexdigest()
        child: list[dict[int, int]] = [{}]
        final = [False]
        for entry in entries:
            node = 0
            for byte in entry:
                if byte not in child[node]:
                    child[node][byte] = len(child)
                    child.append({})
                    final.append(False)
                node = child[node][byte]
            final[node] = node > 0
        fail, pops = [-1] * len(child), [0] * len(child)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, nxt in child[node].items():
                if final[nxt]:
                    fail[nxt], pops[nxt] = 0, 1
                else:
                    at, popped = fail[node], pops[node]
                    while at >= 0 and byte not in child[at]:
                        at, popped = fail[at], popped + pops[at]
                    if at >= 0:
                        fail[nxt], pops[nxt] = child[at][byte], popped
                queue.append(nxt)
        keys = np.array([n * 256 + b for n, own in enumerate(child) for b in own], np.int64)
        targets = np.array([t for own in child for t in own.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], targets[order]
        self.fail, self.pops = np.array(fail, np.int64), np.array(pops, np.int64)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word; -1 where the word cannot be covered."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        result = np.zeros(len(words), np.int64)
        word = np.flatnonzero(lengths)
        place = (np.cumsum(lengths) - lengths)[word]
        end = place + lengths[word]
        node, pieces = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        while len(word):
            reading = place < end
            key = node * 256 + data[place]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1) if len(self.keys) else None
            step = reading & (self.keys[at] == key) if at is not None else np.zeros(len(word), bool)
            over = ~reading & (node == 0)
            lost = ~step & ~over & (self.fail[node] < 0)
            result[word[over]] = pieces[over]
            result[word[lost]] = -1
            back = ~step
            pieces[back] += self.pops[node[back]]
            node[back] = self.fail[node[back]]
            if at is not None:
                node[step] = self.targets[at[step]]
            place[step] += 1
            if over.any() or lost.any():
                stay = ~(over | lost)
                word, place, end, node, pieces = word[stay], place[stay], end[stay], node[stay], pieces[stay]
        return result


class Counter:
    """Counts words and pieces of texts, remembering both for chunks."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.chunks = automaton, Chunks({})
        self.known = np.empty((0, 3), np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        """Words, tokens and unknown words of each text."""
        if len(self.known) > REMEMBERED:
            self.chunks.number.clear()
            self.known = self.known[:0]
        numbers, bounds = self.chunks.numbers(texts)
        pieces, _ = self.chunks.words(len(self.known))
        distinct = Numbers()
        which = np.array([distinct[w] for p in pieces for w in p], np.int64)
        sizes = self.automaton.counts([w.encode() for w in distinct])[which]
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        new = np.zeros((len(pieces), 3), np.int64)
        for column, values in enumerate((np.ones(len(sizes)), np.abs(sizes), sizes < 0)):
            new[:, column] = np.bincount(owner, values, len(pieces))
        self.known = np.concatenate([self.known, new])
        total = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(self.known[numbers], axis=0)])
        return total[bounds[1:]] - total[bounds[:-1]]


_COUNTERS: dict[str, Counter] = {}


def token_counts(
    spark: SparkSession, docs: DataFrame, entries: list[bytes], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, n_words, n_tokens and n_unknown of each row's whole text."""
    kind = docs.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast(Automaton(entries))  # as large as the vocabulary

    def work():
        automaton = shared.value
        own = _COUNTERS.setdefault(automaton.digest, Counter(automaton))

        def step(batch):
            found = own.count(strings(batch.column(1)))
            columns = [batch.column(0), *(pa.array(found[:, i], pa.int64()) for i in range(3))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_tokens", "n_unknown"])

        return step

    out = map_text(docs, work, f"key {kind}, n_words long, n_tokens long, n_unknown long", [key, text])
    return out.withColumnRenamed("key", key)
