"""Best-fit decreasing against a plain list of rooms; shards of whole tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_edges import ROWS, documents, empty

from telewarden.llm import common, sharding
from telewarden.llm.queries import op11_sharding


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def plain(sizes, capacity):
    """Shard of each size, tightest room first, then the first shard."""
    rooms, where = [], []
    for size in sorted(sizes, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        at = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(capacity)
        rooms[at] -= size
        where.append(at)
    return where


def spread(steps, number):
    if not steps:
        return []
    first, shard, each = (np.array(x) for x in zip(*steps))
    rows = np.arange(number)
    at = np.searchsorted(first, rows, "right") - 1
    return (shard[at] + (rows - first[at]) // each[at]).tolist()


@pytest.mark.parametrize("seed", range(40))
def test_packing_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    sizes = [r.choice([r.randint(1, 9), r.randint(1, 60), r.randint(1, 200)]) for _ in range(r.randint(0, 400))]
    capacity = r.randint(20, 250)
    classes = sorted(Counter(sizes).items(), reverse=True)
    steps, shards = sharding.packed(classes, capacity)
    assert spread(steps, len(sizes)) == plain(sizes, capacity)
    assert shards == len(set(plain(sizes, capacity)))


def test_near_equal_shards_give_large_groups_a_shard_each():
    classes = [(1000, 2), (400, 1), (3, 50), (1, 500)]
    where = spread(sharding.least(classes, 5), 553)
    sizes = [1000] * 2 + [400] + [3] * 50 + [1] * 500
    load = np.bincount(where, weights=sizes, minlength=5)
    assert load[:3].tolist() == [1000, 1000, 400] and load[3:].tolist() == [325, 325]
    assert spread(sharding.least([(7, 3)], 16), 3) == [0, 1, 2]
    assert sharding.least([], 16) == []


def test_many_sizes_take_time_in_proportion():
    """A capacity is searched for; a hundred thousand sizes must not take a hundred times a thousand."""
    classes = [(200_000 - i, 3) for i in range(100_000)]
    where = spread(sharding.least(classes, 16), 300_000)
    load = np.bincount(where, weights=np.repeat([c[0] for c in classes], 3), minlength=16)
    assert load.max() - load.min() < 200_000


def check(rows, texts, shards):
    """Gapless slots, whole groups, right sizes and sums."""
    slots, of = defaultdict(list), {}
    by_id = {i: t or "" for i, t, *_ in texts}
    for i, size, crc, shard, slot in rows:
        slots[shard].append(slot)
        text = by_id[i]
        assert size == len(text.encode()) + 1 and crc == zlib.crc32(text.encode())
        assert of.setdefault(text, shard) == shard and 0 <= shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(rows) == len(texts)


def test_awkward_rows_and_copies(spark):
    r = random.Random(3)
    many = [(100 + i, f"text {r.randint(0, 40)} " * r.randint(1, 9), "en", "a") for i in range(600)]
    many += [(1000 + i, "a third of all rows", "en", "a") for i in range(300)]
    rows = [*ROWS, *many]
    placed = sharding.near_equal(spark, documents(spark, rows), 16)
    assert placed.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    check([tuple(x) for x in placed.collect()], rows, 16)


def test_packing_a_table(spark):
    texts = [(i, "x" * (i % 37), "en", "a") for i in range(500)]
    placed = sharding.pack(spark, documents(spark, texts), 700).collect()
    check([tuple(x) for x in placed], texts, 1000)
    groups = Counter(len(t) + 1 for _, t, *_ in texts)
    sizes = [size * n for size, n in groups.items()]
    assert len({x.shard for x in placed}) == len(set(plain(sizes, 700)))
    load = Counter()
    for x in placed:
        load[x.shard] += x.size
    assert max(load.values()) <= 700


def test_rounded_sizes(spark):
    numbers = [1, 2, 65_535, 65_536, 65_537, 131_071, 131_073, (1 << 40) + 1, (1 << 61) + 1]
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select(sharding.rounded("n").alias("n"))
    for n, (m,) in zip(numbers, found.collect()):
        step = 1 << max(n.bit_length() - 16, 0)
        assert m == -(-n // step) * step


def test_empty_table_and_query(spark, tmp_path):
    assert sharding.near_equal(spark, empty(spark)).collect() == []
    assert sharding.pack(spark, empty(spark), 10).collect() == []
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_sharding(spark, str(tmp_path)).collect()
    assert len(found) == len(ROWS) and {(x.law, x.grown_shard) for x in found} == {("bytes", None)}
