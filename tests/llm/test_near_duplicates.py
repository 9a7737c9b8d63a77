"""SimHash and lattice hashing against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from llm_edges import ROWS, by_id, documents, empty, reached

from telewarden.llm import common, lattice, simhash
from telewarden.session import Staging

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows, distance=3):
    """(doc_id, fingerprint, component) by comparing all pairs."""
    prints = [plain_fingerprint(r[1]) for r in rows]
    named = [i for i, r in enumerate(rows) if r[0] is not None]
    links = [(a, b) for a in named for b in named if a < b and (prints[a] ^ prints[b]).bit_count() <= distance]
    labels = reached(len(rows), links)
    smallest = {}
    for i in named:
        smallest[labels[i]] = min(smallest.get(labels[i], rows[i][0]), rows[i][0])
    return [(r[0], f"{prints[i]:016x}", smallest[labels[i]] if r[0] is not None else None) for i, r in enumerate(rows)]


def variants():
    """Copies with growing edits, so that chains of close fingerprints appear; one text many times."""
    random = np.random.default_rng(2)
    rows = []
    for family in range(8):
        words = [f"w{x}" for x in random.integers(0, 400, 150)]
        for copy in range(12):
            rows.append((10_000 - len(rows) * 7 % 1009, " ".join(words), None, None))
            if copy % 3:
                words[int(random.integers(0, 150))] = f"e{family}{copy}"
    return rows + [(2000 + i, "The SAME\ttext  again and again", None, None) for i in range(60)]


@pytest.mark.parametrize("group", [2048, 3])
def test_components_equal_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rows = [*ROWS, *variants()]
    docs = documents(spark, rows)
    found = simhash.near_duplicates(spark, docs).select("doc_id", simhash.hexadecimal().alias("f"), "component_id")
    expected = plain_components(rows)
    assert by_id(found.collect()) == by_id(expected)
    assert 1 < len({c for _, _, c in expected if c is not None}) < len(rows) - 70
    if group == 3:
        return
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    own = {(i, c) for i, _, c in expected if i is not None and i == c}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i, _ in own)
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(spark, empty(spark)).collect() == []
    assert simhash.keep_one(spark, empty(spark)).collect() == []


def test_tables_meet_every_close_pair():
    random = np.random.default_rng(0)
    for distance in (1, 3):
        for _ in range(300):
            a = int(random.integers(0, 1 << 63))
            b = a
            for bit in random.choice(64, distance, replace=False):
                b ^= 1 << int(bit)
            assert any((a ^ b) & (m % (1 << 64)) == 0 for m in simhash.masks(distance))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(3, 200)] + [(500, 900), (900, 900), (3, 4)], "a long, b long")
    found = {r.node: r.component for r in common.components(edges, Staging(spark), "chain").collect()}
    assert found == {i: 3 for i in range(3, 201)} | {500: 500, 900: 500}
    assert common.components(edges.limit(0), Staging(spark), "none").collect() == []


def vectors(seed=0, families=25, copies=14, size=24, spread=0.02):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(families):
        centre = random.standard_normal(size)
        for _ in range(copies):
            rows.append((centre + spread * np.linalg.norm(centre) * random.standard_normal(size)).astype(np.float32).tolist())
    return rows


def plain_links(rows, least=0.9):
    """(vec_id, n_links, component, kept) by comparing all pairs."""
    good = [
        i for i, (key, v) in enumerate(rows)
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    units = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in good}
    links = [
        (a, b) for n, a in enumerate(good) for b in good[n + 1 :]
        if len(units[a]) == len(units[b]) and units[a] @ units[b] >= least
    ]
    counts = np.bincount(np.array(links, int).reshape(-1), minlength=len(rows))
    labels = reached(len(rows), links)
    smallest = {}
    for i in good:
        smallest[labels[i]] = min(smallest.get(labels[i], rows[i][0]), rows[i][0])
    component = [smallest.get(labels[i], rows[i][0]) for i in range(len(rows))]
    return [(rows[i][0], int(counts[i]), component[i], rows[i][0] is not None and component[i] == rows[i][0]) for i in range(len(rows))]


@pytest.mark.parametrize("group", [512, 4])
def test_links_equal_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(lattice, "GROUP", group)
    rows = [(i * 31 % 1009, v) for i, v in enumerate(vectors())]
    rows += [(2000 + i, rows[3][1]) for i in range(40)]  # one vector many times
    rows += [
        (3000, None), (3001, [0.0] * 24), (3002, [float("nan")] * 24), (3003, [None] + [1.0] * 23), (3004, [float("inf")] * 24),
        (3005, rows[3][1][:20]), (3006, []), (None, rows[3][1]), (3007, [1e30 * x for x in rows[3][1]]), (3008, [1.0]), (3009, [2.0]),
    ]
    given = spark.createDataFrame([(k, v, 0, "x") for k, v in rows], "vec_id long, embedding array<float>, label int, node string")
    found = by_id(lattice.near_duplicates(spark, given).collect())
    expected = by_id(plain_links(rows))
    assert found == expected and any(n > 40 for _, n, *_ in expected)


def met_share(one, two):
    """Share of pairs of rows that meet in some table."""
    met = np.zeros(len(one), bool)
    for table in range(lattice.TABLES):
        met |= lattice.meets(one[:, table, 0], two[:, table]) | lattice.meets(two[:, table, 0], one[:, table])
    return met.mean()


@pytest.mark.parametrize("size", [8, 9, 16, 64, 384, 768])
def test_recall_for_vectors_of_any_length(size):
    random = np.random.default_rng(size)
    for centres in (2000, 10):  # unrelated vectors, and such around few centres
        u = lattice.unit(np.repeat(random.standard_normal((centres, size)), 2000 // centres, axis=0) + 0.5 * random.standard_normal((2000, size)))
        v = random.standard_normal((2000, size))
        v = lattice.unit(v - (v * u).sum(axis=1, keepdims=True) * u)
        assert met_share(lattice.cells(u), lattice.cells(0.9 * u + np.sqrt(1 - 0.9**2) * v)) >= 0.925


def test_unrelated_vectors_seldom_meet():
    random = np.random.default_rng(7)
    one, two = (lattice.cells(lattice.unit(random.standard_normal((20_000, 64)))) for _ in range(2))
    assert met_share(one, two) < 0.006


def test_recall_near_the_bound():
    random = np.random.default_rng(5)
    u = lattice.unit(random.standard_normal((2000, 64)))
    for cosine, least in ((0.9, 0.92), (0.95, 0.99)):
        v = random.standard_normal((2000, 64))
        v = lattice.unit(v - (v * u).sum(axis=1, keepdims=True) * u)
        one, two = lattice.cells(u), lattice.cells(cosine * u + np.sqrt(1 - cosine**2) * v)
        met = np.zeros(2000, bool)
        for table in range(lattice.TABLES):
            met |= lattice.meets(one[:, table, 0], two[:, table]) | lattice.meets(two[:, table, 0], one[:, table])
        assert met.mean() >= least


def test_decoded_points_are_the_nearest():
    random = np.random.default_rng(1)
    x = random.standard_normal((500, 8)) * 2
    point = lattice.nearest_e8(x)
    assert all(len({int(c) % 2 for c in p}) == 1 and int(p.sum()) % 4 == 0 for p in point)
    gap = ((x - point / 2) ** 2).sum(axis=1)
    moves = lattice.shortest()
    assert len({tuple(m) for m in moves}) == 240 and (moves**2).sum(axis=1).tolist() == [8] * 240
    others = ((x[:, None] - (point[:, None] + moves[None]) / 2) ** 2).sum(axis=2)
    assert (others.min(axis=1) >= gap - 1e-9).all()


def test_vectors_of_an_empty_table(spark):
    given = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert lattice.near_duplicates(spark, given).collect() == []


def test_components_of_chains_in_any_order(spark):
    """Labels that must cross many basins: 0, N, N-1, ..., 1 along the path, and shuffled ids."""
    edges, expected = [], {}
    for part, order in enumerate([[0, *range(1200, 0, -1)], np.random.default_rng(3).permutation(1500).tolist()]):
        order = [part * 10_000 + i for i in order]
        edges += zip(order, order[1:])
        expected |= dict.fromkeys(order, part * 10_000)
    given = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in common.components(given, Staging(spark), "any").collect()}
    assert found == expected
