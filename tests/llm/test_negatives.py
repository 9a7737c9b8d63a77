"""The threshold algorithm against all pairs."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from telewarden.llm import common, negatives
from telewarden.llm.queries import op12_hard_negatives


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def plain(rows, every=5, positives=5, most=10):
    """All pairs in Python's whole numbers."""
    kept = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        own = (label, [math.floor(256 * x) for x in vector])
        kept[i] = min(kept.get(i, own), own)
    out = []
    for anchor, (label, numbers) in kept.items():
        if anchor % every:
            continue
        score = {i: sum(a * b for a, b in zip(numbers, v)) for i, (_, v) in kept.items() if i != anchor and len(v) == len(numbers)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for positive in [i for i in order if kept[i][0] == label][:positives]:
            p = score[positive]
            fits = [i for i in order if kept[i][0] != label and 30 * p <= 100 * score[i] <= 90 * p][:most]
            out += [(anchor, positive, rank, i, p, score[i]) for rank, i in enumerate(fits, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", *(f"concat('x', vec_id) AS `{c}`" for c in ("id", "size", "part", "of", "numbers", "score", "rank", "anchor"))
    )


def mined(spark, rows):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(spark, table(spark, rows), F.col("vec_id") % 5 == 0, label)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(number, size, labels, seed=1, clusters=4):
    """Vectors around a few centres, with many ties where numbers are coarse."""
    random = np.random.default_rng(seed)
    centres = random.standard_normal((clusters, size))
    out = []
    for i in range(number):
        v = centres[i % clusters] + random.standard_normal(size)
        v = np.round(v / np.linalg.norm(v), 2 if i % 3 else 6)
        out.append((i, [float(x) for x in np.float32(v)], int(random.integers(0, labels))))
    return out


@pytest.mark.parametrize("cells", [1 << 18, 640])
@pytest.mark.parametrize("size,labels", [(16, 3), (3, 2), (1, 10)])
def test_equals_all_pairs(spark, monkeypatch, cells, size, labels):
    monkeypatch.setattr(negatives, "CELLS", cells)
    rows = vectors(400, size, labels)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(150)]  # a large group of copies
    assert mined(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = vectors(120, 8, 2)
    rows += [
        (200, None, 1), (205, [], 1), (210, [], 1), (211, [], 0), (215, [0.0] * 8, 1), (216, [0.0] * 8, 0),
        (220, [1.0, None] * 4, 1), (225, [float("nan")] * 8, 1), (230, [float("inf")] * 8, 0), (235, rows[3][1], None),
        (None, rows[3][1], 1), (240, [0.5] * 3, 1), (241, [0.5] * 3, 1), (242, [0.25] * 3, 0), (0, rows[0][1], rows[0][2]),
        (245, [-1.0] * 8, 1), (250, [100_000.0] * 8, 1), (251, [50_000.0] * 8, 0), (255, [90_000.0] * 8, 1),
    ]
    assert mined(spark, rows) == plain(rows)


def test_numbers_too_large_for_scores_take_no_part(spark):
    rows = vectors(40, 4, 2)
    assert mined(spark, [*rows, (300, [1e30] * 4, 1), (305, [-3e7] * 4, 0)]) == plain(rows)


def test_reading_stops_before_the_end(monkeypatch):
    """Where few numbers matter, most candidates are never scored; the result is the same."""
    random = np.random.default_rng(0)
    numbers = random.integers(-3, 4, (20_000, 8))
    numbers[:, 0] = random.integers(-100_000, 100_000, 20_000)
    block = negatives.Block(np.arange(20_000), np.zeros(20_000, int), numbers)
    scored = []
    real = negatives.Block.scores
    monkeypatch.setattr(negatives.Block, "scores", lambda self, rows, anchor: scored.append(len(rows)) or real(self, rows, anchor))
    anchor = np.array([1000, 1, 0, 0, 0, 0, 0, 0])
    best = negatives.Best(np.array([-(1 << 63)]), np.array([(1 << 63) - 1]), 5)
    negatives.search(block, -1, 0, anchor, best, True)
    scores = numbers @ anchor
    order = np.lexsort((np.arange(20_000), -scores))[:5]
    assert best.ids[0].tolist() == order.tolist() and best.scores[0].tolist() == scores[order].tolist()
    assert sum(scored) < 1000


def test_empty_tables(spark, tmp_path):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    table(spark, [(100, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.8, 0.1], 2), (3, [0.7, 0.1], 2)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = defaultdict(list)
    for r in op12_hard_negatives(spark, str(tmp_path)).collect():
        found[r.anchor_id, r.positive_id].append((r.rank, r.negative_id))
    assert {k: sorted(v) for k, v in found.items()} == {(100, 1): [(1, 2), (2, 3)]}
