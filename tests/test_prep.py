"""Preparation jobs on small frames."""

from conftest import frame

from telewarden.operators.numbering import row_numbers, running_sum
from telewarden.prep import replicate, retime
from telewarden.session import Staging


def test_row_numbers_over_gaps_and_partitions(spark):
    seqs = [0, 3, 4, 50, 51, 9_000, 40_000_000, 40_000_001, 1 << 43]
    df = spark.createDataFrame([(s,) for s in seqs], "seq bigint").repartition(4)
    rows = row_numbers(df, Staging(spark)).orderBy("seq").collect()
    assert [(r.seq, r.row) for r in rows] == [(s, i) for i, s in enumerate(seqs)]
    assert row_numbers(df.limit(0), Staging(spark)).collect() == []
    summed = running_sum(df.selectExpr("seq", "1 + seq % 7 AS w"), ["seq"], "w", Staging(spark), "s").orderBy("seq").collect()
    assert [r.before for r in summed] == [sum(1 + s % 7 for s in seqs[:i]) for i in range(len(seqs))]


def test_retime_keeps_bad_times_and_counts_them(spark):
    rows = [("2020-01-01T00:00:00Z", "S", i) for i in range(5)]
    rows[1] = ("garbage", "S", 1)
    moved = retime(frame(spark, rows), "2026-05-01T23:59:59Z", 2, Staging(spark)).orderBy("seq").collect()
    assert [r.timestamp for r in moved] == [
        "2026-05-01T23:59:59Z", "garbage", "2026-05-02T00:00:00Z", "2026-05-02T00:00:00Z", "2026-05-02T00:00:01Z",
    ]


def test_replicate_repeats_the_body(spark):
    df = frame(spark, [("2026-05-01T00:00:00Z", "S", 1), ("2026-05-01T00:00:01Z", "S", 2)])
    same = replicate(df, 3, 2).orderBy("seq").collect()
    assert [(r.seq, r.value) for r in same] == [(0, 1.0), (1, 2.0), (2, 1.0), (3, 2.0), (4, 1.0), (5, 2.0)]
    shifted = replicate(df, 2, 2, 60).orderBy("seq").collect()
    assert shifted[3].timestamp == "2026-05-01T00:01:01Z"
