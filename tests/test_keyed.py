"""The state store form of the stream: same results as the batch plan, restarts, timers, late readings."""

import json

import pytest
from conftest import frame

from telewarden.plans.evaluate import evaluate
from telewarden.plans.rules import Rule, RuleSet
from telewarden.sources import read_stream
from telewarden.streaming import KeyedMonitor, Progress

RULES = RuleSet.of([
    Rule("A", "stateful", "HIGH", "S1", ">", 5.0, 3),
    Rule("B", "step_difference", "LOW", "S2", ">", 2.0),
    Rule("D", "simple", "LOW", "S3", "==", 1.0),
    Rule("E", "simple", "LOW", "S3", "~", 1.0),
    Rule("C", "correlation", "HIGH", logic="AND", conditions=("A", "B")),
])
KEYS = ("timestamp", "sensor_id", "value", "priority")


def packet(second, sensor, value):
    return (f"2026-05-01T10:00:{second:02d}Z", sensor, str(value), "LOW")


class Feed:
    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options, self.files = spark, root, options, 0
        (root / "in").mkdir()

    def run(self, *packets):
        """A new monitor, as after a restart, over one more file."""
        self.files += 1
        lines = "".join((p if isinstance(p, str) else json.dumps(dict(zip(KEYS, p)))) + "\n" for p in packets)
        (self.root / "in" / f"{self.files:03d}.json").write_text(lines)
        monitor = KeyedMonitor(self.spark, RULES, str(self.root / "out"), str(self.root / "checkpoint"), **self.options)
        self.query = monitor.start(read_stream(self.spark, str(self.root / "in")))
        self.query.awaitTermination()
        return monitor


def alarms(monitor):
    return sorted((a.timestamp[17:19], a.rule_id, a.sensor_id, a.value) for a in monitor.alarms().collect())


def streaks(monitor):
    return sorted(tuple(r) for r in monitor.state().streak.collect())


def test_held_late_restarted_and_flushed(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    monitor = feed.run(packet(1, "S1", 6), packet(1, "S2", 0), packet(2, "S1", 7), packet(2, "S2", 1), packet(3, "S1", 8))
    assert alarms(monitor) == []
    assert streaks(monitor) == [("A", "S1", 2)]
    assert [tuple(r) for r in monitor.open_readings().collect()] == [("S1", "2026-05-01T10:00:03Z")]
    monitor = feed.run(
        packet(3, "S2", 9), packet(4, "S1", 9), packet(1, "S2", 100), packet(4, "S2", "BROKEN"), '{"timestamp": "2026-05-01T10', packet(4, "S3", 0)
    )
    expected = [("03", "A", "S1", "8.0"), ("03", "B", "S2", "9.0"), ("03", "C", "S1,S2", "8.0,9.0")]
    assert alarms(monitor) == expected
    assert [tuple(r) for r in monitor.state().step.collect()] == [("S2", 9.0)]
    reasons = {(r.sensor_id, r.value): r.reject_reason for r in monitor.quarantine().collect()}
    assert reasons == {("S2", "100.0"): "late", ("S2", "BROKEN"): "type_value", (None, None): "malformed"}
    monitor.flush()
    assert alarms(monitor) == [*expected, ("04", "A", "S1", "9.0")]
    assert [n.sensor_string for n in monitor.nominal().orderBy("timestamp").collect()] == ["S1:6.0|S2:0.0", "S1:7.0|S2:1.0"]
    assert monitor.open_readings().count() == 0
    # The flush is binding.
    monitor = feed.run(packet(4, "S1", 1), packet(5, "S3", 1), packet(6, "S3", 1))
    assert ("05", "D", "S3", "1.0") in alarms(monitor) and streaks(monitor) == [("A", "S1", 4)]
    assert monitor.quarantine().filter("reject_reason = 'late' and value = '1.0'").count() == 1
    total = monitor.metrics().selectExpr("sum(arrived)", "sum(rows)", "sum(late)", "sum(rejected)", "sum(alarms)").first()
    assert tuple(total) == (14, 9, 2, 2, 5)


def test_a_batch_touches_the_state_of_its_sensors_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    many = [packet(second, f"X{i}", 1) for i in range(40) for second in (1, 2)]
    feed.run(*many, packet(1, "S1", 9), packet(2, "S1", 9), packet(3, "S1", 9))
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        feed.run(packet(4, "S1", 9))
        assert listener.wait(feed.query.runId)
    finally:
        spark.streams.removeListener(listener)
    rows = listener.frame(spark).orderBy("batch_id").collect()
    # The first batch takes the reading in, the next one closes the second before it.
    assert [(r.packets, r.arrived, r.rows) for r in rows] == [(1, 1, 0), (0, 0, 1)]
    assert all(r.state_updates <= 6 for r in rows)


def test_random_readings_equal_the_batch_plan(spark, tmp_path):
    import random

    r = random.Random(3)
    readings = sorted((r.randint(0, 20), f"S{r.randint(1, 4)}", r.choice([0.0, 1.0, 4.0, 9.0])) for _ in range(300))
    feed = Feed(spark, tmp_path, delay_seconds=2)
    for start in range(0, 300, 100):
        part = [packet(*x) for x in readings[start : start + 100]]
        monitor = feed.run(*part)
    monitor.flush()
    rows = [(packet(*x)[0], x[1], x[2]) for x in readings]
    whole = evaluate(frame(spark, rows), RULES)
    assert sorted(map(tuple, monitor.alarms().collect())) == sorted(map(tuple, whole.alarms.collect()))
    assert streaks(monitor) == sorted(tuple(x) for x in whole.state_out.streak.collect())
    assert [tuple(x) for x in monitor.state().step.collect()] == [tuple(x) for x in whole.state_out.step.collect()]
    valid = {x.timestamp for x in whole.valid.collect()}
    assert {x.timestamp for x in monitor.nominal().collect()} == valid


def test_a_keyed_monitor_makes_its_own_batches(spark, tmp_path):
    monitor = KeyedMonitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    with pytest.raises(NotImplementedError):
        monitor.process(spark.range(1), 0)
