"""Micro-batches: held timestamps, late readings, replay, state."""

import json
import os
import time

import pytest

from telewarden.plans.rules import Rule, RuleSet
from telewarden.sources import read_stream
from telewarden.streaming import Monitor

RULES = RuleSet.of([
    Rule("A", "stateful", "HIGH", "S1", ">", 5.0, 3),
    Rule("B", "step_difference", "LOW", "S2", ">", 2.0),
    Rule("C", "correlation", "HIGH", logic="AND", conditions=("A", "B")),
])


def packet(second, sensor, value):
    return (f"2026-05-01T10:00:{second:02d}Z", sensor, str(value), "LOW")


def batch(spark, packets):
    return spark.createDataFrame(packets, "timestamp string, sensor_id string, value string, priority string").coalesce(1)


def alarms(monitor):
    return sorted((a.timestamp[17:19], a.rule_id, a.sensor_id, a.value) for a in monitor.alarms().collect())


def test_held_late_and_replayed(spark, tmp_path):
    monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"), text=True)
    first = [packet(1, "S1", 6), packet(1, "S2", 0), packet(2, "S1", 7), packet(2, "S2", 1), packet(3, "S1", 8)]
    second = [packet(3, "S2", 9), packet(4, "S1", 9), packet(1, "S2", 100), packet(4, "S2", "BROKEN")]
    monitor.process(batch(spark, first), 0)
    # The newest second is held, so only two breaches are known.
    assert alarms(monitor) == []
    assert [tuple(r) for r in monitor.state().streak.collect()] == [("A", "S1", 2)]
    for _ in range(2):  # the second time as after a crash
        monitor.process(batch(spark, second), 1)
        expected = [("03", "A", "S1", "8.0"), ("03", "B", "S2", "9.0"), ("03", "C", "S1,S2", "8.0,9.0")]
        assert alarms(monitor) == expected
        assert [tuple(r) for r in monitor.state().step.collect()] == [("S2", 9.0)]
    reasons = {(r.sensor_id, r.value): r.reject_reason for r in monitor.quarantine().collect()}
    assert reasons == {("S2", "100.0"): "late", ("S2", "BROKEN"): "type_value"}
    monitor.flush()
    assert alarms(monitor) == [*expected, ("04", "A", "S1", "9.0")]
    assert [n.sensor_string for n in monitor.nominal().orderBy("timestamp").collect()] == ["S1:6.0|S2:0.0", "S1:7.0|S2:1.0"]
    metrics = [tuple(m)[1:] for m in monitor.metrics().orderBy("batch_id").collect()]
    assert metrics == [(0, 4, 0, 0), (1, 2, 1, 3), (2, 1, 0, 1)]
    text = sorted((tmp_path / "out" / "alarms_text" / "batch_id=1").glob("part-*"))
    assert "".join(t.read_text() for t in text).splitlines()[0] == "2026-05-01T10:00:03Z;A;HIGH;S1;8.0"


def test_flush_is_binding_and_nothing_written_is_lost(spark, tmp_path):
    monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"))
    monitor.process(batch(spark, [packet(1, "S1", 1), packet(2, "S1", 1)]), 0)
    monitor.flush()
    monitor.flush()
    before = sorted(n.timestamp for n in monitor.nominal().collect())
    assert [t[17:19] for t in before] == ["01", "02"]
    again = [packet(2, "S1", 9), packet(3, "S1", 9), packet(4, "S1", 9), packet(5, "S1", 9)]
    monitor.process(batch(spark, again), 1)
    monitor.process(batch(spark, again), 1)  # replayed after its commit
    monitor.process(batch(spark, [packet(6, "S1", 9)]), 2)
    assert sorted(n.timestamp[17:19] for n in monitor.nominal().collect()) == ["01", "02", "03", "04"]
    assert alarms(monitor) == [("05", "A", "S1", "9.0")]
    assert [(r.timestamp[17:19], r.reject_reason) for r in monitor.quarantine().collect()] == [("02", "late")]
    kept = sorted(p.name for p in (tmp_path / "state" / "boundary").iterdir())
    assert kept == ["batch=3", "batch=4"] and monitor.metrics().count() == 5


def test_a_batch_that_broke_off_is_run_again(spark, tmp_path, monkeypatch):
    monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"))
    monitor.process(batch(spark, [packet(1, "S1", 9), packet(2, "S1", 9)]), 0)
    put = Monitor._put

    def broken(self, df, name, number):
        if name == "boundary":
            raise OSError("killed")
        put(self, df, name, number)

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(Monitor, "_put", broken)
        monitor.process(batch(spark, [packet(3, "S1", 9), packet(4, "S1", 9)]), 1)
    monitor.process(batch(spark, [packet(3, "S1", 9), packet(4, "S1", 9)]), 1)
    monitor.flush()
    assert alarms(monitor) == [("03", "A", "S1", "9.0"), ("04", "A", "S1", "9.0")]


def test_a_damaged_state_is_an_error_and_no_fresh_start(spark, tmp_path):
    monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"))
    monitor.process(batch(spark, [packet(1, "S1", 9), packet(2, "S1", 9)]), 0)
    for part in (tmp_path / "state" / "pending" / "batch=0").glob("part-*"):
        part.write_bytes(b"no parquet")
    with pytest.raises(Exception):
        monitor.process(batch(spark, [packet(3, "S1", 9)]), 1)


def test_a_stream_keeps_running_and_follows_arrival(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    keys = ("timestamp", "sensor_id", "value", "priority")

    def write(name, packets, written):
        path = tmp_path / name
        path.write_text("".join(json.dumps(dict(zip(keys, p))) + "\n" for p in packets))
        os.utime(path, (written, written))
        path.rename(source / name)

    # The file that was written first is judged first, whatever its name.
    write("b.json", [packet(1, "S2", 0)], 1_900_000_000)
    write("a.json", [packet(1, "S2", 5), packet(2, "S2", 5)], 1_900_000_100)
    monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"))
    query = monitor.start(read_stream(spark, str(source)), str(tmp_path / "checkpoint"), "1 second")
    try:
        deadline = time.time() + 120
        while not (tmp_path / "state" / "boundary").exists() or not alarms(monitor):
            assert time.time() < deadline and query.isActive
            time.sleep(0.5)
        assert alarms(monitor) == [("01", "B", "S2", "5.0")]
        assert query.isActive
    finally:
        query.stop()


def test_complete_timestamps_close_early_and_a_stream_resumes(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def arrive(name, packets):
        keys = ("timestamp", "sensor_id", "value", "priority")
        (source / name).write_text("".join(json.dumps(dict(zip(keys, p))) + "\n" for p in packets))
        monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"), delay_seconds=5, total_sensors=2)
        monitor.start(read_stream(spark, str(source)), str(tmp_path / "checkpoint")).awaitTermination()
        return monitor

    monitor = arrive("a.json", [packet(1, "S1", 6), packet(1, "S2", 0), packet(2, "S1", 6)])
    assert [n.timestamp[17:19] for n in monitor.nominal().collect()] == ["01"]
    monitor = arrive("b.json", [packet(2, "S2", 1), packet(3, "S2", 1), packet(3, "S1", 6)])
    assert alarms(monitor) == [("03", "A", "S1", "6.0")]


def test_arguments(spark):
    with pytest.raises(ValueError):
        Monitor(spark, RULES, "o", "s", delay_seconds=-1)
    with pytest.raises(ValueError):
        Monitor(spark, RULES, "o", "s", total_sensors=0)


@pytest.mark.parametrize("delay", [10**6, 5])
def test_open_readings_are_not_written_again_in_each_batch(spark, tmp_path, monkeypatch, delay):
    """Nine batches, held to the end or closed in the middle of what came together, give what one batch gives."""
    written = []
    put = Monitor._put

    def counted(self, df, name, number):
        put(self, df, name, number)
        if name == "pending":
            written.append(spark.read.parquet(f"{self.state_path}/pending/batch={number}").count())

    arriving = [[packet(i, "S1", 6 + i % 4), packet(i + 3, "S2", 5 * (i % 3)), packet(i, "S2", i)] for i in range(9)]
    whole = Monitor(spark, RULES, str(tmp_path / "out0"), str(tmp_path / "state0"))
    whole.process(batch(spark, [p for packets in arriving for p in packets]), 0)
    whole.flush()
    monkeypatch.setattr(Monitor, "_put", counted)
    monkeypatch.setattr("telewarden.streaming.incremental.MERGED", 4, raising=False)
    monitor = Monitor(spark, RULES, str(tmp_path / "out"), str(tmp_path / "state"), delay)
    for number, packets in enumerate(arriving):
        monitor.process(batch(spark, packets), number)
    assert sum(written) <= 27 + 9 + 9  # with all that is open in each batch: 135 with the long delay
    monitor.flush()
    assert alarms(monitor) == alarms(whole) and len(alarms(monitor)) > 10
    lines = [sorted(tuple(n) for n in m.nominal().collect()) for m in (monitor, whole)]
    assert lines[0] == lines[1] and lines[0]
    for name in ("step", "streak"):
        assert sorted(getattr(monitor.state(), name).collect()) == sorted(getattr(whole.state(), name).collect())
    assert sum(m.rows for m in monitor.metrics().collect()) == 27 and monitor.quarantine().count() == 0
