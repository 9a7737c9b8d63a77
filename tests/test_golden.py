"""Whole runs from files to files."""

import json

import pytest

from telewarden import job
from telewarden.job import main, run
from telewarden.sinks import publish

BASE = [
    {"rule_id": "hot", "type": "simple", "sensor_id": "pump", "operator": ">=", "value": 70, "priority": "high"},
    {"rule_id": "surge", "type": "step_difference", "sensor_id": "tank", "operator": ">", "value": 4.0, "priority": "MEDIUM"},
    {"rule_id": "stuck", "type": "stateful", "sensor_id": "valve", "operator": "==", "value": 3.0,
     "priority": "LOW", "consecutive_measurements": 2},
    {"rule_id": "cold", "type": "simple", "sensor_id": "pump", "operator": "<", "value": 20.0, "priority": "Medium"},
]
RULES = [
    *BASE,
    {"rule_id": "pair", "type": "correlation", "conditions": ["hot", "stuck"], "logic": "and", "priority": "HIGH"},
    {"rule_id": "either", "type": "correlation", "conditions": ["surge", "cold"], "logic": "OR", "priority": "LOW"},
]
SEVERE = {"rule_id": "odd", "type": "simple", "sensor_id": "pump", "operator": ">", "value": 0, "priority": "SEVERE"}
SENSORS = "sensors:\n- {id: pump, sampling_rate: 1/min}\n- {id: valve}\n- {id: tank, unit: l}\nspacecraft_id: plant\n"

HEADER = "timestamp,sensor_id,value,priority\n"
READINGS = """\
2031-03-09T08:00:00Z,pump,50,LOW
2031-03-09T08:00:00Z,valve,1,LOW
2031-03-09T08:00:00Z,tank,10,HIGH
2031-03-09T08:01:00Z,pump,70,LOW
2031-03-09T08:01:00Z,valve,3,LOW
2031-03-09T08:01:00Z,tank,12,LOW
2031-03-09T08:02:00Z,pump,71,MEDIUM
2031-03-09T08:02:00Z,valve,3,LOW
2031-03-09T08:02:00Z,tank,17.5,LOW
2031-03-09T08:03:00Z,pump,19,LOW
2031-03-09T08:03:00Z,valve,3,LOW
2031-03-09T08:03:00Z,tank,16,LOW
2031-03-09T08:04:00Z,pump,40,LOW
2031-03-09T08:04:00Z,valve,2,LOW
2031-03-09T08:04:00Z,tank,22,LOW
2031-03-09T08:05:00Z,pump,69.9,LOW
2031-03-09T08:05:00Z,valve,3,LOW
2031-03-09T08:05:00Z,tank,21,LOW
"""
BASE_ALARMS = [
    "2031-03-09T08:01:00Z;hot;HIGH;pump;70.0",
    "2031-03-09T08:02:00Z;hot;HIGH;pump;71.0",
    "2031-03-09T08:02:00Z;surge;MEDIUM;tank;17.5",
    "2031-03-09T08:02:00Z;stuck;LOW;valve;3.0",
    "2031-03-09T08:03:00Z;cold;MEDIUM;pump;19.0",
    "2031-03-09T08:03:00Z;stuck;LOW;valve;3.0",
    "2031-03-09T08:04:00Z;surge;MEDIUM;tank;22.0",
]
ALL_ALARMS = [
    "2031-03-09T08:01:00Z;hot;HIGH;pump;70.0",
    "2031-03-09T08:02:00Z;hot;HIGH;pump;71.0",
    "2031-03-09T08:02:00Z;pair;HIGH;pump,valve;71.0,3.0",
    "2031-03-09T08:02:00Z;surge;MEDIUM;tank;17.5",
    "2031-03-09T08:02:00Z;either;LOW;tank,pump;17.5,71.0",
    "2031-03-09T08:02:00Z;stuck;LOW;valve;3.0",
    "2031-03-09T08:03:00Z;cold;MEDIUM;pump;19.0",
    "2031-03-09T08:03:00Z;either;LOW;tank,pump;16.0,19.0",
    "2031-03-09T08:03:00Z;stuck;LOW;valve;3.0",
    "2031-03-09T08:04:00Z;surge;MEDIUM;tank;22.0",
    "2031-03-09T08:04:00Z;either;LOW;tank,pump;22.0,40.0",
]
NOMINAL = [
    "2031-03-09T08:00:00Z;NOMINAL;pump:50.0|tank:10.0|valve:1.0",
    "2031-03-09T08:05:00Z;NOMINAL;pump:69.9|tank:21.0|valve:3.0",
]


def write_case(folder, text, rules):
    (folder / "in.csv").write_text(HEADER + text)
    (folder / "rules.json").write_text(json.dumps(rules))
    (folder / "sensors.yaml").write_text(SENSORS)
    return [str(folder / name) for name in ("in.csv", "out", "rules.json", "sensors.yaml")]


def lines_of(folder):
    """Part files in name order, as ``cat part-*`` shows them."""
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


@pytest.mark.parametrize("slice_rows,as_table", [(100_000, False), (4, False), (4, True)])
def test_base_rules(spark, tmp_path, slice_rows, as_table):
    paths = write_case(tmp_path, READINGS, [*BASE, SEVERE])
    summary = run(spark, *paths, slice_rows=slice_rows, rules_as_table=as_table)
    assert lines_of(tmp_path / "out" / "alarms") == BASE_ALARMS
    assert lines_of(tmp_path / "out" / "valid_data") == NOMINAL
    assert (summary.rows, summary.alarms, summary.nominal, summary.sensors) == (18, 7, 2, 3)
    assert summary.rejects == {} and not (tmp_path / "out" / "_runs").exists()


def test_command_line_with_damage(spark, tmp_path):
    damaged = READINGS.replace("08:00:00Z,tank,10,HIGH", "08:00:00Z,tank,10,").replace("08:05:00Z,valve,3,LOW", "08:05:00Z,valve,3,SEVERE")
    inp, out, rules, sensors = write_case(tmp_path, damaged, RULES)
    arguments = ["--input_path", inp, "--output_path", out, "--rules_path", rules, "--sensors_path", sensors, "--quarantine"]
    nominal = [NOMINAL[0], NOMINAL[1].removesuffix("|valve:3.0")]
    for _ in range(2):  # the second run starts clean and gives the same lines
        main(arguments)
        assert lines_of(tmp_path / "out" / "alarms") == ALL_ALARMS
        assert lines_of(tmp_path / "out" / "valid_data") == nominal
        rejected = spark.read.parquet(f"{out}/quarantine").collect()
        assert [(r.sensor_id, r.reject_reason) for r in rejected] == [("valve", "schema_priority")]
    for times in (2, 3):  # later runs stand after earlier ones
        main([*arguments[:-1], "--mode", "append"])
        assert lines_of(tmp_path / "out" / "alarms") == ALL_ALARMS * times
        assert lines_of(tmp_path / "out" / "valid_data") == nominal * times


def test_rejects_are_counted_without_quarantine(spark, tmp_path):
    paths = write_case(tmp_path, READINGS.replace(",19,", ",frozen,") + "noise\n", RULES)
    summary = run(spark, *paths)
    assert summary.rejects == {"malformed": 1, "type_value": 1} and summary.rows == 17


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_crash_between_the_outputs_leaves_the_old_ones(spark, tmp_path, monkeypatch, mode):
    paths = write_case(tmp_path, READINGS, RULES)
    run(spark, *paths)

    def broken(*_, **__):
        raise OSError("disk")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="disk"):
        patch.setattr(job, "write_nominal", broken)
        run(spark, *paths, mode=mode)
    assert lines_of(tmp_path / "out" / "alarms") == ALL_ALARMS
    assert lines_of(tmp_path / "out" / "valid_data") == NOMINAL
    run(spark, *paths, mode=mode)
    times = 2 if mode == "append" else 1
    assert sorted(lines_of(tmp_path / "out" / "alarms")) == sorted(ALL_ALARMS * times)


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_crash_while_publishing_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, mode):
    paths = write_case(tmp_path, READINGS, RULES)
    run(spark, *paths)
    moves = []

    def once(spark, source, target):
        if moves:
            raise OSError("killed")
        moves.append(source)
        real(spark, source, target)

    real = publish.move
    with monkeypatch.context() as patch, pytest.raises(OSError, match="killed"):
        patch.setattr(publish, "move", once)
        run(spark, *paths, mode=mode)
    publish.recover(spark, paths[1])
    times = 2 if mode == "append" else 1
    assert sorted(lines_of(tmp_path / "out" / "alarms")) == sorted(ALL_ALARMS * times)
    assert sorted(lines_of(tmp_path / "out" / "valid_data")) == sorted(NOMINAL * times)


def test_empty_sensor_catalogue_is_an_error(spark, tmp_path):
    paths = write_case(tmp_path, READINGS, RULES)
    (tmp_path / "sensors.yaml").write_text("sensors: []\n")
    with pytest.raises(ValueError, match="no sensors"):
        run(spark, *paths)
    with pytest.raises(ValueError, match="mode"):
        write_case(tmp_path, READINGS, RULES)
        run(spark, *paths, mode="replace")


def test_no_alarm_writes_no_alarm_folder(spark, tmp_path):
    quiet = READINGS.splitlines(keepends=True)[:3]
    run(spark, *write_case(tmp_path, "".join(quiet), RULES))
    assert not (tmp_path / "out" / "alarms").exists()
    assert lines_of(tmp_path / "out" / "valid_data") == NOMINAL[:1]


@pytest.mark.parametrize("text", [HEADER, HEADER + "noise\n", "timestamp,sensor_id,priority\n2031-03-09T08:00:00Z,pump,LOW\n"])
def test_input_without_a_single_clean_row(spark, tmp_path, text):
    paths = write_case(tmp_path, "", RULES)
    (tmp_path / "in.csv").write_text(text)
    summary = run(spark, *paths)
    assert (summary.rows, summary.alarms, summary.nominal) == (0, 0, 0)
    assert not (tmp_path / "out" / "alarms").exists() and not (tmp_path / "out" / "valid_data").exists()
