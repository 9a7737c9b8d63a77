"""Readers, sanitizing and text sinks."""

import pytest
from conftest import frame
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from telewarden.functions import fmt_value
from telewarden.operators.sanitize import reject_counts, sanitize
from telewarden.session import Staging
from telewarden.sinks import pack_nominal, text, write_alarms, write_nominal
from telewarden.sources import from_payloads, load_rules, load_sensors, read_csv, read_json, read_stream


def raw(spark, rows, columns="timestamp string, sensor_id string, value string, priority string"):
    return spark.createDataFrame(rows, columns)


def kept(df):
    return [(r.timestamp, r.sensor_id, r.value, r.priority) for r in df.orderBy("seq").collect()]


def test_damaged_rows_are_dropped(spark):
    rows = [
        ("2031-03-09T08:00:00Z", "pump", "1.5", "low"),
        ("2031-03-09T08:00:00Z", "valve", "-2", None),
        ("2031-03-09T08:00:00Z", "42", "3", "Medium"),
        (None, "pump", "4", "LOW"),
        ("2031-03-09T08:00:00Z", "", "5", "LOW"),
        ("2031-03-09T08:00:00Z", "pump", "six", "LOW"),
        ("yesterday", "pump", "7", "LOW"),
        ("1741507200", "pump", "8", "LOW"),
        ("2031-03-09T08:00:00Z", "pump", "9", "URGENT"),
        ("2031-03-09T08:00:00Z", "pump", "10", "7"),
    ]
    clean, rejects = sanitize(raw(spark, rows))
    assert [r[1:] for r in kept(clean)] == [("pump", 1.5, "LOW"), ("valve", -2.0, "LOW"), ("42", 3.0, "MEDIUM")]
    assert {r.reject_reason: r.rows for r in reject_counts(rejects).collect()} == {
        "schema_missing_field": 2, "type_value": 1, "type_timestamp": 2, "schema_priority": 2,
    }


@pytest.mark.parametrize("written,ok", [
    ("2026-05-01T10:00:00Z", True), ("2026-05-01T10:00Z", True), ("2026-05-01 10:00:00", True),
    ("2026-05-01T10:00", True), ("2026-05-01T10:00:00.123456Z", True), ("2026-05-01T10:00:00+02:00", True),
    ("2026-05-01T10:00+0200", True), ("10:00", False), ("2026", False), ("2026-05", False), ("2026-05-01", False),
    ("2026-13-01T10:00:00Z", False), ("2026-05-01T25:00:00Z", False), ("2026-05-01T10:00:00 Europe/Rome", False),
    (" 2026-05-01T10:00:00Z", False), ("2026-5-1T10:00:00Z", False), ("2026-05-01T1a:00:00Z", False),
])
def test_timestamps(spark, written, ok):
    assert sanitize(raw(spark, [(written, "S", "1", "LOW")])).clean.count() == ok


def test_numbers(spark):
    good = {"1": 1.0, "-1.5": -1.5, "+2.": 2.0, ".5": 0.5, "1e3": 1000.0, "1E-3": 0.001}
    bad = ["5d", "5f", " 1.5", "1.5 ", "0x1p3", "nan", "inf", "Infinity", "1e999", "1-2", "e5", "", "NA", "1,5", "-0X1p3", "+", ".", "1 ", "\t1", "1f", "/1", "1/"]
    rows = [("2026-05-01T10:00:00Z", "S", text, None) for text in [*good, *bad]]
    clean, rejects = sanitize(raw(spark, rows))
    assert sorted(r.value for r in clean.collect()) == sorted(good.values())
    assert rejects.count() == len(bad)
    numbers = spark.createDataFrame([(1.5,), (float("inf"),), (float("nan"),), (None,)], "value double")
    typed = numbers.select(F.lit("2026-05-01T10:00Z").alias("timestamp"), F.lit("S").alias("sensor_id"), "value")
    assert [r.value for r in sanitize(typed).clean.collect()] == [1.5]


def test_missing_columns(spark):
    no_priority = raw(spark, [("2031-03-09T08:00Z", "pump", "0.25")], "timestamp string, sensor_id string, value string")
    assert kept(sanitize(no_priority).clean) == [("2031-03-09T08:00Z", "pump", 0.25, "LOW")]
    clean, rejects = sanitize(no_priority.drop("value"))
    assert clean.count() == 0 and rejects.count() == 0 and dict(clean.dtypes)["value"] == "double"


def test_csv_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "sensor_id,timestamp,value,priority,extra\n"
        "S1,2026-05-01T10:00:00Z,1.0,HIGH,x\n"
        "S2,2026-05-01T10:00:00Z,2.0\n"
        'S3,2026-05-01T10:00:00Z,3.0,"HIGH\n'
        "line lost\n"
        "NA,2026-05-01T10:00:00Z,4.0,LOW,x\n"
        "S5,2026-05-01T10:00:00Z,null,LOW,x\n"
        "S6,2026-05-01T10:00:00Z,6.0,,x\n"
    )
    clean, rejects = sanitize(read_csv(spark, str(tmp_path / "a.csv")))
    assert [r[1:] for r in kept(clean)] == [("S1", 1.0, "HIGH"), ("S2", 2.0, "LOW"), ("S3", 3.0, "HIGH"), ("S6", 6.0, "LOW")]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["malformed", "schema_missing_field", "schema_missing_field"]


def test_arrival_order_over_files_and_splits(spark, tmp_path):
    expected = []
    for name, count in (("b", 3000), ("a", 10), ("c d", 700)):
        lines = [f"2026-05-01T10:00:00Z,{name},{i},LOW" for i in range(count)]
        (tmp_path / f"{name}.csv").write_text("timestamp,sensor_id,value,priority\n" + "\n".join(lines) + "\n")
    for name, count in (("a", 10), ("b", 3000), ("c d", 700)):
        expected += [(name, float(i)) for i in range(count)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = sanitize(read_csv(spark, str(tmp_path))).clean
        rows = df.orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.sensor_id, r.value) for r in rows] == expected
    assert len({r.seq for r in rows}) == len(rows)


def test_json_packets(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"timestamp": "2026-05-01T10:00:00Z", "sensor_id": "S1", "value": 1.5, "priority": "LOW"}\n'
        '{"timestamp": "2026-05-01T10:00:00Z", "sensor_id": "S2", "value": "text"}\n'
        '{"timestamp": "2026-05-01T10:0\n'
        '{"timestamp": "2026-05-01T10:00:01Z", "sensor_id": "S1", "value": 2}\n'
    )
    clean, rejects = sanitize(read_json(spark, str(tmp_path / "p.json")))
    assert [r[1:] for r in kept(clean)] == [("S1", 1.5, "LOW"), ("S1", 2.0, "LOW")]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["malformed", "type_value"]


def test_catalogue_files(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("sensors:\n- id: A\n  unit: '%'\n- id: B\nspacecraft_id: X-1\n")
    assert [tuple(r) for r in load_sensors(spark, str(tmp_path / "s.yaml")).collect()] == [
        ("A", None, "%", "X-1"), ("B", None, None, "X-1"),
    ]
    (tmp_path / "r.json").write_text('[{"rule_id": "R", "value": 3, "conditions": ["a"]}, {"rule_id": "Q"}]')
    assert [(r.rule_id, r.value, r.pos) for r in load_rules(spark, str(tmp_path / "r.json")).collect()] == [
        ("R", 3.0, 0), ("Q", None, 1),
    ]


def test_value_text(spark):
    cases = {
        0.0: "0.0", 12.0: "12.0", 113.59: "113.59", -0.001: "-0.001", 1e7: "10000000.0", 12345678.9: "12345678.9",
        1.5e15: "1500000000000000.0", 1e16: "1e16", 2.5e20: "2.5e20", 0.0005: "0.0005", 0.00001234: "0.00001234",
        1e-7: "1e-7", -98765432.125: "-98765432.125",
    }
    rows = spark.createDataFrame([(v,) for v in cases], "v double").select("v", fmt_value("v").alias("t")).collect()
    assert {r.v: r.t for r in rows} == cases


def test_packing_sorts_sensors_and_keeps_arrival(spark):
    rows = [("t2", "valve", 3), ("t1", "valve", 1), ("t1", "pump", 0.5), ("t1", "valve", 7), ("t1", "Pump", 2)]
    packed = pack_nominal(frame(spark, rows)).orderBy("timestamp").collect()
    assert [tuple(p) for p in packed] == [
        ("t1", "NOMINAL", "Pump:2.0|pump:0.5|valve:1.0|valve:7.0"), ("t2", "NOMINAL", "valve:3.0"),
    ]


def test_a_line_that_no_row_holds_is_refused_by_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "MAX_BYTES", 30)
    rows = [("short", "pump", 1)] + [("long", "pump", i) for i in range(9)]
    with pytest.raises(Exception, match="longer than a row holds: long"):
        write_nominal(frame(spark, rows), str(tmp_path / "out"), stage=Staging(spark))


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,sensor_id,value\n2031-03-09T08:00:00Z,pump,1\n")
    (tmp_path / "b.csv").write_text("sensor_id,timestamp,value\npump,2031-03-09T08:00:00Z,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_sinks_refuse_what_they_should(spark, tmp_path, caplog):
    out = tmp_path / "out"
    readings = frame(spark, [("noon", "pump", 1)])
    assert not write_alarms(readings, str(out)) and "missing columns" in caplog.text
    assert not write_nominal(readings.limit(0), str(out))
    assert not write_nominal(spark.createDataFrame([], ""), str(out))
    assert not write_alarms(spark.createDataFrame([], ""), str(out))
    assert not out.exists()
    assert write_nominal(readings, str(out)) and write_nominal(readings, str(out))
    assert sorted(r.value for r in spark.read.text(str(out)).collect()) == ["noon;NOMINAL;pump:1.0"] * 2


def test_a_csv_stream_refuses_another_header(spark, tmp_path):
    def run(header):
        folder = tmp_path / str(len(header)) / header.split(",")[0]
        folder.mkdir(parents=True)
        (folder / "a.csv").write_text(f"{header}\nS1,2026-05-01T10:00:00Z,1.0,LOW\n")
        query = read_stream(spark, str(folder), "csv").writeStream.format("noop")
        query.option("checkpointLocation", f"{folder}-c").trigger(availableNow=True).start().awaitTermination()

    run("timestamp,sensor_id,value,priority")
    with pytest.raises(StreamingQueryException):
        run("sensor_id,timestamp,value,priority")


def test_sensor_catalogues_of_a_folder(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.yaml").write_text("sensors:\n- {id: A, sampling_rate: 10}\nspacecraft_id: X\n")
    (tmp_path / "s" / "b.yaml").write_text("sensors:\n- {id: B}\n- {id: C}\n")
    (tmp_path / "s" / "c.yaml").write_text("")
    rows = sorted(tuple(r) for r in load_sensors(spark, str(tmp_path / "s")).collect())
    assert rows == [("A", "10", None, "X"), ("B", None, None, None), ("C", None, None, None)]


def test_damaged_text_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,sensor_id,value,priority\nnoise, lost\n2026-05-01T10:00:00Z,S1,x,LOW\n")
    rejects = sanitize(read_csv(spark, str(tmp_path / "a.csv"))).rejects.collect()
    assert sorted((r.reject_reason, r.line) for r in rejects) == [("malformed", "noise, lost"), ("type_value", None)]
    records = spark.createDataFrame(
        [(5, bytearray(b'{"timestamp": "2026-05-01T10:00:00Z", "sensor_id": "S1", "value": 1.5}')), (6, bytearray(b'{"timest')), (7, None)],
        "offset long, value binary",
    )
    clean, rejects = sanitize(from_payloads(records, F.col("value"), F.col("offset")))
    assert [(r.seq, r.value) for r in clean.collect()] == [(5, 1.5)]
    assert sorted((r.seq, r.reject_reason, r.line) for r in rejects.collect()) == [
        (6, "malformed", '{"timest'), (7, "schema_missing_field", None),
    ]
