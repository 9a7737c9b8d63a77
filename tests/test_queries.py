"""Registered queries against their SQL on the smallest tables."""

import os
from datetime import datetime

import duckdb
import pytest
from compare import differences, tables

import __spark_entry__ as driver
from telewarden.oracle import ORACLE
from telewarden.queries import QUERIES

SF = "/root/testdata/sf0.001"
CHECKED = [
    "all_operators", "unknown_operator", "segmented_step", "segmented_streak", "two_part_carry_in",
    "nominal_packed", "alarms_sorted", "orders_alarms", "sanitize_rejects", "rule_rejects",
    "rules_table_join", "rules_table_alarms", "completeness_report", "sensor_counts", "batch_metrics",
    "replicate", "row_numbers", "retime", "grid", "best_batch", "rules_table_nominal", "rules_table_state",
    "alarm_positions", "nominal_positions", "rule_positions", "damaged_csv", "rules_json", "sensors_yaml",
    "absent_sensor", "no_rules", "refused_outputs", "counted_rejects", "csv_scan",
    "many_rules_hits", "many_streaks", "supplier_completeness", "islands_streak", "damaged_lines", "appended_positions", "refused_arguments",
    "keyed_stream_quarantine", "stream_progress",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return tables(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, con, name):
    assert differences(driver.queries()[name](spark, SF), con, driver.oracle_sql()[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).columns == ["timestamp", "rule_id", "priority", "sensor_id", "value"]


@pytest.mark.parametrize("name", ["nominal_lines_written", "alarm_lines_written", "nominal_positions", "alarm_positions", "appended_positions", "published_lines"])
@pytest.mark.parametrize("value", [400.0, 1.0])
def test_outputs_without_lines(spark, tmp_path, name, value):
    """Events of which every hour has an alarm, and of which none has: one of the outputs leaves no folder."""
    rows = [(i, datetime(2024, 1, 1, i), i, "purchase", value + i % 2, None) for i in range(6)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * REPLACE (CAST(ts AS TIMESTAMP) AS ts) FROM '{tmp_path}/events.parquet/*.parquet'")
    assert differences(driver.queries()[name](spark, str(tmp_path)), con, driver.oracle_sql()[name]) == ""
