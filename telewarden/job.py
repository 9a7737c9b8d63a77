"""Batch and streaming jobs: files in, nominal lines and alarm lines out.

spark-submit job.py --input_path ... --output_path ... --rules_path ...
    --sensors_path ... [--format csv|json] [--mode overwrite|append] [--quarantine]
    [--rules_as_table]
spark-submit job.py ... --stream [--state_store] [--delay_seconds N] [--trigger '10 seconds'] [--flush]
"""

from __future__ import annotations

import argparse
import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from telewarden.operators.sanitize import REASONS, counted, mark, sanitize, split
from telewarden.plans import relational
from telewarden.plans.evaluate import SLICE_ROWS, evaluate
from telewarden.plans.rules import RuleSet, normalise_rules
from telewarden.schemas import MANDATORY
from telewarden.session import Staging, observed_row
from telewarden.sinks import Publication, write_alarms, write_nominal
from telewarden.sources import load_rules, load_sensors, read_csv, read_json, read_stream
from telewarden.streaming import KeyedMonitor, Monitor

logger = logging.getLogger(__name__)

OUTPUTS = ("alarms", "valid_data", "quarantine")


@dataclass
class Summary:
    """Metrics of a batch run."""

    rows: int = 0
    sensors: int = 0
    alarms: int = 0
    nominal: int = 0
    seconds: float = 0.0
    rejects: dict[str, int] = field(default_factory=dict)


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    rules_path: str,
    sensors_path: str,
    fmt: str = "csv",
    mode: str = "overwrite",
    quarantine: bool = False,
    slice_rows: int = SLICE_ROWS,
    rules_as_table: bool = False,
) -> Summary:
    """Evaluate all readings of ``input_path``; alarms and nominal lines go to folders."""
    started = time.perf_counter()
    sensors = load_sensors(spark, sensors_path).count()
    raw = read_csv(spark, input_path) if fmt == "csv" else read_json(spark, input_path)
    rules = _rule_table(spark, rules_path) if rules_as_table else _rules(spark, rules_path)
    summary = run_readings(spark, raw, output_path, rules, mode, quarantine, slice_rows)
    summary.sensors = sensors
    summary.seconds = time.perf_counter() - started
    logger.info("%s", summary)
    return summary


def run_readings(
    spark: SparkSession,
    raw: DataFrame,
    output_path: str,
    rules: RuleSet | DataFrame,
    mode: str = "overwrite",
    quarantine: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> Summary:
    """The batch job over raw readings; ``rules`` is a compiled set or a normalised table.

    The raw input is read once: rejects are counted on the way, and with ``quarantine`` the
    marked rows are staged so that both sides come from them. The scanned readings and the
    hits are staged; all outputs are read from those and published together.
    """
    summary = Summary()
    staging = Staging(spark)
    seen = Observation()
    try:
        with Publication(spark, output_path, OUTPUTS, mode) as publication:
            if any(name not in raw.columns for name in MANDATORY):
                parts = sanitize(raw)
            else:
                marked = counted(mark(raw), seen)
                parts = split(staging(marked, "marked") if quarantine else marked)
            clean = parts.clean.select("timestamp", "sensor_id", "value", "seq")
            if isinstance(rules, RuleSet):
                result = evaluate(clean, rules, slice_rows=slice_rows, stage=staging)
            else:
                result = relational.evaluate(clean, rules, slice_rows=slice_rows, stage=staging)
            summary.rows = result.readings.count()
            summary.alarms = write_alarms(result.alarms, publication.path("alarms"))
            summary.nominal = write_nominal(result.valid, publication.path("valid_data"), stage=staging)
            counts = observed_row(seen)
            summary.rejects = {r: counts[r] for r in REASONS if counts.get(r)}
            if quarantine and summary.rejects:
                parts.rejects.write.parquet(publication.path("quarantine"))
    finally:
        staging.drop()
    if summary.rejects:
        logger.warning("rejected rows: %s", summary.rejects)
    return summary


def _rule_table(spark: SparkSession, path: str) -> DataFrame:
    valid, rejects = normalise_rules(load_rules(spark, path))
    for row in rejects.groupBy("reason").count().collect():
        logger.warning("%s rules dropped: %s", row["count"], row.reason)
    return valid


def _rules(spark: SparkSession, path: str) -> RuleSet:
    valid, rejects = normalise_rules(load_rules(spark, path))
    for row in rejects.collect():
        logger.warning("rule %s dropped: %s", row.rule_id, row.reason)
    rules = RuleSet.collect(valid)
    for rule_id in rules.cyclic:
        logger.warning("rule %s dropped: cyclic conditions", rule_id)
    return rules


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Telemetry rule monitoring")
    parser.add_argument("--input_path", required=True)
    parser.add_argument("--output_path", required=True)
    parser.add_argument("--rules_path", required=True)
    parser.add_argument("--sensors_path", required=True)
    parser.add_argument("--format", choices=("csv", "json"), default="csv")
    parser.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    parser.add_argument("--quarantine", action="store_true", help="also write rejected rows")
    parser.add_argument("--slice_rows", type=int, default=SLICE_ROWS, help="readings per arrival slice")
    parser.add_argument("--rules_as_table", action="store_true", help="join rules instead of compiling them")
    parser.add_argument("--stream", action="store_true", help="incremental run with state")
    parser.add_argument("--delay_seconds", type=int, default=0)
    parser.add_argument("--max_files_per_trigger", type=int)
    parser.add_argument("--trigger", help="keep running with this interval, such as '10 seconds'")
    parser.add_argument("--state_store", action="store_true", help="stream with the state in Spark's state store")
    parser.add_argument("--flush", action="store_true", help="close held timestamps at the end")
    args = parser.parse_args(argv)
    if args.slice_rows <= 0:
        parser.error("slice_rows must be positive")
    spark = SparkSession.builder.appName("telewarden").getOrCreate()
    if not args.stream:
        run(
            spark, args.input_path, args.output_path, args.rules_path, args.sensors_path,
            args.format, args.mode, args.quarantine, args.slice_rows, args.rules_as_table,
        )
        Staging.drop_all()
        return
    sensors = load_sensors(spark, args.sensors_path).count()
    rules = _rules(spark, args.rules_path)
    if args.state_store:
        monitor = KeyedMonitor(
            spark, rules, args.output_path, f"{args.output_path}/checkpoint", args.delay_seconds, args.slice_rows, text=True
        )
    else:
        monitor = Monitor(
            spark, rules, args.output_path, f"{args.output_path}/state", args.delay_seconds, sensors, args.slice_rows, text=True
        )
    stream = read_stream(spark, args.input_path, args.format, args.max_files_per_trigger)
    monitor.start(stream, f"{args.output_path}/checkpoint", args.trigger).awaitTermination()
    if args.flush:
        monitor.flush()
