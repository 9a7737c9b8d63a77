"""Bench: registered queries at one scale, and the whole job from CSV to both outputs.

Prints one JSON line. The job input has 12 sensors and 20 rules, about one reading in seven an alarm;
it is lineitem copied until it has about BENCH_JOB_ROWS readings, written as CSV before the clock
starts. BENCH_ONLY=job or queries runs one half.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from telewarden import queries as q  # noqa: E402
from telewarden.job import run_readings  # noqa: E402
from telewarden.operators.numbering import row_numbers  # noqa: E402
from telewarden.plans.rules import Rule, RuleSet  # noqa: E402
from telewarden.prep import replicate  # noqa: E402
from telewarden.session import Staging, local_session  # noqa: E402
from telewarden.sources import read_csv  # noqa: E402

HEADLINE = [
    "simple_rule", "step_difference", "segmented_step", "stateful_streak", "segmented_streak",
    "corr_and", "nominal_packed", "alarms_sorted", "orders_alarms", "orders_nominal",
    "sanitize_clean", "rules_table_join", "rules_table_alarms", "completeness_report",
    "replicated_alarms", "retime",
]

SENSORS = [f"N{i:02d}" for i in range(12)]


def job_rules() -> RuleSet:
    """Nine simple, five stateful, four step rules and two correlations over quantities from 1 to 50."""
    levels = ("LOW", "MEDIUM", "HIGH")
    rules = [Rule(f"above_{s}", "simple", levels[i % 3], s, ">", 49.0) for i, s in enumerate(SENSORS[:9])]
    rules += [Rule(f"low_{s}", "stateful", "MEDIUM", s, "<", 15.0, 2) for s in SENSORS[4:9]]
    rules += [Rule(f"jump_{s}", "step_difference", "LOW", s, ">", 40.0) for s in SENSORS[8:]]
    rules.append(Rule("both_1", "correlation", "HIGH", logic="AND", conditions=("above_N00", "low_N05")))
    rules.append(Rule("both_2", "correlation", "HIGH", logic="AND", conditions=("jump_N09", "above_N03")))
    return RuleSet.of(rules)


def job_readings(spark, sf_dir: str, staging: Staging):
    """Lineitem as readings: a timestamp for every twelve rows, one row for each sensor."""
    lines = q.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), F.col("l_quantity").alias("value")
    )
    numbered = row_numbers(lines, staging)
    moment = F.timestamp_seconds(F.lit(1_900_000_000) + F.floor(F.col("row") / len(SENSORS)))
    names = F.array(*(F.lit(s) for s in SENSORS))
    return numbered.select(
        F.col("row").alias("seq"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        names[(F.col("row") % len(SENSORS)).cast("int")].alias("sensor_id"),
        F.col("value").cast("double").cast("string").alias("value"),
        F.lit("LOW").alias("priority"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    job_rows = int(os.environ.get("BENCH_JOB_ROWS", "10000000"))
    only = os.environ.get("BENCH_ONLY", "")
    spark = local_session(cpus, partitions=max(8, int(cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - started, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    drain(q.QUERIES["alarms_sorted"](spark, sf_dir))  # start up the JVM
    for name in HEADLINE if only != "job" else []:
        timed(name, lambda name=name: drain(q.QUERIES[name](spark, sf_dir)))
    Staging.drop_all()

    rates = {}
    if only != "queries":
        staging = Staging(spark)
        rules = job_rules()
        body = staging(job_readings(spark, sf_dir, staging), "body")
        count = body.count()
        targets = (min(1_000_000, job_rows), job_rows)
        for copies in sorted({max(1, round(target / count)) for target in targets}):
            source = f"{staging.root}/csv_{copies}"
            copied = replicate(body, copies, count, 2_592_000)
            copied.orderBy("seq").select("timestamp", "sensor_id", "value", "priority").write.option(
                "header", True
            ).csv(source)
            name = f"job_{copies * count // 1000}k_rows"
            timed(name, lambda: run_readings(spark, read_csv(spark, source), f"{staging.root}/out_{copies}", rules))
            rates[name] = round(copies * count / times[name])
        Staging.drop_all()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_second": rates,
                "rows_per_second_and_core": {k: round(v / int(cpus)) for k, v in rates.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
