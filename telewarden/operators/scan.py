"""Per-sensor scan in arrival order: step differences and breach streaks.

A sensor may hold a large share of all readings, so a window over a whole sensor would
be one giant task. The scan works on (sensor, arrival slice) groups instead: a slice is
a bounded range of ``seq``. Inside a group plain windows do the work; what crosses a
slice edge is carried by a summary with one row per (sensor, slice), and what crosses a
block of slices by one with a row per (sensor, block). Sensors go by their number
(``watch``); those without any rule share one number.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import slice_of
from .numbering import row_numbers, running_sum
from ..plans.rules import RuleSet

Stage = Callable[[DataFrame, str], DataFrame]

# A staged summary of at most this many bytes is broadcast.
BROADCAST_BYTES = 64 << 20
# A fixed-width column of a broadcast row takes eight bytes, and as many for the table around it.
ROW_BYTES = 16
# Slices per block of the summary.
BLOCK_SLICES = 4096


@dataclass(frozen=True)
class State:
    """Carried state; both frames have at most one row per rule of the catalogue."""

    step: DataFrame
    streak: DataFrame


@dataclass(frozen=True)
class Scan:
    """``rows``: readings with ``watch``, ``slice``, ``diff`` and a ``streak_<slot>`` per slot.

    ``readings`` are the same rows without the scan, for those who need no scan column.
    """

    rows: DataFrame
    readings: DataFrame
    summary: DataFrame | None


def scan(
    df: DataFrame,
    rules: RuleSet,
    state: State | None = None,
    slice_rows: int | None = None,
    stage: Stage | None = None,
) -> Scan:
    """Add scan columns. ``slice_rows=None`` is the plain per-sensor window."""
    whole = F.lit(0).cast("bigint")
    sliced = df.withColumns(
        {
            "watch": rules.watch(),
            "slice": whole if slice_rows is None else slice_of(F.col("seq"), slice_rows),
        }
    )
    slots = rules.streak_slots()
    if not slots and not rules.of_type("step_difference"):
        rows = stage(sliced, "scanned") if stage else sliced
        return Scan(rows, rows, None)

    if stage and slice_rows is not None:
        # Whole slices per task: a timestamp's sensors stay together in the staged table,
        # so that later per-timestamp aggregates combine almost fully before a shuffle.
        sliced = sliced.repartition("slice")
    scanned = _inside_slices(sliced, rules)
    if stage:
        scanned = stage(scanned, "scanned")
    block_rows = None if slice_rows is None else slice_rows * BLOCK_SLICES
    summary = across_slices(scanned, len(slots), _entry_state(rules, state), block_rows)
    if stage:
        summary = stage(summary, "summary")
    carry = summary.select(
        "watch", "slice", "entry_value", *(f"entry_{j}" for j in range(len(slots)))
    )
    if stage and summary.count() * ROW_BYTES * len(carry.columns) <= BROADCAST_BYTES:
        carry = F.broadcast(carry)
    joined = scanned.join(carry, ["watch", "slice"])
    before = F.coalesce(F.col("previous"), F.col("entry_value"), F.col("value"))
    streaks = {
        f"streak_{j}": F.when(
            F.col(f"last_ok_{j}").isNull(), F.col("rn") + F.col(f"entry_{j}")
        ).otherwise(F.col("rn") - F.col(f"last_ok_{j}"))
        for j in range(len(slots))
    }
    rows = joined.withColumns({"diff": F.col("value") - before, **streaks}).drop(
        "previous",
        "rn",
        "entry_value",
        *(f"last_ok_{j}" for j in range(len(slots))),
        *(f"entry_{j}" for j in range(len(slots))),
    )
    readings = scanned.select(*df.columns, "watch", "slice") if stage else sliced
    return Scan(rows, readings, summary)


def state_out(scanned: Scan, rules: RuleSet, state: State | None) -> State:
    """State after the readings: last value per step sensor, streak per stateful rule.

    A sensor without readings keeps what it had.
    """
    spark = scanned.rows.sparkSession
    step_sensors = sorted({r.sensor_id for r in rules.of_type("step_difference")})
    slots = rules.streak_slots()
    if scanned.summary is None:
        empty = spark.createDataFrame([], "sensor_id string, last_value double")
        none = spark.createDataFrame([], "rule_id string, sensor_id string, streak bigint")
        return State(state.step if state else empty, state.streak if state else none)
    sensors = rules.sensor_numbers()
    last = scanned.summary.groupBy("watch").agg(
        F.max_by("last_value", "slice").alias("last_value"),
        *(F.max_by(f"exit_{j}", "slice").alias(f"exit_{j}") for j in range(len(slots))),
    )
    names = F.array(*(F.lit(s) for s in sensors))
    last = last.filter("watch >= 0").withColumn("sensor_id", F.get(names, F.col("watch")))
    step = last.filter(F.col("sensor_id").isin(step_sensors)).select("sensor_id", "last_value")
    entries = [
        F.when(
            F.col("watch") == sensors[sensor],
            F.struct(F.lit(rule.rule_id).alias("rule_id"), F.col(f"exit_{j}").alias("streak")),
        )
        for j, slot in enumerate(slots)
        for sensor, rule in slot.items()
    ]
    if entries:
        streak = last.select(
            "sensor_id", F.explode(F.array_compact(F.array(*entries))).alias("entry")
        ).select("entry.rule_id", "sensor_id", "entry.streak")
    else:
        streak = spark.createDataFrame([], "rule_id string, sensor_id string, streak bigint")
    if state is not None:
        step = keep_old(step, state.step, ["sensor_id"], "last_value")
        streak = keep_old(streak, state.streak, ["rule_id", "sensor_id"], "streak")
    return State(step, streak)


def _inside_slices(sliced: DataFrame, rules: RuleSet) -> DataFrame:
    """Windows inside a (slice, sensor) group: one exchange, one sort.

    The slice comes first in the sort, so that readings of one time stay close together.
    """
    w = Window.partitionBy("slice", "watch").orderBy("seq")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = sliced.withColumns(
        {"previous": F.lag("value").over(w), "rn": F.row_number().over(w).cast("bigint")}
    )
    numbers = rules.sensor_numbers()
    last_ok = {
        f"last_ok_{j}": F.max(F.when(~_breach(slot, numbers), F.col("rn"))).over(so_far)
        for j, slot in enumerate(rules.streak_slots())
    }
    return numbered.withColumns(last_ok) if last_ok else numbered


def _breach(slot: dict, numbers: dict[str, int]) -> Column:
    case = F
    for sensor, rule in slot.items():
        case = case.when(F.col("watch") == numbers[sensor], rule.holds(F.col("value")))
    return case.otherwise(F.lit(False))


def across_slices(
    scanned: DataFrame, slots: int, entry: DataFrame | None, block_rows: int | None
) -> DataFrame:
    """One row per (sensor, slice): what enters and leaves it.

    entry_<j> counts the breaches right before the slice, so it is the rows since the
    last good reading of any earlier slice, plus the carried streak if there is none.
    Rows and good readings are counted inside blocks of slices first, then over blocks,
    so no window holds more than a block of slices or all blocks of a sensor.
    """
    parts = scanned.groupBy("watch", "slice").agg(
        # Counting a column keeps both readers of the slices on the same shuffle.
        F.count("timestamp").alias("n"),
        F.max_by("value", "seq").alias("last_value"),
        *(F.max(f"last_ok_{j}").alias(f"last_ok_{j}") for j in range(slots)),
    )
    return across_parts(parts, slots, entry, block_rows)


def across_parts(parts: DataFrame, slots: int, entry: DataFrame | None, block_rows: int | None) -> DataFrame:
    """``across_slices`` for slices summed up already: ``n``, ``last_value`` and ``last_ok_<j>`` by (watch, slice)."""
    block = F.lit(0).cast("bigint") if block_rows is None else slice_of(F.col("slice"), block_rows)
    inside = Window.partitionBy("watch", "block").orderBy("slice")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("block", block).withColumns(
        {
            "in_before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
            "in_value": F.lag("last_value").over(inside),
        }
    )
    parts = parts.withColumns(
        {
            f"in_good_{j}": F.max(F.col("in_before") + F.col(f"last_ok_{j}")).over(earlier)
            for j in range(slots)
        }
    )
    blocks = parts.groupBy("watch", "block").agg(
        F.sum("n").alias("n"),
        F.max_by("last_value", "slice").alias("last_value"),
        *(
            F.max(F.col("in_before") + F.col(f"last_ok_{j}")).alias(f"good_{j}")
            for j in range(slots)
        ),
    )
    over = Window.partitionBy("watch").orderBy("block")
    sooner = over.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns(
        {
            "rows_before": F.coalesce(F.sum("n").over(sooner), F.lit(0)),
            "block_value": F.lag("last_value").over(over),
        }
    )
    blocks = blocks.select(
        "watch", "block", "rows_before", "block_value",
        *(
            F.max(F.col("rows_before") + F.col(f"good_{j}")).over(sooner).alias(f"good_{j}")
            for j in range(slots)
        ),
    )
    if entry is not None:
        blocks = blocks.join(entry, "watch", "left")
    else:
        blocks = blocks.withColumns(
            {
                "state_value": F.lit(None).cast("double"),
                **{f"state_{j}": F.lit(0).cast("bigint") for j in range(slots)},
            }
        )
    placed = parts.join(blocks, ["watch", "block"]).withColumn(
        "entry_value", F.coalesce("in_value", "block_value", "state_value")
    )
    before = F.col("rows_before") + F.col("in_before")
    for j in range(slots):
        good = F.greatest(F.col(f"good_{j}"), F.col("rows_before") + F.col(f"in_good_{j}"))
        carried = -F.coalesce(F.col(f"state_{j}"), F.lit(0).cast("bigint"))
        placed = placed.withColumn(f"entry_{j}", before - F.coalesce(good, carried))
    exits = {
        f"exit_{j}": F.when(
            F.col(f"last_ok_{j}").isNull(), F.col("n") + F.col(f"entry_{j}")
        ).otherwise(F.col("n") - F.col(f"last_ok_{j}"))
        for j in range(slots)
    }
    return placed.withColumns(exits).select(
        "watch",
        "slice",
        "last_value",
        "entry_value",
        *(f"entry_{j}" for j in range(slots)),
        *(f"exit_{j}" for j in range(slots)),
    )


def _entry_state(rules: RuleSet, state: State | None) -> DataFrame | None:
    """Carried state, one row per sensor of the catalogue (hence small)."""
    if state is None:
        return None
    slots = rules.streak_slots()
    empty = [F.lit(None).cast("bigint").alias(f"state_{j}") for j in range(len(slots))]
    step = state.step.select("sensor_id", F.col("last_value").alias("state_value"), *empty)
    streak = state.streak.select(
        "sensor_id",
        F.lit(None).cast("double").alias("state_value"),
        *(
            F.when(F.col("rule_id").isin([r.rule_id for r in slot.values()]), F.col("streak"))
            .alias(f"state_{j}")
            for j, slot in enumerate(slots)
        ),
    )
    return (
        step.unionByName(streak)
        .withColumn("watch", rules.watch())
        .filter("watch >= 0")
        .groupBy("watch")
        .agg(
            F.max("state_value").alias("state_value"),
            *(F.max(f"state_{j}").alias(f"state_{j}") for j in range(len(slots))),
        )
    )


def keep_old(new: DataFrame, old: DataFrame, keys: list[str], value: str) -> DataFrame:
    return (
        new.select(*keys, F.col(value).alias("new"))
        .join(old.select(*keys, F.col(value).alias("old")), keys, "full_outer")
        .select(*keys, F.coalesce("new", "old").alias(value))
    )


def islands(df: DataFrame, good: Column, stage: Stage) -> DataFrame:
    """Streaks by another plan: ``streak`` counts the rows since the sensor's last good one.

    Rows are numbered by sensor and arrival, and good rows are summed up along that order. The rows
    after a good one share its sum and are an island, whose streaks are distances from its first row.
    Both sums run over ranges of the order, so no task holds a sensor or an island; an island enters
    the join as one row.
    """
    marked = df.select("sensor_id", "seq", F.coalesce(good, F.lit(False)).alias("is_good"))
    marked = marked.withColumn("weight", F.col("is_good").cast("int"))
    summed = stage(running_sum(marked, ["sensor_id", "seq"], "weight", stage, "sums"), "summed")
    rows = row_numbers(summed, stage, ["sensor_id", "seq"], "numbered")
    rows = rows.withColumn("island", F.col("before") + F.col("weight"))
    first = rows.groupBy("sensor_id", "island").agg(F.min("row").alias("start"), F.max_by("is_good", -F.col("row")).alias("led"))
    # Only the sensor's first island may begin with a row that is not good.
    streak = F.col("row") - F.col("start") + F.when(F.col("led"), 0).otherwise(1)
    return rows.join(first, ["sensor_id", "island"]).select("sensor_id", "seq", streak.alias("streak"))
