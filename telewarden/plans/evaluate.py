"""Evaluate a compiled rule catalogue over telemetry.

Rules become column expressions. Which rules fired on a reading is kept as bits. Readings on
which any did are the hits; "which rules fired at this timestamp" is a mergeable ``bit_or`` over
them, and no timestamp is ever collected. All outputs follow from the readings and the hits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import PRIORITY_RANK, fmt_value, quoted
from ..operators.scan import Scan, Stage, State, scan, state_out
from .rules import Rule, RuleSet

# Rows per arrival slice.
SLICE_ROWS = 100_000
# Rules per word of fired bits.
WORD = 62


@dataclass
class Result:
    """Lazy outcome of an evaluation; each frame is planned when asked for."""

    fired: DataFrame
    scanned: Scan
    rules: RuleSet
    state_in: State | None = None
    stage: Stage | None = None

    @property
    def readings(self) -> DataFrame:
        return self.scanned.readings

    @cached_property
    def hits(self) -> DataFrame:
        """Readings on which a base rule fired, with the fired bits."""
        columns = ("timestamp", "watch", "value", "seq", *words(self.rules))
        hits = self.fired.filter(any_fired(self.rules)).select(*columns)
        return self.stage(hits, "hits") if self.stage else hits

    @cached_property
    def anomalous(self) -> DataFrame:
        """Timestamps with any alarm."""
        return self.hits.select("timestamp").distinct()

    @cached_property
    def found(self) -> DataFrame:
        """Alarms of base and correlation rules, in no order."""
        alarms = base_alarms(self.hits, self.rules)
        if self.rules.correlations:
            facts = timestamp_facts(self.hits, self.rules)
            firsts = first_values(self.scanned.readings, self.rules)
            alarms = alarms.unionByName(correlation_alarms(facts, firsts, self.rules))
        return self.stage(alarms, "alarms") if self.stage else alarms

    @cached_property
    def alarms(self) -> DataFrame:
        """Sorted alarms. The range sort reads its input twice, hence the staging."""
        return sort_alarms(self.found)

    @cached_property
    def valid(self) -> DataFrame:
        """Readings of timestamps without any alarm."""
        return nominal_rows(self.scanned.readings, self.anomalous)

    @cached_property
    def state_out(self) -> State:
        return state_out(self.scanned, self.rules, self.state_in)


def evaluate(
    df: DataFrame,
    rules: RuleSet,
    state: State | None = None,
    slice_rows: int | None = SLICE_ROWS,
    stage: Stage | None = None,
) -> Result:
    """Judge ``df`` (timestamp, sensor_id, value, seq, ...) by a compiled catalogue.

    ``stage`` writes the scanned readings, the hits and the unsorted alarms once so that the
    outputs share them; without it every output is an independent lazy plan.
    """
    scanned = scan(df, rules, state, slice_rows, stage)
    return Result(fire(scanned.rows, rules), scanned, rules, state, stage)


def words(rules: RuleSet) -> list[str]:
    """Names of the columns holding the fired bits."""
    return [f"fired_{i}" for i in range(0, len(rules.base) // WORD + 1)]


def fire(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """Set the bit of every base rule that fires on the reading.

    Only the rules of the reading's own sensor are tested.
    """
    place = {rule.rule_id: divmod(i, WORD) for i, rule in enumerate(rules.base)}
    slot_of = {
        rule.rule_id: j for j, slot in enumerate(rules.streak_slots()) for rule in slot.values()
    }
    numbers = rules.sensor_numbers()
    zero = F.lit(0).cast("bigint")
    columns = {}
    for number, name in enumerate(words(rules)):
        case = F
        for sensor, group in rules.by_sensor().items():
            bits = zero
            for rule in group:
                word, bit = place[rule.rule_id]
                if word == number:
                    bits = bits + F.when(
                        _fires(rule, slot_of), F.lit(1 << bit).cast("bigint")
                    ).otherwise(zero)
            if bits is not zero:
                case = case.when(F.col("watch") == numbers[sensor], bits)
        columns[name] = zero if case is F else case.otherwise(zero)
    return rows.withColumns(columns).drop(
        "diff", *(f"streak_{j}" for j in range(len(rules.streak_slots())))
    )


def any_fired(rules: RuleSet) -> Column:
    test = F.lit(False)
    for name in words(rules):
        test = test | (F.col(name) != 0)
    return test


def base_alarms(hits: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per (base rule, reading).

    The rule tells the sensor's name, so the readings' own need not be shuffled along.
    """
    return hits.select(
        "timestamp",
        fmt_value("value").alias("value"),
        "seq",
        F.expr(f"inline({_fired_rules(rules)})").alias(
            "rule_id", "priority", "sensor_id", "rank", "bit"
        ),
    ).select("timestamp", "rule_id", "priority", "sensor_id", "value", "rank", "seq")


def timestamp_facts(hits: DataFrame, rules: RuleSet) -> DataFrame:
    """Fired bits per timestamp, combined before the shuffle."""
    return hits.groupBy("timestamp").agg(*(F.bit_or(name).alias(name) for name in words(rules)))


def first_values(readings: DataFrame, rules: RuleSet) -> DataFrame:
    """Per timestamp the first reading of each parent sensor.

    Every aggregate has a fixed size and is combined before the shuffle, so one
    timestamp may hold any share of the data.
    """
    numbers = rules.sensor_numbers()
    parents = _parents(rules)
    return (
        readings.filter(F.col("watch").isin([numbers[s] for s in parents]))
        .groupBy("timestamp")
        .agg(
            *(
                F.min_by("value", F.when(F.col("watch") == numbers[s], F.col("seq"))).alias(f"first_{i}")
                for i, s in enumerate(parents)
            )
        )
    )


def correlation_alarms(facts: DataFrame, firsts: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per (correlation rule, timestamp) at which it holds.

    Facts and first values have one row per timestamp, so their join has no hot key.
    """
    place = {sensor: i for i, sensor in enumerate(_parents(rules))}
    bits = {
        rule.rule_id: F.expr(f"getbit(fired_{i // WORD}, {i % WORD}) = 1")
        for i, rule in enumerate(rules.base)
    }
    hits = rules.correlation_hits(bits)
    holding = facts.filter(reduce(or_, hits.values()))
    shown = holding.join(firsts, "timestamp", "left").withColumns(
        {
            f"text_{i}": F.coalesce(fmt_value(f"first_{i}"), F.lit("NaN"))
            for i in place.values()
        }
    )
    rows = []
    for rule in rules.correlations:
        sensors = rules.parent_sensors(rule)
        values = ", ".join(f"text_{place[s]}" for s in sensors)
        rows.append(
            F.when(
                hits[rule.rule_id],
                F.expr(
                    f"named_struct('rule_id', {quoted(rule.rule_id)},"
                    f" 'priority', '{rule.priority}', 'sensor_id', {quoted(','.join(sensors))},"
                    f" 'value', concat_ws(',', {values}), 'rank', {PRIORITY_RANK[rule.priority]})"
                ),
            )
        )
    return shown.select(
        "timestamp",
        F.inline(F.array_compact(F.array(*rows))),
        F.lit(None).cast("bigint").alias("seq"),
    )


def sort_alarms(alarms: DataFrame) -> DataFrame:
    """Timestamp, priority from high to low, rule, sensor; arrival breaks ties."""
    return alarms.orderBy(
        "timestamp", F.col("rank").desc(), "rule_id", "sensor_id", "seq"
    ).select("timestamp", "rule_id", "priority", "sensor_id", "value")


def nominal_rows(readings: DataFrame, anomalous: DataFrame) -> DataFrame:
    """Readings of timestamps without any alarm, with ``slice`` for packing.

    Anomalous timestamps are distinct, so a hot timestamp is hot on the readings' side alone,
    where Spark can split it.
    """
    return readings.join(anomalous, "timestamp", "left_anti").drop("watch")


def _fires(rule: Rule, slot_of: dict[str, int]) -> Column:
    if rule.type == "simple":
        return rule.holds(F.col("value"))
    if rule.type == "step_difference":
        return rule.holds(F.col("diff"))
    return F.col(f"streak_{slot_of[rule.rule_id]}") >= rule.consecutive_measurements


def _fired_rules(rules: RuleSet) -> str:
    """Array of the rules whose bit is set, looked up among the sensor's own rules."""
    place = {rule.rule_id: divmod(i, WORD) for i, rule in enumerate(rules.base)}
    numbers = rules.sensor_numbers()
    cases = []
    for sensor, group in rules.by_sensor().items():
        found = []
        for number, name in enumerate(words(rules)):
            entries = ", ".join(
                f"named_struct('rule_id', {quoted(rule.rule_id)}, 'priority', '{rule.priority}',"
                f" 'sensor_id', {quoted(sensor)}, 'rank', {PRIORITY_RANK[rule.priority]},"
                f" 'bit', {place[rule.rule_id][1]})"
                for rule in group
                if place[rule.rule_id][0] == number
            )
            if entries:
                found.append(f"filter(array({entries}), r -> getbit({name}, r.bit) = 1)")
        case = found[0] if len(found) == 1 else f"concat({', '.join(found)})"
        cases.append(f"WHEN watch = {numbers[sensor]} THEN {case}")
    fields = "rule_id:string,priority:string,sensor_id:string,rank:int,bit:int"
    none = f"cast(array() AS array<struct<{fields}>>)"
    return f"CASE {' '.join(cases)} ELSE {none} END" if cases else none


def _parents(rules: RuleSet) -> list[str]:
    return sorted({s for rule in rules.correlations for s in rules.parent_sensors(rule)})
