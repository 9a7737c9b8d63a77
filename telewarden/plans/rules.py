"""Rule catalogue: normalise, reject, order, and hold for plan building."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_known_priority, normal_priority, op_column, priority_rank
from ..schemas import RULES

BASE_TYPES = ("simple", "step_difference", "stateful")
UNKNOWN_SENSOR = "UNKNOWN"


def normalise_rules(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a raw catalogue into usable rules and rejects with a reason.

    A priority outside LOW/MEDIUM/HIGH or a logic outside AND/OR drops the rule, so a
    correlation naming it later sees an unknown condition.
    """
    first = Window.partitionBy("rule_id").orderBy("pos")
    is_correlation = F.col("type") == "correlation"
    rules = raw.select(
        "rule_id",
        "type",
        "sensor_id",
        "operator",
        "value",
        "consecutive_measurements",
        F.upper("logic").alias("logic"),
        "conditions",
        normal_priority(F.col("priority")).alias("priority"),
        "pos",
    )
    reason = (
        F.when(~is_known_priority(F.col("priority")), "invalid_priority")
        .when(F.col("rule_id").isNull(), "missing_field")
        .when(
            F.col("type").isNull() | ~F.col("type").isin(*BASE_TYPES, "correlation"),
            "unknown_type",
        )
        .when(
            is_correlation & ~F.coalesce(F.col("logic"), F.lit("")).isin("AND", "OR"),
            "invalid_logic",
        )
        .when(
            is_correlation & (F.coalesce(F.size("conditions"), F.lit(0)) <= 0),
            "no_conditions",
        )
        .when(
            ~is_correlation & (F.col("sensor_id").isNull() | F.col("value").isNull()),
            "missing_field",
        )
        .when(
            (F.col("type") == "stateful")
            & (F.coalesce("consecutive_measurements", F.lit(0)) < 1),
            "invalid_consecutive",
        )
    )
    judged = rules.withColumn("reason", reason)
    usable = judged.filter(F.col("reason").isNull()).withColumn(
        "copy", F.row_number().over(first)
    )
    valid = usable.filter("copy = 1").drop("copy", "reason")
    repeated = usable.filter("copy > 1").withColumn("reason", F.lit("duplicate_id"))
    rejects = (
        judged.filter(F.col("reason").isNotNull())
        .unionByName(repeated.drop("copy"))
        .select("rule_id", "reason", "pos")
    )
    return valid, rejects


def order_rules(valid: DataFrame) -> DataFrame:
    """High priority first, file order within a priority."""
    return valid.orderBy(priority_rank(F.col("priority")).desc(), "pos")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    type: str
    priority: str
    sensor_id: str | None = None
    operator: str | None = None
    value: float | None = None
    consecutive_measurements: int | None = None
    logic: str | None = None
    conditions: tuple[str, ...] = ()

    def holds(self, measure: Column) -> Column:
        return op_column(measure, self.operator, self.value)


@dataclass(frozen=True)
class RuleSet:
    """An ordered, valid catalogue on the driver: configuration, not data."""

    base: tuple[Rule, ...] = ()
    correlations: tuple[Rule, ...] = ()
    cyclic: tuple[str, ...] = ()
    by_id: dict[str, Rule] = field(default_factory=dict)

    @classmethod
    def of(cls, rules: Iterable[Rule]) -> RuleSet:
        rules = list(rules)
        base = tuple(r for r in rules if r.type in BASE_TYPES)
        waiting = {r.rule_id: r for r in rules if r.type == "correlation"}
        ordered: list[Rule] = []
        while waiting:
            ready = [
                r for r in waiting.values() if not any(c in waiting for c in r.conditions)
            ]
            if not ready:
                break
            for rule in ready:
                ordered.append(waiting.pop(rule.rule_id))
        by_id = {r.rule_id: r for r in (*base, *ordered)}
        return cls(base, tuple(ordered), tuple(sorted(waiting)), by_id)

    @classmethod
    def collect(cls, valid: DataFrame) -> RuleSet:
        """Bring a normalised catalogue to the driver, as the compiled form needs it.

        Every rule becomes an expression of the plan. A catalogue of many hundreds of rules is
        better judged as a table (``relational.evaluate``), which leaves it in Spark.
        """
        rows = order_rules(valid).collect()
        return cls.of(
            Rule(
                row.rule_id,
                row.type,
                row.priority,
                row.sensor_id,
                row.operator,
                row.value,
                row.consecutive_measurements,
                row.logic,
                tuple(row.conditions or ()),
            )
            for row in rows
        )

    def of_type(self, kind: str) -> list[Rule]:
        return [r for r in self.base if r.type == kind]

    def by_sensor(self) -> dict[str, list[Rule]]:
        groups: dict[str, list[Rule]] = {}
        for rule in self.base:
            groups.setdefault(rule.sensor_id, []).append(rule)
        return groups

    def sensor_numbers(self) -> dict[str, int]:
        """A small number for every sensor some rule looks at."""
        sensors = {r.sensor_id for r in self.base}
        sensors.update(s for r in self.correlations for s in self.parent_sensors(r))
        return {sensor: number for number, sensor in enumerate(sorted(sensors))}

    def watch(self) -> Column:
        """The number of the reading's sensor; all unwatched sensors share -1.

        Text is compared once per reading; windows, sorts and rule tests use the number.
        """
        case = F
        for sensor, number in self.sensor_numbers().items():
            case = case.when(F.col("sensor_id") == sensor, F.lit(number))
        return F.lit(-1) if case is F else case.otherwise(F.lit(-1))

    def streak_slots(self) -> list[dict[str, Rule]]:
        """Stateful rules laid out so that each slot has at most one rule per sensor.

        The scan then needs one running column per slot, not one per rule.
        """
        slots: list[dict[str, Rule]] = []
        for rule in self.of_type("stateful"):
            free = next((s for s in slots if rule.sensor_id not in s), None)
            if free is None:
                free = {}
                slots.append(free)
            free[rule.sensor_id] = rule
        return slots

    def parent_sensors(self, rule: Rule) -> list[str]:
        """Sensors behind a correlation, in condition order, nested ones flattened."""
        sensors: list[str] = []
        for condition in rule.conditions:
            parent = self.by_id.get(condition)
            if parent is None:
                sensors.append(UNKNOWN_SENSOR)
            elif parent.type == "correlation":
                sensors.extend(self.parent_sensors(parent))
            else:
                sensors.append(parent.sensor_id)
        return sensors

    def correlation_hits(self, fired: dict[str, Column]) -> dict[str, Column]:
        """Condition of each correlation, given one column per fired base rule."""
        outcome = dict(fired)
        hits: dict[str, Column] = {}
        for rule in self.correlations:
            parts = [outcome.get(c, F.lit(False)) for c in rule.conditions]
            join = (lambda a, b: a & b) if rule.logic == "AND" else (lambda a, b: a | b)
            hits[rule.rule_id] = outcome[rule.rule_id] = reduce(join, parts)
        return hits


def rules_frame(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """Raw catalogue from plain dictionaries, as the JSON loader would give it."""
    names = RULES.fieldNames()
    rows = [(*(rule.get(name) for name in names), pos) for pos, rule in enumerate(rules)]
    schema = T.StructType([*RULES.fields, T.StructField("pos", T.LongType())])
    return spark.createDataFrame(rows, schema)


def compile_rules(raw: DataFrame) -> RuleSet:
    return RuleSet.collect(normalise_rules(raw)[0])
