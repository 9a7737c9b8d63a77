"""Evaluate a rule catalogue as a table, for catalogues too large to compile.

Rules are joined to the readings by sensor, once for all kinds. Carries between arrival slices are
those of the compiled scan, by sensor for steps and by rule for streaks. The thresholds of a sensor's
simple and step rules are sorted arrays, one for each kind and operator: a reading finds its place in
each by bisection, and only the rules on the right side of it become rows. Stateful rules of one
operator have nested breaches: the last N readings all breach a threshold if their least or greatest
value does, so a sliding extreme finds its place among the thresholds in the same way, and the last
good reading of every threshold follows from the last reading at each place. A rule of "differs" fires
where none of the last N readings equals its threshold. Correlations are joins and
counts over the distinct (timestamp, rule) pairs that fired, one level of nesting after another. No
join carries a hint: Spark broadcasts a rule table whose staged size is below its threshold; else it
shuffles, and splits the readings of a hot sensor.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fmt_value, priority_rank, slice_of
from ..functions.thresholds import OPERATORS
from ..operators.numbering import running_sum
from ..operators.scan import BLOCK_SLICES, Stage, State, across_parts, across_slices, keep_old
from ..session import Staging
from .evaluate import SLICE_ROWS, nominal_rows, sort_alarms
from .rules import UNKNOWN_SENSOR

HIT = ("timestamp", "rule_id", "priority", "sensor_id", "value", "seq")


def simple_hits(df: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per (simple rule, reading) that fires."""
    readings = df.select("timestamp", "sensor_id", "value", "seq").withColumn("diff", F.lit(None).cast("double"))
    return instant_hits(readings, rules.filter("type = 'simple'"))


def instant_hits(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per (simple or step rule, reading with ``diff``) that fires.

    A reading meets one row for each kind and operator that its sensor's rules have; beyond that the
    work follows the rules that fire.
    """
    rules = _wanted(rules.filter(F.col("type").isin("simple", "step_difference") & F.col("operator").isin(*OPERATORS)))
    levels = _levels(rules, "type")
    measure = F.when(F.col("type") == "step_difference", F.col("diff")).otherwise(F.col("value"))
    met = _met(readings.join(_groups(levels, "type"), "sensor_id").withColumn("measure", measure))
    return (
        met.select("timestamp", "sensor_id", "type", "op", "value", "seq", F.explode(_fired_places()).alias("place"))
        .join(levels, ["sensor_id", "type", "op", "place"])
        .select(*HIT)
    )


def _levels(rules: DataFrame, kind: str) -> DataFrame:
    """Rules with their place among those of the same sensor, kind and operator, by threshold.

    The window holds the rules of one sensor, kind and operator: they may be many, but they are no data.
    """
    place = F.row_number().over(Window.partitionBy("sensor_id", kind, "op").orderBy("threshold", "rule_id")) - 1
    return rules.withColumn("place", place)


def _groups(levels: DataFrame, kind: str) -> DataFrame:
    """The sorted thresholds of each sensor, kind and operator, and the steps of a bisection among them."""
    in_order = F.sort_array(F.collect_list(F.struct("place", "threshold")))
    groups = levels.groupBy("sensor_id", kind, "op").agg(in_order["threshold"].alias("thresholds"), F.count("*").cast("int").alias("n"))
    return groups.withColumn("steps", F.expr("transform(sequence(length(bin(n)) - 1, 0, -1), b -> shiftleft(1, b))"))


def _met(rows: DataFrame) -> DataFrame:
    """Rows with a measure and thresholds: how many of these are below it, or up to it, as the operator asks."""
    below, upto = F.col("op").isin(">", "<=", "==", "!="), F.col("op").isin(">=", "<", "==", "!=")
    return rows.withColumns({"below": F.when(below, _found("<")), "upto": F.when(upto, _found("<="))})


def _found(compare: str) -> Column:
    """How many of the sorted thresholds compare so with the measure, by bisection."""
    return F.expr(
        f"""aggregate(steps, 0,
        (at, step) -> if(at + step <= n AND get(thresholds, at + step - 1) {compare} measure, at + step, at))"""
    )


def _fired_places() -> Column:
    """Places of the thresholds that the measure breaches."""

    def span(first: str, end: str) -> str:
        return f"if({end} > {first}, sequence({first}, {end} - 1), cast(array() AS array<int>))"

    return F.expr(
        f"""CASE op WHEN '>' THEN {span('0', 'below')} WHEN '>=' THEN {span('0', 'upto')}
        WHEN '<' THEN {span('upto', 'n')} WHEN '<=' THEN {span('below', 'n')} WHEN '==' THEN {span('below', 'upto')}
        ELSE concat({span('0', 'below')}, {span('upto', 'n')}) END"""
    )


# Operators whose breaches are nested by threshold, or that only equal values breach.
NESTED = (">", ">=", "<", "<=", "==")


def numbered_places(readings: DataFrame, stage: Stage) -> DataFrame:
    """Readings with ``rn`` inside (sensor, slice): adds ``p``, the place among the sensor's readings, from 1."""
    counts = readings.groupBy("sensor_id", "slice").agg(F.count("*").alias("n"))
    summed = stage(running_sum(counts, ["sensor_id", "slice"], "n", stage, "slice_counts"), "slices_before")
    start = summed.groupBy("sensor_id").agg(F.min("before").alias("start"))
    before = summed.join(start, "sensor_id").select("sensor_id", "slice", (F.col("before") - F.col("start")).alias("rows_before"))
    return readings.join(before, ["sensor_id", "slice"]).withColumn("p", F.col("rows_before") + F.col("rn")).drop("rows_before")


def streak_hits(placed: DataFrame, rules: DataFrame, slice_rows: int) -> DataFrame:
    """One row per (nested stateful rule with its ``carried`` streak, reading) that fires.

    Readings are cut into stretches of their sensor; the last ones of a stretch stand before the next
    one too, as many as the longest count needs. There is a sliding extreme for each distinct count.
    """
    counts = sorted(r.n for r in rules.select(F.col("consecutive_measurements").alias("n")).distinct().collect())
    if not counts:
        empty = "timestamp string, rule_id string, priority string, sensor_id string, value double, seq bigint"
        return placed.sparkSession.createDataFrame([], empty)
    rows, halo = max(slice_rows, counts[-1]), counts[-1] - 1
    own = F.floor((F.col("p") - 1) / rows)
    watched = placed.join(rules.select("sensor_id").distinct(), "sensor_id", "left_semi").withColumn("own", own)
    again = F.when(F.col("p") > (F.col("own") + 1) * rows - halo, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))
    spread = watched.select("timestamp", "sensor_id", "value", "seq", "p", "own", F.explode(again).alias("stretch"))
    by = Window.partitionBy("sensor_id", "stretch").orderBy("p")
    extremes = F.array(
        *(
            F.struct(
                F.lit(n).alias("count"),
                F.min("value").over(by.rowsBetween(1 - n, 0)).alias("low"),
                F.max("value").over(by.rowsBetween(1 - n, 0)).alias("high"),
            )
            for n in counts
        )
    )
    slid = spread.withColumn("extremes", extremes).filter("own = stretch").drop("own", "stretch")
    levels = _levels(rules.withColumnRenamed("consecutive_measurements", "count"), "count")
    groups = _groups(levels, "count")
    # Each reading meets a row for each count and operator of its sensor's rules.
    met = slid.join(groups, "sensor_id").withColumn("at", F.filter("extremes", lambda e: e["count"] == F.col("count"))[0])
    low = F.col("op").isin(">", ">=") | ((F.col("op") == "==") & (F.col("at.low") == F.col("at.high")))
    measure = F.when(low, F.col("at.low")).when(F.col("op") != "==", F.col("at.high"))
    met = _met(met.withColumn("measure", measure).filter("measure IS NOT NULL").drop("extremes", "at"))
    places = met.select("timestamp", "sensor_id", "count", "op", "value", "seq", "p", F.explode(_fired_places()).alias("place"))
    # The first readings of a sensor may go on with a streak that was carried in.
    hits = places.join(levels, ["sensor_id", "count", "op", "place"]).filter(F.col("p") + F.col("carried") >= F.col("count"))
    return hits.select(*HIT)


def differs_parts(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """What ``across_parts`` needs of the stateful rules that are not nested, by (rule, slice).

    Only readings that equal a threshold become rows: they are good for "differs". For an operator that
    is unknown all are.
    """
    ends = readings.groupBy("sensor_id", "slice").agg(
        F.count("timestamp").alias("n"), F.max_by("value", "seq").alias("last_value"), F.max("rn").alias("rows")
    )
    known = F.coalesce(F.col("op") == "!=", F.lit(False))
    names = rules.select("rule_id", "sensor_id", known.alias("known"))
    equal = rules.filter(known).select("rule_id", "sensor_id", F.col("threshold").alias("value"))
    good = readings.join(equal, ["sensor_id", "value"]).groupBy("rule_id", "slice").agg(F.max("rn").alias("good"))
    last_ok = F.when(F.col("known"), F.col("good")).otherwise(F.col("rows"))
    parts = ends.join(names, "sensor_id").join(good, ["rule_id", "slice"], "left")
    return parts.select(F.col("rule_id").alias("watch"), "slice", "n", "last_value", last_ok.alias("last_ok_0"))


def differs_hits(readings: DataFrame, rules: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per (stateful rule of "differs", reading) that fires.

    A rule of count N fires where no threshold of its own is among the values of the last N readings. The
    first readings of a slice ask for what entered it. Beyond the values seen the work follows the hits.
    """
    rules = rules.filter("op = '!='").withColumnRenamed("consecutive_measurements", "count")
    counts = sorted(r["count"] for r in rules.select("count").distinct().collect())
    if not counts:
        return readings.filter("false").select("timestamp", F.lit("").alias("rule_id"), F.lit("").alias("priority"), *HIT[3:])
    levels = _levels(rules, "count")
    groups = _groups(levels, "count").drop("steps")
    equal = rules.select("sensor_id", F.col("threshold").alias("value"), F.lit(True).alias("known")).distinct()
    inside = Window.partitionBy("slice", "sensor_id").orderBy("seq")

    def fired(some: DataFrame) -> DataFrame:
        watched = some.join(rules.select("sensor_id").distinct(), "sensor_id", "left_semi")
        marked = watched.join(equal, ["sensor_id", "value"], "left").withColumn("mark", F.when(F.col("known"), F.col("value")))
        seen = F.create_map(*(x for n in counts for x in (F.lit(n), F.collect_set("mark").over(inside.rowsBetween(1 - n, 0)))))
        met = marked.withColumn("seen", seen).join(groups, "sensor_id").withColumn("seen", F.col("seen")[F.col("count")])
        place = F.expr(
            """if(size(seen) = 0, sequence(0, n - 1),
            filter(sequence(0, n - 1), i -> NOT array_contains(seen, get(thresholds, i))))"""
        )
        rows = met.select("timestamp", "sensor_id", "count", "op", "value", "seq", "slice", "rn", F.explode(place).alias("place"))
        return rows.join(levels, ["sensor_id", "count", "op", "place"])

    late = fired(readings).filter(F.col("rn") >= F.col("count"))
    # A window does not look beyond the row, so these alone see what they did among all.
    first = fired(readings.filter(F.col("rn") < counts[-1])).filter(F.col("rn") < F.col("count"))
    early = first.join(entries, ["rule_id", "slice"]).filter(F.col("rn") + F.col("entry_0") >= F.col("count"))
    return late.select(*HIT).unionByName(early.select(*HIT))


def streaks_out(placed: DataFrame, rules: DataFrame) -> DataFrame:
    """rule_id, sensor_id and streak of the nested stateful rules, given with ``carried``, whose sensor has readings.

    For each place among the thresholds the last reading there is kept; the last good reading of a
    threshold is the last one at any place on its good side.
    """
    levels = _levels(rules, "type").select("rule_id", "sensor_id", "type", "op", "threshold", "place", "carried")
    met = _met(placed.withColumn("measure", F.col("value")).join(_groups(levels, "type"), "sensor_id"))
    place = F.when(F.col("op").isin(">", "<="), F.col("below")).when(F.col("op").isin(">=", "<"), F.col("upto"))
    # Any other value is good for an equality: the last reading and the last one of another value decide.
    last = met.groupBy("sensor_id", "op", place.alias("at")).agg(F.max("p").alias("last"))
    ends = placed.groupBy("sensor_id").agg(F.max("p").alias("n"), F.max_by("value", "p").alias("end"))
    other = placed.join(ends, "sensor_id").groupBy("sensor_id").agg(F.max(F.when(F.col("value") != F.col("end"), F.col("p"))).alias("other"))
    ends = ends.join(other, "sensor_id")
    marks = last.filter("op <> '=='").select("sensor_id", "op", "at", "last", F.lit(None).cast("string").alias("rule_id"), F.lit(None).cast("long").alias("carried"))
    asked = levels.filter("op <> '=='").select("sensor_id", "op", F.col("place").alias("at"), F.lit(None).cast("long").alias("last"), "rule_id", "carried")
    both = marks.unionByName(asked)
    # Good for > and >= is what stands at the threshold's place or before it, for < and <= what stands after it.
    up = Window.partitionBy("sensor_id", "op").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("sensor_id", "op").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    good = F.when(F.col("op").isin(">", ">="), F.max("last").over(up)).otherwise(F.max("last").over(down))
    found = both.withColumn("good", good).filter("rule_id IS NOT NULL").select("rule_id", "sensor_id", "good", "carried")
    equal = levels.filter("op = '=='").join(ends, "sensor_id").select(
        "rule_id", "sensor_id", F.when(F.col("threshold") == F.col("end"), F.col("other")).otherwise(F.col("n")).alias("good"), "carried"
    )
    found = found.unionByName(equal).join(ends.select("sensor_id", "n"), "sensor_id")
    streak = F.col("n") - F.coalesce("good", -F.col("carried"))
    return found.select("rule_id", "sensor_id", streak.cast("long").alias("streak"))


@dataclass
class TableResult:
    """Outcome of a catalogue that stays a table; everything shared is staged."""

    readings: DataFrame
    rules: DataFrame
    steps: DataFrame
    instant: DataFrame
    nested: DataFrame
    nested_ends: DataFrame
    differing: DataFrame
    streaks: DataFrame
    state_in: State | None
    stage: Stage

    @cached_property
    def hits(self) -> DataFrame:
        """One row per (base rule, reading) that fires; as many as readings times rules, where most fire."""
        return self.instant.unionByName(self.nested).unionByName(self.differing)

    @cached_property
    def kept_hits(self) -> DataFrame:
        """The hits, staged for those who read them more than once."""
        return self.stage(self.hits, "hits")

    @cached_property
    def found(self) -> DataFrame:
        shown = self.kept_hits.withColumn("value", fmt_value("value"))
        correlated = correlation_alarms(self.readings, self.kept_hits, self.rules, self.stage)
        found = shown.unionByName(correlated).withColumn("rank", priority_rank(F.col("priority")))
        return self.stage(found, "alarms")

    @cached_property
    def alarms(self) -> DataFrame:
        return sort_alarms(self.found)

    @cached_property
    def anomalous(self) -> DataFrame:
        return self.kept_hits.select("timestamp").distinct()

    @cached_property
    def valid(self) -> DataFrame:
        return nominal_rows(self.readings, self.anomalous)

    @cached_property
    def state_out(self) -> State:
        """State after the readings; a sensor without readings keeps what it had."""
        wanted = self.rules.filter("type = 'step_difference'").select("sensor_id").distinct()
        last = self.steps.groupBy(F.col("watch").alias("sensor_id")).agg(F.max_by("last_value", "slice").alias("last_value"))
        step = last.join(wanted, "sensor_id", "left_semi")
        names = self.rules.filter("type = 'stateful'").select("rule_id", "sensor_id")
        ends = self.streaks.groupBy(F.col("watch").alias("rule_id")).agg(F.max_by("exit_0", "slice").alias("streak"))
        streak = names.join(ends, "rule_id").select("rule_id", "sensor_id", "streak").unionByName(self.nested_ends)
        if self.state_in is not None:
            step = keep_old(step, self.state_in.step, ["sensor_id"], "last_value")
            streak = keep_old(streak, self.state_in.streak, ["rule_id", "sensor_id"], "streak")
        return State(step, streak)


def evaluate(
    df: DataFrame, rules: DataFrame, state: State | None = None, slice_rows: int = SLICE_ROWS, stage: Stage | None = None
) -> TableResult:
    """Judge ``df`` by a normalised rule table; the readings are scanned once."""
    stage = stage or Staging(df.sparkSession)
    rules = stage(rules, "rules")
    block_rows = slice_rows * BLOCK_SLICES
    sliced = df.select("timestamp", "sensor_id", "value", "seq").withColumn("slice", slice_of(F.col("seq"), slice_rows))
    inside = Window.partitionBy("slice", "sensor_id").orderBy("seq")
    marks = {"previous": F.lag("value").over(inside), "rn": F.row_number().over(inside).cast("bigint")}
    readings = stage(sliced.withColumns(marks), "readings")
    before = None
    if state is not None:
        before = state.step.select(F.col("sensor_id").alias("watch"), F.col("last_value").alias("state_value"))
    steps = stage(across_slices(readings.withColumn("watch", F.col("sensor_id")), 0, before, block_rows), "steps")
    entry = steps.select(F.col("watch").alias("sensor_id"), "slice", "entry_value")
    stepped = readings.join(entry, ["sensor_id", "slice"]).withColumn(
        "diff", F.col("value") - F.coalesce("previous", "entry_value", "value")
    )
    wanted = _wanted(rules.filter("type = 'stateful'"))
    nested = wanted.filter(F.col("op").isin(*NESTED))
    if state is None:
        nested = nested.withColumn("carried", F.lit(0).cast("bigint"))
    else:
        carried = state.streak.select("rule_id", "sensor_id", F.col("streak").alias("carried"))
        # Staged, so that its size is known and it is no large table to the joins.
        nested = stage(nested.join(carried, ["rule_id", "sensor_id"], "left").fillna(0, ["carried"]), "nested")
    placed = stage(numbered_places(readings.select("timestamp", "sensor_id", "value", "seq", "slice", "rn"), stage), "placed")
    others = wanted.filter(~F.coalesce(F.col("op").isin(*NESTED), F.lit(False)))
    parts = stage(differs_parts(readings, others), "parts")
    if state is not None:
        before = state.streak.select(
            F.col("rule_id").alias("watch"), F.lit(None).cast("double").alias("state_value"), F.col("streak").alias("state_0")
        )
    streaks = stage(across_parts(parts, 1, before, block_rows), "streaks")
    entries = streaks.select(F.col("watch").alias("rule_id"), "slice", "entry_0")
    instant = instant_hits(stepped, rules)
    hits = streak_hits(placed, nested, slice_rows)
    ends = streaks_out(placed, nested)
    differing = differs_hits(readings, others, entries)
    whole = readings.drop("previous", "rn").withColumn("watch", F.lit(-1))
    return TableResult(whole, rules, steps, instant, hits, ends, differing, streaks, state, stage)


def alarms(df: DataFrame, rules: DataFrame, slice_rows: int = SLICE_ROWS, stage: Stage | None = None) -> DataFrame:
    """Sorted alarms of a normalised rule table."""
    return evaluate(df, rules, slice_rows=slice_rows, stage=stage).alarms


def correlation_alarms(readings: DataFrame, hits: DataFrame, rules: DataFrame, stage: Stage) -> DataFrame:
    """Alarms of correlations, with the first value of each sensor behind them.

    Needs only distinct (timestamp, rule) pairs, at most one per rule and timestamp.
    """
    fired = stage(hits.select("timestamp", "rule_id").distinct(), "fired")
    held = []
    sensors = None
    for number, (level, known) in enumerate(correlation_levels(rules, stage)):
        needs = level.select(
            F.col("rule_id").alias("correlation"),
            "logic",
            F.size(F.array_distinct("conditions")).alias("needed"),
            F.explode(F.array_distinct("conditions")).alias("rule_id"),
        )
        now = (
            fired.join(needs, "rule_id")
            .groupBy("timestamp", "correlation", "logic", "needed")
            .agg(F.count("*").alias("count"))
            .filter((F.col("logic") == "OR") | (F.col("count") == F.col("needed")))
            .select("timestamp", F.col("correlation").alias("rule_id"))
        )
        now = stage(now, f"fired_{number}")
        held.append(now)
        fired = fired.unionByName(now)
        sensors = known
    schema = "timestamp string, rule_id string, priority string, sensor_id string, value string, seq bigint"
    if not held:
        return readings.sparkSession.createDataFrame([], schema)
    parents = (
        rules.filter("type = 'correlation'")
        .join(sensors, "rule_id")
        .select("rule_id", "priority", F.posexplode("sensors").alias("place", "sensor_id"))
    )
    firsts = (
        readings.join(parents.select("sensor_id").distinct(), "sensor_id", "left_semi")
        .groupBy("timestamp", "sensor_id")
        .agg(F.min_by("value", "seq").alias("value"))
    )
    shown = F.struct("place", "sensor_id", F.coalesce(fmt_value("value"), F.lit("NaN")).alias("value"))
    return (
        reduce(DataFrame.unionByName, held)
        .join(parents, "rule_id")
        .join(firsts, ["timestamp", "sensor_id"], "left")
        .groupBy("timestamp", "rule_id", "priority")
        .agg(F.sort_array(F.collect_list(shown)).alias("parents"))  # as long as the rule's conditions
        .select(
            "timestamp",
            "rule_id",
            "priority",
            F.array_join("parents.sensor_id", ",").alias("sensor_id"),
            F.array_join("parents.value", ",").alias("value"),
            F.lit(None).cast("bigint").alias("seq"),
        )
    )


def correlation_levels(rules: DataFrame, stage: Stage):
    """Correlations by depth, each level with the sensors behind every rule known by then.

    A rule's turn comes when its conditions are known or named nowhere in the catalogue; rules in a
    cycle, and those that need them, never have one.
    """
    named = rules.select(F.col("rule_id").alias("condition"))
    waiting = rules.filter("type = 'correlation'").select("rule_id", "logic", "conditions")
    known = rules.filter("type <> 'correlation'").select("rule_id", F.array("sensor_id").alias("sensors"))
    number = 0
    while not waiting.isEmpty():
        conditions = waiting.select("rule_id", F.posexplode("conditions").alias("place", "condition"))
        behind = known.select(F.col("rule_id").alias("condition"), "sensors")
        placed = conditions.join(behind, "condition", "left").join(
            named.withColumn("is_named", F.lit(True)), "condition", "left"
        )
        ready = (
            placed.groupBy("rule_id")
            .agg(
                F.bool_and(F.col("sensors").isNotNull() | F.col("is_named").isNull()).alias("ready"),
                F.sort_array(
                    F.collect_list(F.struct("place", F.coalesce("sensors", F.array(F.lit(UNKNOWN_SENSOR))).alias("sensors")))
                ).alias("parts"),  # as long as the rule's conditions
            )
            .filter("ready")
            .select("rule_id", F.flatten("parts.sensors").alias("sensors"))
        )
        ready = stage(ready, f"level_{number}")
        if ready.isEmpty():
            return
        known = stage(known.unionByName(ready), f"known_{number}")
        yield waiting.join(ready, "rule_id", "left_semi"), known
        waiting = stage(waiting.join(ready, "rule_id", "left_anti"), f"waiting_{number}")
        number += 1


def _wanted(rules: DataFrame) -> DataFrame:
    return rules.select(
        "rule_id", "type", "sensor_id", "priority", "consecutive_measurements",
        F.col("operator").alias("op"), F.col("value").alias("threshold"),
    )
