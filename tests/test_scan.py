"""Sliced and carried evaluation against one pass, compiled rules against the rule table."""

import random
from itertools import product

import pytest
from conftest import frame

from telewarden.operators import scan
from telewarden.plans import relational
from telewarden.plans.evaluate import evaluate
from telewarden.plans.rules import Rule, RuleSet, rules_frame
from telewarden.session import Staging
from telewarden.sinks import pack_nominal

RULES = [
    Rule("A", "stateful", "HIGH", "S0", "<", 6.0, 3), Rule("B", "stateful", "LOW", "S0", ">=", 3.0, 2),
    Rule("C", "step_difference", "MEDIUM", "S0", ">", 2.0), Rule("D", "step_difference", "LOW", "S1", "<=", -3.0),
    Rule("E", "stateful", "LOW", "S1", "!=", 5.0, 4), Rule("F", "simple", "HIGH", "S2", "==", 7.0),
    Rule("G", "correlation", "HIGH", logic="AND", conditions=("A", "D")),
    Rule("H", "correlation", "LOW", logic="OR", conditions=("E", "F", "missing")),
]


def readings(seed, count=400):
    """S0 holds most readings; timestamps recur and are not in order."""
    rng = random.Random(seed)
    return [
        (f"T{(i // 5 + rng.choice([0, 0, 3])) % 60:02d}", rng.choice(["S0", "S0", "S0", "S1", "S2", "S3"]), rng.randrange(10))
        for i in range(count)
    ]


def brute(rows):
    """Alarms by a plain loop over the readings."""
    found, last, streak = [], {}, {}
    holds = {"<": lambda a, b: a < b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
             "<=": lambda a, b: a <= b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b}
    at, first = {}, {}
    for ts, sensor, raw in rows:
        value = float(raw)
        first.setdefault((ts, sensor), value)
        step = value - last.get(sensor, value)
        last[sensor] = value
        for r in RULES:
            if r.type == "correlation" or r.sensor_id != sensor:
                continue
            test = holds[r.operator]
            if r.type == "simple":
                hit = test(value, r.value)
            elif r.type == "step_difference":
                hit = test(step, r.value)
            else:
                streak[r.rule_id] = streak.get(r.rule_id, 0) + 1 if test(value, r.value) else 0
                hit = streak[r.rule_id] >= r.consecutive_measurements
            if hit:
                found.append((ts, r.rule_id, r.priority, sensor, str(value)))
                at.setdefault(ts, set()).add(r.rule_id)
    for ts, hits in at.items():
        if {"A", "D"} <= hits:
            values = [first.get((ts, s)) for s in ("S0", "S1")]
            found.append((ts, "G", "HIGH", "S0,S1", ",".join("NaN" if v is None else str(v) for v in values)))
        if hits & {"E", "F"}:
            values = [first.get((ts, s)) for s in ("S1", "S2")]
            text = ",".join("NaN" if v is None else str(v) for v in values) + ",NaN"
            found.append((ts, "H", "LOW", "S1,S2,UNKNOWN", text))
    nominal = sorted((ts, s, float(v)) for ts, s, v in rows if ts not in at)
    return sorted(found), nominal


def alarms(result):
    return [tuple(a) for a in result.alarms.collect()]


@pytest.mark.parametrize("slice_rows,staged", [(None, False), (50, False), (7, True), (1, False)])
def test_any_slicing_equals_brute_force(spark, slice_rows, staged):
    rows = readings(slice_rows or 0)
    expected, nominal = brute(rows)
    staging = Staging(spark) if staged else None
    result = evaluate(frame(spark, rows), RuleSet.of(RULES), slice_rows=slice_rows, stage=staging)
    found = alarms(result)
    assert sorted(found) == expected
    rank = {"HIGH": 0, "MEDIUM": 1, "LOW": 2}
    keys = [(a[0], rank[a[2]], a[1], a[3]) for a in found]
    assert keys == sorted(keys)
    assert sorted((r.timestamp, r.sensor_id, r.value) for r in result.valid.collect()) == nominal


def test_parts_with_carried_state_equal_one_pass(spark):
    rows = [(f"T{i // 4:03d}", s, v) for i, (_, s, v) in enumerate(readings(5, 240))]
    whole = frame(spark, rows)
    rules = RuleSet.of(RULES)
    state, found = None, []
    for start in range(0, 240, 80):
        part = whole.filter(f"seq >= {start} AND seq < {start + 80}")
        result = evaluate(part, rules, state, slice_rows=16)
        found += alarms(result)
        state = result.state_out
        state = type(state)(  # as it would be read back from a table
            spark.createDataFrame(state.step.collect(), state.step.schema),
            spark.createDataFrame(state.streak.collect(), state.streak.schema),
        )
    assert sorted(found) == brute(rows)[0]


def rule_table(spark, rules):
    names = ("rule_id", "type", "sensor_id", "operator", "value", "consecutive_measurements", "logic", "priority")
    return rules_frame(spark, [{n: getattr(r, n) for n in names} | {"conditions": list(r.conditions)} for r in rules])


def test_rule_table_equals_compiled_rules(spark):
    rows = readings(9)
    nested = [
        Rule("K", "correlation", "LOW", logic="OR", conditions=("H", "G", "none")),
        Rule("L", "correlation", "HIGH", logic="AND", conditions=("K", "F")),
        Rule("M", "correlation", "HIGH", logic="OR", conditions=("N", "F")),
        Rule("N", "correlation", "HIGH", logic="OR", conditions=("M",)),
        Rule("O", "correlation", "HIGH", logic="OR", conditions=("M", "A")),
    ]
    rules = RuleSet.of([*RULES, *nested])
    assert rules.cyclic == ("M", "N", "O")
    df, table = frame(spark, rows), rule_table(spark, [*RULES, *nested])
    assert sorted(a[:5] for a in alarms(relational.evaluate(df, rule_table(spark, RULES), slice_rows=32))) == brute(rows)[0]
    whole, as_table = evaluate(df, rules, slice_rows=32), relational.evaluate(df, table, slice_rows=32)
    assert alarms(as_table) == alarms(whole)
    for name in ("step", "streak"):
        assert set(getattr(as_table.state_out, name).collect()) == set(getattr(whole.state_out, name).collect())
    nominal = [sorted(tuple(r) for r in e.valid.select("timestamp", "sensor_id", "value").collect()) for e in (whole, as_table)]
    assert nominal[0] == nominal[1]


def test_nested_streaks_equal_compiled_rules(spark):
    """All operators, several counts, equal thresholds, two parts with carried state."""
    rules = [
        Rule(f"Q{i}", "stateful", "LOW", f"S{i % 3}", op, threshold, n)
        for i, (op, threshold, n) in enumerate(product((">", ">=", "<", "<=", "==", "!=", "~"), (2.0, 5.0), (1, 2, 5)))
    ]
    numbers = random.Random(4)
    rows = [(f"T{i // 5:03d}", f"S{numbers.randint(0, 3)}", float(numbers.choice([1, 2, 2, 2, 5, 5, 6, 9]))) for i in range(400)]
    whole, compiled, table = frame(spark, rows), RuleSet.of(rules), rule_table(spark, rules)
    expected = evaluate(whole, compiled, slice_rows=32)
    for cut, slice_rows in ((0, 16), (3, 7), (190, 1000)):
        first = relational.evaluate(whole.filter(f"seq < {cut}"), table, slice_rows=slice_rows) if cut else None
        state = first.state_out if first else None
        second = relational.evaluate(whole.filter(f"seq >= {cut}"), table, state, slice_rows)
        found = (alarms(first) if first else []) + alarms(second)
        assert sorted(found) == sorted(alarms(expected))
        assert set(second.state_out.streak.collect()) == set(expected.state_out.streak.collect())


def test_rule_table_carries_state(spark):
    rows = [(f"T{i // 4:03d}", s, v) for i, (_, s, v) in enumerate(readings(6, 240))]
    whole, table = frame(spark, rows), rule_table(spark, RULES)
    first = relational.evaluate(whole.filter("seq < 120"), table, slice_rows=16)
    second = relational.evaluate(whole.filter("seq >= 120"), table, first.state_out, 16)
    assert sorted(alarms(first) + alarms(second)) == brute(rows)[0]


def test_many_blocks_of_slices_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(scan, "BLOCK_SLICES", 3)
    rows = readings(11)
    found = alarms(evaluate(frame(spark, rows), RuleSet.of(RULES), slice_rows=4))
    assert sorted(found) == brute(rows)[0]


def test_hot_timestamp_is_one_line(spark):
    rows = [("T1", f"S{i % 3}", i) for i in range(40)] + [("T2", "S0", 1), ("T2", "S1", 2)]
    result = evaluate(frame(spark, rows), RuleSet.of([]), slice_rows=8)
    packed = {p.timestamp: p.sensor_string for p in pack_nominal(result.valid).collect()}
    hot = [f"S{k}:{float(i)}" for k in range(3) for i in range(40) if i % 3 == k]
    assert packed == {"T1": "|".join(hot), "T2": "S0:1.0|S1:2.0"}
