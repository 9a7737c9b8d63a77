"""Single rules, correlations, state carry, and the catalogue."""

from collections import Counter
from random import Random

from conftest import frame

from telewarden.operators.scan import State
from telewarden.plans import relational
from telewarden.plans.evaluate import evaluate
from telewarden.plans.rules import Rule, RuleSet, normalise_rules, order_rules, rules_frame
from telewarden.session import Staging

HOT = Rule("hot", "simple", "LOW", "pump", ">=", 70.0)
FALL = Rule("fall", "step_difference", "HIGH", "tank", "<=", -6.0)
SHUT = Rule("shut", "stateful", "MEDIUM", "valve", "==", 0.0, 2)
BOTH = Rule("both", "correlation", "HIGH", logic="AND", conditions=("hot", "fall"))
ANY = Rule("any", "correlation", "LOW", logic="OR", conditions=("shut", "hot"))


def judge(spark, rules, rows, state=None, **options):
    return evaluate(frame(spark, rows), RuleSet.of(rules), state, **options)


def fired(result):
    return [(a.timestamp, a.rule_id, a.sensor_id, a.value) for a in result.alarms.collect()]


def carried(spark, step=(), streak=()):
    return State(
        spark.createDataFrame(list(step), "sensor_id string, last_value double"),
        spark.createDataFrame(list(streak), "rule_id string, sensor_id string, streak bigint"),
    )


def test_simple(spark):
    rows = [("a", "pump", 69.9), ("b", "pump", 70), ("c", "tank", 99), ("d", "pump", 200)]
    assert fired(judge(spark, [HOT], rows)) == [("b", "hot", "pump", "70.0"), ("d", "hot", "pump", "200.0")]


def test_step_uses_carried_value_and_carries_out(spark):
    result = judge(
        spark, [FALL], [("a", "tank", 31), ("b", "tank", 26), ("c", "tank", 20)],
        carried(spark, step=[("tank", 37.5), ("elsewhere", 4.0)]),
    )
    assert [a[:2] for a in fired(result)] == [("a", "fall"), ("c", "fall")]
    assert {tuple(r) for r in result.state_out.step.collect()} == {("tank", 20.0), ("elsewhere", 4.0)}


def test_step_cold_start_compares_zero(spark):
    rule = Rule("flat", "step_difference", "LOW", "tank", "<", 3.0)
    rows = [("a", "tank", 500), ("b", "tank", 503), ("c", "tank", 505.5)]
    assert [a[0] for a in fired(judge(spark, [rule], rows))] == ["a", "c"]


def test_two_step_rules_share_the_previous_value(spark):
    rise = Rule("rise", "step_difference", "LOW", "tank", ">", 1.0)
    rows = [("a", "tank", 8), ("b", "tank", 2), ("c", "tank", 9)]
    assert [a[:2] for a in fired(judge(spark, [FALL, rise], rows))] == [("b", "fall"), ("c", "rise")]


def test_streak_fires_on_every_long_enough_reading(spark):
    values = [0, 1, 0, 0, 0, 0, 5, 0]
    result = judge(spark, [SHUT], [(f"t{i}", "valve", v) for i, v in enumerate(values)])
    assert [a[0] for a in fired(result)] == ["t3", "t4", "t5"]
    assert [tuple(r) for r in result.state_out.streak.collect()] == [("shut", "valve", 1)]


def test_streak_is_zero_after_a_good_reading(spark):
    result = judge(spark, [SHUT], [("a", "valve", 0), ("b", "valve", 4)],
                   carried(spark, streak=[("shut", "valve", 1), ("other", "door", 12)]))
    assert [a[0] for a in fired(result)] == ["a"]
    assert {tuple(r) for r in result.state_out.streak.collect()} == {("shut", "valve", 0), ("other", "door", 12)}


def test_and(spark):
    rows = [("a", "pump", 80), ("a", "tank", 11), ("b", "tank", 2), ("b", "pump", 10), ("c", "pump", 75)]
    result = judge(spark, [HOT, FALL, BOTH], rows, carried(spark, step=[("tank", 18.0)]))
    assert fired(result) == [
        ("a", "both", "pump,tank", "80.0,11.0"), ("a", "fall", "tank", "11.0"), ("a", "hot", "pump", "80.0"),
        ("b", "fall", "tank", "2.0"), ("c", "hot", "pump", "75.0"),
    ]
    assert result.valid.count() == 0


def test_or_with_carried_streak(spark):
    rows = [("a", "valve", 0), ("a", "pump", 3)]
    result = judge(spark, [HOT, SHUT, ANY], rows, carried(spark, streak=[("shut", "valve", 1)]))
    assert fired(result) == [("a", "shut", "valve", "0.0"), ("a", "any", "valve,pump", "0.0,3.0")]


def test_missing_sensor(spark):
    result = judge(spark, [HOT, FALL, SHUT], [("a", "door", 1)])
    assert fired(result) == [] and result.valid.count() == 1


def test_unknown_operator_and_no_rules(spark):
    bad = [Rule(kind, kind, "HIGH", "pump", "~=", 1.0, 1) for kind in ("simple", "step_difference", "stateful")]
    rows = [("a", "pump", 1)]
    assert fired(judge(spark, bad, rows)) == []
    nothing = judge(spark, [], rows)
    assert fired(nothing) == [] and nothing.valid.count() == 1
    assert judge(spark, [HOT], []).alarms.count() == 0


def test_priority_order(spark):
    rules = [Rule(f"r{i}", "simple", level, "pump", ">", float(i)) for i, level in enumerate(["MEDIUM", "LOW", "HIGH", "MEDIUM"])]
    assert [a[1] for a in fired(judge(spark, rules, [("a", "pump", 9)]))] == ["r2", "r0", "r3", "r1"]


def test_three_way_and_or(spark):
    base = [Rule(f"low{i}", "simple", "LOW", f"cell{i}", "<", 2.0) for i in (1, 2, 3)]
    names = ("low3", "low1", "low2")
    both = [
        Rule("ALL", "correlation", "HIGH", logic="AND", conditions=names),
        Rule("ANY", "correlation", "HIGH", logic="OR", conditions=names),
    ]
    rows = [("a", "cell1", 0), ("a", "cell2", 1), ("a", "cell3", 1.5), ("b", "cell3", 9), ("b", "cell1", 1), ("c", "cell1", 5)]
    found = [a for a in fired(judge(spark, [*base, *both], rows)) if a[1] in ("ALL", "ANY")]
    assert found == [
        ("a", "ALL", "cell3,cell1,cell2", "1.5,0.0,1.0"), ("a", "ANY", "cell3,cell1,cell2", "1.5,0.0,1.0"),
        ("b", "ANY", "cell3,cell1,cell2", "9.0,1.0,NaN"),
    ]


def test_correlation_reports_first_reading_unknown_parent_and_nesting(spark):
    rules = [
        Rule("A", "simple", "LOW", "S1", ">", 10.0), Rule("B", "simple", "LOW", "S2", ">", 10.0),
        Rule("X", "correlation", "HIGH", logic="OR", conditions=("A", "NONE")),
        Rule("Y", "correlation", "HIGH", logic="AND", conditions=("X", "B", "A")),
    ]
    rows = [("T1", "S1", 1), ("T1", "S1", 11), ("T1", "S2", 12)]
    found = [a for a in fired(judge(spark, rules, rows)) if a[1] in "XY"]
    assert found == [
        ("T1", "X", "S1,UNKNOWN", "1.0,NaN"), ("T1", "Y", "S1,UNKNOWN,S2,S1", "1.0,NaN,12.0,1.0"),
    ]


def test_cycles_are_left_out():
    rules = RuleSet.of([
        HOT, Rule("P", "correlation", "LOW", logic="AND", conditions=("Q",)),
        Rule("Q", "correlation", "LOW", logic="AND", conditions=("P", "hot")),
    ])
    assert rules.cyclic == ("P", "Q") and rules.correlations == ()


def test_more_rules_than_one_word(spark):
    rules = [Rule(f"R{i:03d}", "simple", "LOW", f"S{i % 7}", ">", float(i)) for i in range(130)]
    rules.append(Rule("Z", "correlation", "HIGH", logic="AND", conditions=("R001", "R127")))
    rows = [("T1", "S1", 500), ("T2", "S1", 64.5), ("T2", "it's", 1)]
    found = fired(judge(spark, rules, rows))
    expected = [("T1", "Z", "S1,S1", "500.0,500.0")]
    expected += [("T1", f"R{i:03d}", "S1", "500.0") for i in range(130) if i % 7 == 1]
    expected += [("T2", f"R{i:03d}", "S1", "64.5") for i in range(65) if i % 7 == 1]
    assert found == expected


def test_quoted_names(spark):
    rule = Rule("it's \\ \"odd\"", "simple", "LOW", "S'1", ">", 1.0)
    corr = Rule("c'", "correlation", "HIGH", logic="OR", conditions=(rule.rule_id,))
    assert fired(judge(spark, [rule, corr], [("T", "S'1", 2)])) == [
        ("T", "c'", "S'1", "2.0"), ("T", rule.rule_id, "S'1", "2.0")
    ]


def test_catalogue_normalisation(spark):
    def rule(**kw):
        return {"type": "simple", "sensor_id": "S", "operator": ">", "value": 1.0, **kw}

    raw = rules_frame(spark, [
        rule(rule_id="low"), rule(rule_id="odd", priority="CRITICAL"), rule(rule_id="hi", priority="high"),
        rule(rule_id="kind", type="wavelet"), rule(rule_id="nosensor", sensor_id=None),
        rule(rule_id="n0", type="stateful", consecutive_measurements=0), rule(rule_id="hi", priority="LOW"),
        {"rule_id": "xor", "type": "correlation", "logic": "xor", "conditions": ["low"]},
        {"rule_id": "none", "type": "correlation", "logic": "and", "conditions": []},
        {"rule_id": "and", "type": "correlation", "logic": "and", "conditions": ["low", "hi"], "priority": "Medium"},
    ])
    valid, rejects = normalise_rules(raw)
    assert [(r.rule_id, r.priority) for r in order_rules(valid).collect()] == [
        ("hi", "HIGH"), ("and", "MEDIUM"), ("low", "LOW"),
    ]
    assert {(r.rule_id, r.reason) for r in rejects.collect()} == {
        ("odd", "invalid_priority"), ("kind", "unknown_type"), ("nosensor", "missing_field"),
        ("n0", "invalid_consecutive"), ("hi", "duplicate_id"), ("xor", "invalid_logic"), ("none", "no_conditions"),
    }


def test_many_differing_streaks_of_the_table_form(spark):
    """Hits and streaks as counted by hand, across slices and carried state, without a row per reading and rule on the way."""
    random = Random(5)
    rows = [(f"t{i}", random.choice(["pump", "tank"]), random.choice([0, 0, 1, 2, 3, 4, 5, 6])) for i in range(300)]
    catalogue = [
        {"rule_id": f"{sensor}{i}", "type": "stateful", "sensor_id": sensor, "operator": "~" if i == 9 else "!=" if i % 4 else ">",
         "value": float(i % 8), "consecutive_measurements": (1, 2, 3, 9)[i // 8]}
        for sensor in ("pump", "tank") for i in range(32)
    ]
    rules = normalise_rules(rules_frame(spark, catalogue))[0]
    old = {"pump5": 2, "pump29": 1, "tank12": 4, "tank30": 20}
    before = carried(spark, streak=[(rule, rule[:4], n) for rule, n in old.items()])
    expected, ends = Counter(), {}
    for rule in catalogue:
        streak, op = old.get(rule["rule_id"], 0), rule["operator"]
        for seq, (_, sensor, value) in enumerate(rows):
            if sensor == rule["sensor_id"]:
                holds = value != rule["value"] if op == "!=" else value > rule["value"] if op == ">" else False
                streak = streak + 1 if holds else 0
                if streak >= rule["consecutive_measurements"]:
                    expected[rule["rule_id"], seq] += 1
        ends[rule["rule_id"]] = streak
    staging, staged = Staging(spark), Counter()

    def stage(df, name):
        kept = staging(df, name)
        staged[name] = kept.count()
        return kept

    result = relational.evaluate(frame(spark, rows), rules, before, 8, stage)
    assert Counter((r.rule_id, r.seq) for r in result.hits.collect()) == expected
    assert {r.rule_id: r.streak for r in result.state_out.streak.collect()} == ends
    # A slice may have a row for each rule, a reading may not.
    assert len(expected) > 4000 and max(staged.values()) < 4000
    assert Counter((r.rule_id, r.timestamp) for r in result.alarms.collect()) == Counter((rule, f"t{seq}") for rule, seq in expected)
