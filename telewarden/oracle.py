"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

TEL = """tel AS (SELECT event_id AS seq,
    strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
    event_type AS sensor_id, value,
    CASE user_id % 3 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' ELSE 'HIGH' END AS priority
    FROM events)"""

ORD = """ord AS (SELECT o_orderkey AS seq,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
    o_orderpriority AS sensor_id, o_totalprice AS value FROM orders)"""

DIRTY = """dirty AS (SELECT seq,
    CASE seq % 40 WHEN 1 THEN 'sometime' WHEN 2 THEN '12' WHEN 3 THEN '10:00'
        WHEN 4 THEN substr(timestamp, 1, 16) || 'Z' WHEN 5 THEN NULL
        WHEN 6 THEN substr(timestamp, 1, 7) ELSE timestamp END AS timestamp,
    CASE WHEN seq % 40 IN (10, 11) THEN NULL ELSE sensor_id END AS sensor_id,
    CASE seq % 40 WHEN 15 THEN 'out of order' WHEN 16 THEN NULL WHEN 17 THEN '5d'
        WHEN 18 THEN ' 1.5' WHEN 19 THEN 'inf' WHEN 20 THEN '1e2' WHEN 21 THEN '0x1p3'
        ELSE CAST(value AS VARCHAR) END AS value,
    CASE WHEN seq % 40 = 25 THEN 'CRITICAL' WHEN seq % 40 IN (26, 27) THEN NULL
        WHEN seq % 40 = 28 THEN ' LOW' ELSE lower(priority) END AS priority
    FROM tel)"""

CLEAN = """clean AS (SELECT seq, timestamp, sensor_id, CAST(value AS DOUBLE) AS value,
    upper(coalesce(priority, 'LOW')) AS priority,
    epoch_us(CAST(replace(CASE WHEN seq % 40 = 4 THEN replace(timestamp, 'Z', ':00Z')
        ELSE timestamp END, 'Z', '') AS TIMESTAMP)) AS event_micros
    FROM dirty
    WHERE timestamp IS NOT NULL AND sensor_id IS NOT NULL AND value IS NOT NULL
        AND upper(coalesce(priority, 'LOW')) IN ('LOW', 'MEDIUM', 'HIGH')
        AND seq % 40 NOT IN (1, 2, 3, 6, 15, 17, 18, 19, 21))"""

REJECTS = """rejects AS (SELECT timestamp, sensor_id, value, priority, seq,
    CASE WHEN timestamp IS NULL OR sensor_id IS NULL OR value IS NULL THEN 'schema_missing_field'
        WHEN upper(coalesce(priority, 'LOW')) NOT IN ('LOW', 'MEDIUM', 'HIGH') THEN 'schema_priority'
        WHEN seq % 40 IN (15, 17, 18, 19, 21) THEN 'type_value'
        WHEN seq % 40 IN (1, 2, 3, 6) THEN 'type_timestamp' END AS reject_reason
    FROM dirty)"""


def scanned(source: str, streaks: dict[str, str]) -> str:
    """Step and streak columns of a source, streaks by cumulated good readings (islands)."""
    columns = ", ".join(
        f"CASE WHEN {cond} THEN row_number() OVER (PARTITION BY sensor_id, good_{name} ORDER BY seq)"
        f" - CASE WHEN good_{name} = 0 THEN 0 ELSE 1 END ELSE 0 END AS streak_{name}"
        for name, cond in streaks.items()
    )
    goods = ", ".join(
        f"sum(CASE WHEN {cond} THEN 0 ELSE 1 END) OVER (PARTITION BY sensor_id ORDER BY seq) AS good_{name}"
        for name, cond in streaks.items()
    )
    return f"""marked AS (SELECT *, coalesce(value - lag(value) OVER (PARTITION BY sensor_id ORDER BY seq), 0.0)
        AS diff{', ' + goods if goods else ''} FROM {source}),
    scanned AS (SELECT *{', ' + columns if columns else ''} FROM marked)"""


BASE_STREAKS = {"r2": "sensor_id = 'view' AND value < 20"}

R1 = ("R1", "LOW", "sensor_id = 'purchase' AND value > 150")
R2 = ("R2", "MEDIUM", "sensor_id = 'view' AND streak_r2 >= 4")
R3 = ("R3", "HIGH", "sensor_id = 'click' AND diff > 120")
R4 = ("R4", "LOW", "sensor_id = 'error' AND value > 100")
BASE = [R1, R2, R3, R4]

# Correlations: priority, condition over fired sets, parents in order.
R5 = ("R5", "HIGH", "f1 AND f4", ["purchase", "error"])
R6 = ("R6", "MEDIUM", "f2 OR f3", ["view", "click"])
R7 = ("R7", "HIGH", "f1 OR f3 OR f4", ["purchase", "click", "error"])
R8 = ("R8", "LOW", "f1", ["purchase", "UNKNOWN"])
R9 = ("R9", "HIGH", "f1 AND f4", ["purchase", "UNKNOWN", "error"])


def hits(rules, source: str = "scanned") -> str:
    parts = " UNION ALL ".join(
        f"SELECT timestamp, '{rule}' AS rule_id, '{priority}' AS priority, sensor_id, value, seq"
        f" FROM {source} WHERE {cond}"
        for rule, priority, cond in rules
    )
    return f"hits AS ({parts})"


def base_alarms(source: str = "hits") -> str:
    return (
        f"SELECT timestamp, rule_id, priority, sensor_id, CAST(value AS VARCHAR) AS value FROM {source}"
    )


def fired(base: dict[str, str], source: str = "scanned") -> str:
    columns = ", ".join(
        f"coalesce(bool_or(rule_id = '{rule}'), false) AS {name}" for name, rule in base.items()
    )
    return f"""fired AS (SELECT timestamp, {columns} FROM hits GROUP BY timestamp),
    firsts AS (SELECT timestamp, sensor_id, CAST(arg_min(value, seq) AS VARCHAR) AS first
        FROM {source} GROUP BY timestamp, sensor_id)"""


FLAGS = {"f1": "R1", "f2": "R2", "f3": "R3", "f4": "R4"}


def correlation(rule) -> str:
    name, priority, cond, parents = rule
    joins = " ".join(
        f"LEFT JOIN firsts p{i} ON p{i}.timestamp = fired.timestamp AND p{i}.sensor_id = '{s}'"
        for i, s in enumerate(parents)
    )
    values = " || ',' || ".join(f"coalesce(p{i}.first, 'NaN')" for i in range(len(parents)))
    return f"""SELECT fired.timestamp, '{name}' AS rule_id, '{priority}' AS priority,
        '{','.join(parents)}' AS sensor_id, {values} AS value FROM fired {joins} WHERE {cond}"""


def judged(rules=BASE, tel: str = TEL, source: str = "tel", streaks=BASE_STREAKS) -> str:
    return f"{tel}, {scanned(source, streaks)}, {hits(rules)}"


def all_alarms(tel: str = TEL, source: str = "tel", numbered: bool = False) -> str:
    """Alarms of all rules; numbered ones also tell the arrival of their reading."""
    found = [base_alarms(), *(correlation(r) for r in (R5, R6, R7, R8, R9))]
    if numbered:
        arrival = ["seq", *["NULL"] * 5]
        found = [sql.replace("AS value", f"AS value, {seq} AS seq", 1) for sql, seq in zip(found, arrival)]
    return f"WITH {judged(BASE, tel, source)}, {fired(FLAGS)} " + " UNION ALL ".join(found)


def one_correlation(rule) -> str:
    return f"WITH {judged()}, {fired(FLAGS)} {correlation(rule)}"


NOMINAL = f"{judged()}, nominal AS (SELECT * FROM tel WHERE timestamp NOT IN (SELECT timestamp FROM hits))"

PACKED = f"""WITH {NOMINAL} SELECT timestamp, 'NOMINAL' AS status,
    string_agg(sensor_id || ':' || CAST(value AS VARCHAR), '|' ORDER BY sensor_id, seq) AS sensor_string
    FROM nominal GROUP BY timestamp"""

ALL_NOMINAL = PACKED

STREAK_35 = {"s": "value < 35"}

CARRY_STREAKS = {
    "r2": "sensor_id = 'view' AND value < 20",
    "r2b": "sensor_id = 'view' AND value >= 10",
    "r2d": "sensor_id = 'signup' AND value < 150",
}
CARRY = [
    R2,
    ("R2b", "HIGH", "sensor_id = 'view' AND streak_r2b >= 2"),
    R3,
    ("R3b", "LOW", "sensor_id = 'error' AND diff < -90"),
    ("R2d", "LOW", "sensor_id = 'signup' AND streak_r2d >= 3"),
]

ORDER_STREAKS = {
    "p2": "sensor_id = '2-HIGH' AND value >= 250000",
    "p4": "sensor_id = '2-HIGH' AND value < 100000",
}
ORDER_RULES = [
    ("P1", "HIGH", "sensor_id = '1-URGENT' AND value > 480000"),
    ("P2", "LOW", "sensor_id = '2-HIGH' AND streak_p2 >= 5"),
    ("P3", "MEDIUM", "sensor_id = '5-LOW' AND diff <= -350000"),
    ("P4", "MEDIUM", "sensor_id = '2-HIGH' AND streak_p4 >= 3"),
]
P5 = ("P5", "HIGH", "f1 OR f2", ["1-URGENT", "2-HIGH"])


def order_alarms(source: str) -> str:
    return (
        f"{scanned(source, ORDER_STREAKS)}, {hits(ORDER_RULES)}, "
        f"{fired({'f1': 'P1', 'f2': 'P2'})} {base_alarms()} UNION ALL {correlation(P5)}"
    )


def pick(step: int, *options) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if o is None else repr(o)}" for i, o in enumerate(options)
    )
    return f"CASE (s_suppkey // {step}) % {len(options)} {arms} END"


SUPPLIER_RULES = f"""raw AS (SELECT
    'R' || (s_suppkey - CASE WHEN s_suppkey % 29 = 28 THEN 1 ELSE 0 END) AS rule_id,
    {pick(1, 'simple', 'simple', 'simple', 'stateful', 'correlation', 'wavelet', 'step_difference')} AS type,
    CASE WHEN s_suppkey % 31 <> 30 THEN 'S' || s_suppkey END AS sensor_id,
    {pick(2, '>', '<', '>=', '<=', '==', '!=', '~')} AS operator,
    CAST(40 + s_suppkey % 10 AS DOUBLE) AS value,
    {pick(3, 3, 0, 5)} AS n,
    upper({pick(5, 'and', 'OR', 'xor')}) AS logic,
    s_suppkey % 17 <> 16 AS has_conditions,
    upper(coalesce({pick(1, 'low', 'MEDIUM', 'High', None, 'CRITICAL')}, 'LOW')) AS priority,
    s_suppkey AS pos FROM supplier),
  judged AS (SELECT *, CASE WHEN priority = 'CRITICAL' THEN 'invalid_priority'
    WHEN type = 'wavelet' THEN 'unknown_type'
    WHEN type = 'correlation' AND logic = 'XOR' THEN 'invalid_logic'
    WHEN type = 'correlation' AND NOT has_conditions THEN 'no_conditions'
    WHEN type <> 'correlation' AND sensor_id IS NULL THEN 'missing_field'
    WHEN type = 'stateful' AND n < 1 THEN 'invalid_consecutive' END AS reason FROM raw),
  usable AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY pos) AS copy
    FROM judged WHERE reason IS NULL),
  valid AS (SELECT * FROM usable WHERE copy = 1)"""

OP_HOLDS = """CASE operator WHEN '>' THEN {m} > r.value WHEN '<' THEN {m} < r.value
    WHEN '>=' THEN {m} >= r.value WHEN '<=' THEN {m} <= r.value
    WHEN '==' THEN {m} = r.value WHEN '!=' THEN {m} <> r.value ELSE false END"""

DATA_RULES = f"""WITH {TEL},
  tops AS (SELECT event_type, floor(max(value)) AS top FROM events GROUP BY event_type),
  bad AS (SELECT tel.*, top, value < top * 0.125 AS low,
    coalesce(value - lag(value) OVER (PARTITION BY sensor_id ORDER BY seq), 0.0) AS diff
    FROM tel JOIN tops ON sensor_id = event_type),
  runs AS (SELECT *, sum(CASE WHEN low THEN 0 ELSE 1 END) OVER (PARTITION BY sensor_id ORDER BY seq) AS good FROM bad),
  streaks AS (SELECT *, CASE WHEN low THEN row_number() OVER (PARTITION BY sensor_id, good ORDER BY seq)
    - CASE WHEN good = 0 THEN 0 ELSE 1 END ELSE 0 END AS streak FROM runs),
  hits AS (SELECT timestamp, 'A_' || sensor_id AS rule_id, 'HIGH' AS priority, sensor_id, value, seq
      FROM streaks WHERE value > top * 0.5
    UNION ALL SELECT timestamp, 'B_' || sensor_id, 'LOW', sensor_id, value, seq FROM streaks WHERE diff < top * -0.25
    UNION ALL SELECT timestamp, 'C_' || sensor_id, 'MEDIUM', sensor_id, value, seq FROM streaks WHERE streak >= 4),
  firsts AS (SELECT timestamp, sensor_id, CAST(arg_min(value, seq) AS VARCHAR) AS first FROM tel GROUP BY ALL),
  both_fired AS (SELECT timestamp, sensor_id FROM hits WHERE rule_id[1:2] IN ('A_', 'B_')
    GROUP BY timestamp, sensor_id HAVING count(DISTINCT rule_id) = 2),
  nested AS (SELECT timestamp, sensor_id FROM both_fired
    UNION SELECT timestamp, sensor_id FROM hits WHERE rule_id[1:2] = 'C_')"""

TABLE_ALARMS = f"""{DATA_RULES} {base_alarms()} UNION ALL
  SELECT b.timestamp, 'D_' || b.sensor_id, 'HIGH', b.sensor_id || ',' || b.sensor_id, first || ',' || first
    FROM both_fired b JOIN firsts f ON f.timestamp = b.timestamp AND f.sensor_id = b.sensor_id
  UNION ALL SELECT n.timestamp, 'E_' || n.sensor_id, 'MEDIUM',
    concat_ws(',', n.sensor_id, n.sensor_id, n.sensor_id, 'UNKNOWN'), concat_ws(',', first, first, first, 'NaN')
    FROM nested n JOIN firsts f ON f.timestamp = n.timestamp AND f.sensor_id = n.sensor_id"""

CATALOGUE = "(VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('refund')) c(sensor_id)"

COPIES = f"""{TEL}, span AS (SELECT max(event_id) + 1 AS s FROM events),
  copies AS (SELECT c.copy * s + seq AS seq, timestamp, sensor_id, value, priority, c.copy
    FROM tel, span, (VALUES (0), (1), (2)) c(copy))"""

AS_TEXT = "WITH {q} SELECT concat_ws(';', timestamp, rule_id, priority, sensor_id, value) AS line FROM a"

FILE_ROWS = f"""WITH {TEL} SELECT CAST(row_number() OVER (ORDER BY seq) - 1 AS BIGINT) AS row,
    timestamp, sensor_id, value, priority FROM tel"""

# Payloads that can be read, and why the others can not.
READABLE = f"{TEL}, readable AS (SELECT * FROM tel WHERE seq % 50 NOT BETWEEN 7 AND 11)"
PAYLOAD_REASON = """CASE seq % 50 WHEN 7 THEN 'malformed' WHEN 8 THEN 'malformed' WHEN 11 THEN 'type_value'
    ELSE 'schema_missing_field' END"""

ORACLE = {
    "simple_rule": f"WITH {TEL}, {hits([R1, R4], 'tel')} {base_alarms()}",
    "all_operators": f"""WITH {TEL}, ops AS (
        SELECT 'O0' AS rule_id, * FROM tel WHERE value > 36.29 UNION ALL
        SELECT 'O1', * FROM tel WHERE value < 36.29 UNION ALL
        SELECT 'O2', * FROM tel WHERE value >= 36.29 UNION ALL
        SELECT 'O3', * FROM tel WHERE value <= 36.29 UNION ALL
        SELECT 'O4', * FROM tel WHERE value = 36.29 UNION ALL
        SELECT 'O5', * FROM tel WHERE value <> 36.29)
        SELECT rule_id, sensor_id, count(*) AS alarms FROM ops WHERE sensor_id = 'click'
        GROUP BY rule_id, sensor_id""",
    "unknown_operator": f"""WITH {TEL} SELECT sensor_id, count(*) AS valid,
        CAST(0 AS BIGINT) AS alarms FROM tel GROUP BY sensor_id""",
    "step_difference": f"WITH {TEL}, {scanned('tel', {})} SELECT seq, sensor_id, diff FROM scanned",
    "segmented_step": f"WITH {TEL}, {scanned('tel', {})} SELECT seq, sensor_id, diff FROM scanned",
    "step_cold_start": f"""WITH {TEL}, {scanned('tel', {})}
        SELECT timestamp, 'S_' || sensor_id AS rule_id, 'LOW' AS priority, sensor_id,
        CAST(value AS VARCHAR) AS value FROM scanned WHERE diff < 41.5""",
    "stateful_streak": f"""WITH {TEL}, {scanned('tel', STREAK_35)}
        SELECT seq, sensor_id, CAST(streak_s AS BIGINT) AS streak FROM scanned""",
    "segmented_streak": f"""WITH {TEL}, {scanned('tel', STREAK_35)}
        SELECT seq, sensor_id, CAST(streak_s AS BIGINT) AS streak FROM scanned""",
    "stateful_rule": "WITH "
    + judged(
        [
            R2,
            ("R2b", "HIGH", "sensor_id = 'view' AND streak_b >= 2"),
            ("R2c", "LOW", "sensor_id = 'signup' AND streak_c >= 7"),
        ],
        streaks={
            **BASE_STREAKS,
            "b": "sensor_id = 'view' AND value >= 60",
            "c": "sensor_id = 'signup' AND value <> 1",
        },
    )
    + " "
    + base_alarms(),
    "streak_carry_out": f"""WITH {TEL}, {scanned('tel', CARRY_STREAKS)},
        last AS (SELECT sensor_id, arg_max(streak_r2, seq) AS a, arg_max(streak_r2b, seq) AS b,
            arg_max(streak_r2d, seq) AS d FROM scanned GROUP BY sensor_id)
        SELECT 'R2' AS rule_id, sensor_id, CAST(a AS BIGINT) AS streak FROM last WHERE sensor_id = 'view'
        UNION ALL SELECT 'R2b', sensor_id, CAST(b AS BIGINT) FROM last WHERE sensor_id = 'view'
        UNION ALL SELECT 'R2d', sensor_id, CAST(d AS BIGINT) FROM last WHERE sensor_id = 'signup'""",
    "last_value_carry_out": f"""WITH {TEL} SELECT sensor_id, arg_max(value, seq) AS last_value
        FROM tel WHERE sensor_id IN ('click', 'error') GROUP BY sensor_id""",
    "two_part_carry_in": f"""WITH {judged(CARRY, streaks=CARRY_STREAKS)}
        {base_alarms()} WHERE seq >= (SELECT max(event_id) // 2 FROM events)""",
    "corr_and": one_correlation(R5),
    "corr_or": one_correlation(R6),
    "corr_three_way": one_correlation(R7),
    "corr_unknown_parent": one_correlation(R8),
    "corr_nested": one_correlation(R9),
    "anomalous": f"WITH {judged()} SELECT DISTINCT timestamp FROM hits",
    "nominal_rows": f"WITH {NOMINAL} SELECT timestamp, sensor_id, value, priority, seq FROM nominal",
    "nominal_packed": PACKED,
    "alarms_sorted": all_alarms(),
    "orders_alarms": f"WITH {ORD}, {order_alarms('ord')}",
    "orders_nominal": f"""WITH {ORD}, {scanned('ord', ORDER_STREAKS)}, {hits(ORDER_RULES)}
        SELECT timestamp, 'NOMINAL' AS status,
        string_agg(sensor_id || ':' || CAST(value AS VARCHAR), '|' ORDER BY sensor_id, seq) AS sensor_string
        FROM ord WHERE timestamp NOT IN (SELECT timestamp FROM hits) GROUP BY timestamp""",
    "orders_by_event_time": f"""WITH {ORD}, timed AS (SELECT timestamp, sensor_id, value,
        row_number() OVER (ORDER BY timestamp, seq) AS seq FROM ord), {order_alarms('timed')}""",
    "split_counts": f"""WITH {judged()} SELECT sensor_id,
        CASE WHEN timestamp IN (SELECT timestamp FROM hits) THEN 'anomalous' ELSE 'nominal' END AS side,
        count(*) AS readings FROM tel GROUP BY ALL""",
    "sanitize_clean": f"""WITH {TEL}, {DIRTY}, {CLEAN}
        SELECT timestamp, sensor_id, value, priority, seq, event_micros FROM clean""",
    "sanitize_rejects": f"""WITH {TEL}, {DIRTY}, {REJECTS}
        SELECT * FROM rejects WHERE reject_reason IS NOT NULL""",
    "rejects_by_reason": f"""WITH {TEL}, {DIRTY}, {REJECTS} SELECT reject_reason, count(*) AS rows
        FROM rejects WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "missing_priority": f"""WITH {TEL}, {DIRTY} SELECT 'LOW' AS priority, count(*) AS readings FROM dirty
        WHERE timestamp IS NOT NULL AND sensor_id IS NOT NULL AND value IS NOT NULL
        AND seq % 40 NOT IN (1, 2, 3, 6, 15, 17, 18, 19, 21)""",
    "missing_mandatory": f"""WITH {TEL}, {DIRTY} SELECT sensor_id, count(*) AS readings,
        CAST(0 AS BIGINT) AS kept FROM dirty GROUP BY sensor_id, seq % 40 = 11""",
    "dirty_alarms": all_alarms(f"{TEL}, {DIRTY}, {CLEAN}", "clean"),
    "rule_rejects": f"""WITH {SUPPLIER_RULES}
        SELECT rule_id, reason, pos FROM judged WHERE reason IS NOT NULL
        UNION ALL SELECT rule_id, 'duplicate_id', pos FROM usable WHERE copy > 1""",
    "rule_order": f"""WITH {SUPPLIER_RULES}
        SELECT rule_id, type, priority, logic, operator, pos FROM valid""",
    "rules_table_join": f"""WITH {SUPPLIER_RULES}
        SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, r.rule_id, r.priority,
        r.sensor_id, CAST(l_quantity AS VARCHAR) AS value, l_orderkey AS seq
        FROM lineitem JOIN valid r ON r.sensor_id = 'S' || l_suppkey AND r.type = 'simple'
        WHERE {OP_HOLDS.format(m='l_quantity')}""",
    "rules_table_alarms": TABLE_ALARMS,
    "many_rules_hits": f"""WITH {TEL}, {scanned('tel', {})},
        tops AS (SELECT event_type, max(value) AS top FROM events GROUP BY event_type),
        r AS (SELECT 'M_' || event_type || '_' || k AS rule_id, event_type, k % 2 AS step,
            CASE k % 7 WHEN 0 THEN '>' WHEN 1 THEN '>=' WHEN 2 THEN '<' WHEN 3 THEN '<=' WHEN 4 THEN '==' WHEN 5 THEN '!=' ELSE '~' END AS operator,
            CASE WHEN k % 7 = 5 THEN CASE WHEN k < 40 THEN floor(top) END
                ELSE round(top * CASE WHEN k % 7 < 2 THEN k * 0.0002 + 0.8 WHEN k % 7 < 4 THEN k * -0.0002 ELSE k * 0.001 END, 2) END AS value
            FROM tops, range(1000) t(k)),
        m AS (SELECT rule_id, r.value, operator, s.seq, CASE step WHEN 1 THEN s.diff ELSE s.value END AS measure
            FROM r JOIN scanned s ON s.sensor_id = event_type WHERE r.value IS NOT NULL)
        SELECT rule_id, count(*) AS hits, min(seq) AS first_seq, max(seq) AS last_seq FROM m r
        WHERE {OP_HOLDS.format(m='measure')} GROUP BY rule_id""",
    "many_streaks": f"""WITH {TEL}, tops AS (SELECT event_type, max(value) AS top FROM events GROUP BY event_type),
        r AS (SELECT 'N_' || event_type || '_' || k AS rule_id, event_type, k % 4 + 1 AS n, round(top * (k * 0.004 + 0.001), 2) AS value,
            CASE k % 6 WHEN 0 THEN '>' WHEN 1 THEN '>=' WHEN 2 THEN '<' WHEN 3 THEN '<=' WHEN 4 THEN '==' ELSE '!=' END AS operator
            FROM tops, range(200) t(k)),
        m AS (SELECT rule_id, event_type, n, seq, {OP_HOLDS.format(m='tel.value')} AS holds FROM r JOIN tel ON sensor_id = event_type),
        g AS (SELECT *, sum(CASE WHEN holds THEN 0 ELSE 1 END) OVER (PARTITION BY rule_id ORDER BY seq) AS good FROM m),
        s AS (SELECT *, sum(CASE WHEN holds THEN 1 ELSE 0 END) OVER (PARTITION BY rule_id, good ORDER BY seq) AS streak FROM g)
        SELECT rule_id, event_type AS sensor_id, CAST(arg_max(streak, seq) AS BIGINT) AS streak, count(*) FILTER (streak >= n) AS hits
        FROM s GROUP BY rule_id, event_type""",
    "rules_table_nominal": f"""{DATA_RULES} SELECT timestamp, 'NOMINAL' AS status,
        string_agg(sensor_id || ':' || CAST(value AS VARCHAR), '|' ORDER BY sensor_id, seq) AS sensor_string
        FROM tel WHERE timestamp NOT IN (SELECT timestamp FROM hits) GROUP BY timestamp""",
    "rules_table_state": f"""{DATA_RULES} SELECT 'C_' || sensor_id AS rule_id, sensor_id,
        CAST(arg_max(streak, seq) AS BIGINT) AS streak FROM streaks GROUP BY sensor_id""",
    "alarm_positions": f"""SELECT CAST(row_number() OVER (ORDER BY timestamp,
            CASE priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, rule_id, sensor_id, seq) - 1
            AS BIGINT) AS row, concat_ws(';', timestamp, rule_id, priority, sensor_id, value) AS line
        FROM ({all_alarms(numbered=True)})""",
    "nominal_positions": f"""SELECT CAST(row_number() OVER (ORDER BY timestamp) - 1 AS BIGINT) AS row,
        concat_ws(';', timestamp, status, sensor_string) AS line FROM ({PACKED})""",
    "rule_positions": f"""WITH {SUPPLIER_RULES} SELECT CAST(row_number() OVER (ORDER BY
            CASE priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, pos) - 1 AS BIGINT) AS row,
        rule_id, priority FROM valid""",
    "damaged_csv": f"""WITH {TEL} SELECT CASE seq % 10 WHEN 2 THEN 'malformed' ELSE 'clean' END AS outcome,
        CASE seq % 10 WHEN 1 THEN 'LOW' WHEN 2 THEN NULL WHEN 3 THEN 'HIGH' ELSE priority END AS priority,
        count(*) AS rows FROM tel GROUP BY ALL""",
    "rules_json": f"""WITH {SUPPLIER_RULES}
        SELECT rule_id, type, priority, logic, operator, value FROM valid""",
    "sensors_yaml": """SELECT 'S' || s_suppkey AS id, CAST(NULL AS VARCHAR) AS sampling_rate,
        'r' || s_nationkey AS unit, 'N-' || s_suppkey // 500 AS spacecraft_id FROM supplier""",
    "absent_sensor": f"""WITH {TEL} SELECT sensor_id, arg_max(value, seq) AS last_value
        FROM tel WHERE sensor_id = 'click' GROUP BY sensor_id UNION ALL SELECT 'refund', 7.5""",
    "no_rules": f"""WITH {TEL} SELECT timestamp, 'NOMINAL' AS status,
        string_agg(sensor_id || ':' || CAST(value AS VARCHAR), '|' ORDER BY sensor_id, seq) AS sensor_string
        FROM tel GROUP BY timestamp""",
    "published_lines": f"""SELECT line, 2 * count(*) AS copies FROM (
        SELECT concat_ws(';', timestamp, rule_id, priority, sensor_id, value) AS line FROM ({all_alarms()})
        UNION ALL SELECT concat_ws(';', timestamp, status, sensor_string) FROM ({PACKED})) GROUP BY line""",
    "refused_outputs": f"""SELECT rule_id, count(*) AS alarms, CAST(0 AS BIGINT) AS lines,
        false AS left_behind FROM ({all_alarms()}) GROUP BY rule_id""",
    "counted_rejects": f"""WITH {TEL}, {DIRTY}, {REJECTS} SELECT reject_reason, count(*) AS rows,
        count(*) AS counted FROM rejects WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "late_readings": f"""WITH {TEL} SELECT timestamp, sensor_id, CAST(value AS VARCHAR) AS value, priority,
        'late' AS reject_reason FROM tel WHERE seq % 97 = 0""",
    "bounded_stream": f"WITH {TEL}, {hits([R1, R4], 'tel')} {base_alarms()}",
    "completeness_report": f"""WITH {TEL} SELECT t.timestamp, c.sensor_id
        FROM (SELECT DISTINCT timestamp FROM tel) t CROSS JOIN {CATALOGUE}
        WHERE NOT EXISTS (SELECT 1 FROM tel WHERE tel.timestamp = t.timestamp
            AND tel.sensor_id = c.sensor_id)""",
    "supplier_completeness": """WITH l AS (SELECT DISTINCT strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS timestamp,
            l_suppkey FROM lineitem)
        SELECT t.timestamp, s_suppkey AS sensor_id FROM (SELECT DISTINCT timestamp FROM l) t CROSS JOIN supplier
        WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.timestamp = t.timestamp AND l_suppkey = s_suppkey)""",
    "islands_streak": f"""WITH {TEL}, {scanned('tel', STREAK_35)}
        SELECT seq, sensor_id, CAST(streak_s AS BIGINT) AS streak FROM scanned""",
    "damaged_lines": f"""WITH {TEL} SELECT 'malformed' AS reject_reason, 'noise ' || seq AS line, NULL AS seq FROM tel WHERE seq % 10 = 2
        UNION ALL SELECT {PAYLOAD_REASON}, CASE seq % 50 WHEN 7 THEN 'noise ' || seq
            WHEN 8 THEN substr('{{"timestamp":"' || timestamp || '","sensor_id"', 1, 30) END, seq FROM tel WHERE seq % 50 BETWEEN 7 AND 11""",
    "appended_positions": f"""WITH {TEL}, {hits([R1, R4], 'tel')}, lines AS (SELECT seq % 3 AS run,
            concat_ws(';', timestamp, rule_id, priority, sensor_id, CAST(value AS VARCHAR)) AS line, timestamp, rule_id, sensor_id, seq FROM hits)
        SELECT CAST(row_number() OVER (ORDER BY run, timestamp, rule_id, sensor_id, seq) - 1 AS BIGINT) AS row, line FROM lines""",
    "refused_arguments": f"""SELECT rule_id, count(*) AS alarms, CAST(4 AS BIGINT) AS refused,
        false AS left_behind FROM ({all_alarms()}) GROUP BY rule_id""",
    "keyed_stream_alarms": all_alarms(READABLE, "readable"),
    "keyed_stream_nominal": f"""WITH {judged(BASE, READABLE, 'readable')} SELECT timestamp, 'NOMINAL' AS status,
        string_agg(sensor_id || ':' || CAST(value AS VARCHAR), '|' ORDER BY sensor_id, seq) AS sensor_string
        FROM readable WHERE timestamp NOT IN (SELECT timestamp FROM hits) GROUP BY timestamp""",
    "keyed_stream_state": f"""WITH {READABLE}, {scanned('readable', BASE_STREAKS)}
        SELECT 'R2' AS name, sensor_id, CAST(arg_max(streak_r2, seq) AS DOUBLE) AS last_value FROM scanned
            WHERE sensor_id = 'view' GROUP BY sensor_id
        UNION ALL SELECT 'last', sensor_id, arg_max(value, seq) FROM readable WHERE sensor_id = 'click' GROUP BY sensor_id""",
    "keyed_stream_quarantine": f"""WITH {READABLE}, r AS (SELECT *, seq % 50 AS k FROM tel)
        SELECT CASE WHEN k IN (9, 11) THEN timestamp END AS timestamp, CASE k WHEN 11 THEN sensor_id END AS sensor_id,
            CASE k WHEN 9 THEN CAST(value AS VARCHAR) WHEN 11 THEN 'n/a' END AS value, CASE WHEN k IN (9, 11) THEN priority END AS priority,
            seq, {PAYLOAD_REASON} AS reject_reason, CASE k WHEN 7 THEN 'noise ' || seq
                WHEN 8 THEN substr('{{"timestamp":"' || timestamp || '","sensor_id"', 1, 30) END AS line
        FROM r, (VALUES (1), (2)) c(copy) WHERE k BETWEEN 7 AND 11 AND (copy = 1 OR seq % 97 = 0)
        UNION ALL SELECT timestamp, sensor_id, CAST(value AS VARCHAR), priority, seq, 'late', NULL FROM readable WHERE seq % 97 = 0""",
    "stream_progress": f"""WITH {READABLE}, e AS (SELECT max(seq) + 1 AS e FROM tel),
        parts AS (SELECT tel.*, CASE WHEN seq < e // 3 THEN 0 WHEN seq < 2 * e // 3 THEN 1 ELSE 2 END AS part FROM tel, e),
        newest AS (SELECT part, max(max(CASE WHEN seq % 50 NOT BETWEEN 7 AND 11 THEN timestamp END)) OVER (ORDER BY part) AS newest
            FROM parts GROUP BY part),
        came AS (SELECT 2 * part AS batch_id, count(*) AS arrived, 0 AS rows, count(*) FILTER (seq % 50 BETWEEN 7 AND 11) AS rejected
            FROM parts GROUP BY part),
        closed AS (SELECT 2 * part + 1 AS batch_id, 0 AS arrived,
                (SELECT count(*) FROM readable r WHERE r.timestamp < n.newest) AS total, 0 AS rejected FROM newest n),
        every AS (SELECT * FROM came UNION ALL SELECT batch_id, arrived, total - coalesce(lag(total) OVER (ORDER BY batch_id), 0), rejected FROM closed)
        SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(arrived AS BIGINT) AS arrived, CAST(rows AS BIGINT) AS rows, CAST(0 AS BIGINT) AS late,
            CAST(rejected AS BIGINT) AS rejected, CAST(arrived AS BIGINT) AS seen_arrived, CAST(rows AS BIGINT) AS seen_rows,
            CAST(0 AS BIGINT) AS seen_late, CAST(rejected AS BIGINT) AS seen_rejected FROM every""",
    "sensor_counts": f"""WITH {TEL} SELECT timestamp, count(DISTINCT sensor_id) AS sensors,
        count(*) AS readings FROM tel GROUP BY timestamp""",
    "unknown_sensors": f"""WITH {TEL} SELECT sensor_id, count(*) AS readings FROM tel
        WHERE sensor_id NOT IN ('click', 'view') GROUP BY sensor_id""",
    "batch_metrics": f"""WITH {judged()},
        r AS (SELECT seq - seq % 1000 AS batch, count(*) AS rows FROM tel GROUP BY 1),
        a AS (SELECT seq - seq % 1000 AS batch, count(*) AS alarms FROM hits GROUP BY 1)
        SELECT r.batch, rows, coalesce(alarms, 0) AS alarms FROM r LEFT JOIN a ON a.batch = r.batch""",
    "replicate": f"""WITH {COPIES} SELECT seq, sensor_id, value,
        strftime(CAST(replace(timestamp, 'Z', '') AS TIMESTAMP) + to_hours(copy), '%Y-%m-%dT%H:%M:%SZ')
        AS timestamp FROM copies""",
    "replicated_alarms": all_alarms(COPIES, "copies"),
    "row_numbers": f"WITH {ORD} SELECT seq, CAST(row_number() OVER (ORDER BY seq) - 1 AS BIGINT) AS row FROM ord",
    "retime": f"""WITH {TEL}, {DIRTY}, n AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS row FROM dirty)
        SELECT seq, CASE WHEN seq % 40 IN (1, 2, 3, 4, 6) THEN timestamp
        WHEN seq % 40 = 5 THEN 'NA'
        ELSE strftime(TIMESTAMP '2026-05-01 00:00:00' + to_seconds(row // 12), '%Y-%m-%dT%H:%M:%SZ') END
        AS timestamp FROM n""",
    "grid": f"""WITH {TEL} SELECT t.timestamp, c.sensor_id
        FROM (SELECT DISTINCT timestamp FROM tel) t CROSS JOIN {CATALOGUE}""",
    "best_batch": """WITH r AS (SELECT o_custkey % 16 AS batch_size, max(o_totalprice) AS seconds,
        count(*) AS rows, min(o_orderkey) AS max_kb FROM orders GROUP BY 1)
        SELECT batch_size, seconds, rows / seconds AS rows_per_second, max_kb / 1024.0 AS max_mb
        FROM r ORDER BY seconds, batch_size LIMIT 1""",
    "csv_scan": FILE_ROWS,
    "json_scan": FILE_ROWS,
    "alarm_lines_written": f"""SELECT concat_ws(';', timestamp, rule_id, priority, sensor_id, value)
        AS line FROM ({all_alarms()})""",
    "nominal_lines_written": f"""SELECT concat_ws(';', timestamp, status, sensor_string) AS line
        FROM ({PACKED})""",
    "stream_alarms": all_alarms(),
    "stream_nominal": ALL_NOMINAL,
    "stream_state": f"""WITH {TEL}, {scanned('tel', BASE_STREAKS)}
        SELECT 'R2' AS rule_id, 'view' AS sensor_id, CAST(arg_max(streak_r2, seq) AS BIGINT) AS streak
        FROM scanned WHERE sensor_id = 'view'""",
}
