"""Those queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from . import licenses


def _templates() -> str:
    rows = []
    for template, (phrase, label) in enumerate([*licenses.BASE, *licenses.PASSAGES]):
        words = phrase.split()
        for place, (one, two) in enumerate(zip(words, words[1:])):
            base = str(template < len(licenses.BASE)).lower()
            rows.append(f"({template}, '{label}', {base}, {len(words) - 1}, {place}, {1 << place}::BIGINT, '{one}', '{two}')")
    return "t(template, label, base, pairs, place, bit, one, two) AS (VALUES " + ", ".join(rows) + ")"


#: All pairs of vectors by cosine, and everything that links lead to.
LINKS = """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS one, b.vec_id AS two FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
  reach AS (SELECT one, two FROM links UNION SELECT r.one, l.two FROM reach r JOIN links l ON r.two = l.one),
  counts AS (SELECT one, count(*) AS n FROM links GROUP BY one),
  lowest AS (SELECT one, min(two) AS low FROM reach GROUP BY one)
  SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
    coalesce(vec_id <= coalesce(low, vec_id), false) AS kept
  FROM embeddings LEFT JOIN counts c ON c.one = vec_id LEFT JOIN lowest l ON l.one = vec_id"""

#: Word pairs joined to template positions, votes by diagonal, neighbouring diagonals merged.
LICENSES = f"""WITH {_templates()},
  d AS (SELECT row_number() OVER () AS rid, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
  p AS (SELECT rid, k, w[k + 1] AS one, w[k + 2] AS two FROM (SELECT rid, w, unnest(range(0, len(w) - 1)) AS k FROM d)),
  votes AS (SELECT rid, template, label, base, pairs, k - place AS diagonal, bit_or(bit) AS bits
    FROM p JOIN t ON t.one = p.one AND t.two = p.two GROUP BY ALL),
  marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) <= {licenses.GAP}
    THEN 0 ELSE 1 END AS new FROM votes),
  spans AS (SELECT *, sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM marked),
  merged AS (SELECT rid, template, label, base, pairs, span, bit_count(bit_or(bits)) / pairs AS cover,
    count(*) FILTER (bit_count(bits) = pairs) AS places, min(diagonal) FILTER (bit_count(bits) = pairs) AS first,
    max(diagonal) FILTER (bit_count(bits) = pairs) AS last FROM spans
    GROUP BY rid, template, label, base, pairs, span),
  found AS (SELECT rid, sum(places) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(last) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND places > 0) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN base THEN places > 0 ELSE cover >= {licenses.COVER} END) AS labels,
    max(CASE WHEN base THEN (places > 0)::INT::DOUBLE ELSE cover END) AS score FROM merged GROUP BY rid)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
  FROM d LEFT JOIN found f ON f.rid = d.rid"""

#: All anchors against all rows, by whole-number inner products.
NEGATIVES = """WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
      list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.q) = len(b.q)),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
    id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10"""


def _crc_table() -> list[int]:
    """The table of the 32-bit cyclic redundancy check, by its rule."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


#: Next state by role for: nothing yet, system, user, system and user, pairs, pairs and user (from 1).
_SHIFTS = {"s": {1: 2}, "u": {1: 3, 2: 4, 5: 6}, "a": {3: 5, 4: 5, 6: 5}}


def _edited(value: str, cost: str, edit: str) -> str:
    """A value is a cost of nine digits and the audit, so that the least text is the best."""
    return f"printf('%09d', substr({value}, 1, 9)::BIGINT + {cost}) || substr({value}, 10) || '{edit}'"


def _inserted(name: str) -> str:
    """The states after one inserted row or none."""
    made = []
    for to in range(1, 7):
        ways = [_edited(f"{name}[{frm}]", "5", "I") for x in "ua" for frm, t in _SHIFTS[x].items() if t == to]
        made.append(f"least({', '.join([f'{name}[{to}]', *ways])})")
    return f"[{', '.join(made)}]"


def _row_read(name: str) -> str:
    """The states after a row that is deleted, kept or given another role."""
    made = []
    free = "fault NOT IN ('b', 'd')"
    for to in range(1, 7):
        ways = [_edited(f"{name}[{to}]", "2", "D")]
        for x, moves in _SHIFTS.items():
            for frm in (f for f, t in moves.items() if t == to):
                own = f"{name}[{frm}]"
                ways.append(f"CASE WHEN initial = '{x}' AND {free} THEN {_edited(own, 'CASE fault WHEN $$t$$ THEN 5 ELSE 0 END', 'K')} END")
                if x != "s":
                    ways.append(f"CASE WHEN {free} THEN {_edited(own, 'CASE fault WHEN $$t$$ THEN 6 ELSE 1 END', 'R')} END")
        made.append(f"least({', '.join(ways)})")
    return f"[{', '.join(made)}]"


_WHITE = "[\\x20\\x09-\\x0D]"
#: Conversations damaged, judged row by row with one state list each, and put together from the cheapest audit.
REPAIR = f"""WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
  c AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda l: ascii(l)::BIGINT)),
    lambda sum, l: xor(sum >> 8, {_crc_table()}[(xor(sum, l) & 255) + 1]::BIGINT)), 4294967295) % 20 AS f FROM h),
  d AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM c WHERE f <> 0),
  n AS (SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
  r AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D]){_WHITE}*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM n),
  t AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, ['000000000', NULL, NULL, NULL, NULL, NULL] AS tops FROM r
    UNION ALL SELECT conv_id, i, {_row_read('z')} FROM (SELECT *, {_inserted('y')} AS z FROM
      (SELECT r.conv_id, r.i, initial, fault, {_inserted('tops')} AS y FROM t JOIN r ON r.conv_id = t.conv_id AND r.i = t.i + 1))),
  e AS (SELECT conv_id, least(z[1], z[5]) AS best FROM (SELECT *, {_inserted('y')} AS z FROM
    (SELECT *, {_inserted('tops')} AS y FROM t QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1))),
  a AS (SELECT conv_id, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM e),
  l AS (SELECT conv_id, p, audit[p] AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM a)),
  m AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS number FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
  o AS (SELECT m.*, CASE edit WHEN 'I' THEN '' ELSE r.text END AS text, r.role,
      bool_or(number = 1 AND edit = 'K' AND r.initial = 's') OVER (PARTITION BY m.conv_id) AS led
    FROM m LEFT JOIN r ON r.conv_id = m.conv_id AND r.i = m.i),
  q AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (number % 2 = 1) = led THEN 'assistant' ELSE 'user' END || ':' || text,
    chr(10) ORDER BY p)) AS digest FROM o WHERE edit <> 'D' GROUP BY conv_id),
  g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
  SELECT DISTINCT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
  FROM conversations LEFT JOIN g USING (conv_id) LEFT JOIN a USING (conv_id) LEFT JOIN q USING (conv_id)"""

ORACLE = {
    "op2_embedding_near_dedup": LINKS, "op10_license_scans": LICENSES, "op12_hard_negatives": NEGATIVES,
    "op13_conversation_repair": REPAIR,
}
