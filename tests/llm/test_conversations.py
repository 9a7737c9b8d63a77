"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import random
import re

import pytest

from telewarden.llm import common, conversations
from telewarden.llm.queries import damaged, op13_conversation_repair

GOAL = re.compile(r"(s?(ua)+)?")
OPEN = re.compile(r"s?(ua)*u?")
ROLES = {"u": "user", "a": "assistant"}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def plain(rows):
    """Least (cost, audit) over (initial, fault) rows, by trying all edits in order of cost."""
    heap, seen, found = [(0, "", 0, "")], set(), []
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if found and cost > found[0][0]:
            break
        if (audit, at) in seen or not OPEN.fullmatch(roles):
            continue
        seen.add((audit, at))
        if at == len(rows) and GOAL.fullmatch(roles):
            found.append((cost, audit))
        if audit[-2:] != "II":
            for x in "ua":
                heapq.heappush(heap, (cost + 5, audit + "I", at, roles + x))
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + (initial or "?")))
                for x in "ua":
                    heapq.heappush(heap, (cost + more + 1, audit + "R", at + 1, roles + x))
    return min(found)


def report(rows):
    """All that is reported of one conversation's rows (turn, role, text), in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+", "", text)[-1:]
        faults.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    cost, audit = plain(list(zip(initials, faults)))
    out, at = [], 0
    for edit in audit:
        expected = "a" if out and out[-1][0][:1] == "u" else "u"
        if edit == "I":
            out.append((ROLES[expected], ""))
            continue
        _, role, text = rows[at]
        at += 1
        if edit != "D":
            out.append((role if edit == "K" else ROLES[expected], text))
    assert GOAL.fullmatch("".join(r[:1] for r, _ in out))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest


def made(number, seed=4):
    r = random.Random(seed)
    rows = []
    for conv in range(number):
        for turn in range(r.randint(1, 7)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = r.choice([f"Text {conv} {turn}.", f"Text {r.randint(0, 2)}!", "cut off", " \t\n", "", None, "done? \n"])
            rows.append((conv, r.choice([turn, turn, turn * 3]), role, text))
    rows += [(None, 0, "user", "One."), (None, 1, "assistant", "Two."), (None, None, "system", "None first."), (9000, None, "user", "Only.")]
    # No two rows of one turn, as their order is the operator's own.
    return list({(c, t): (c, t, x, y) for c, t, x, y in rows}.values())


def frame(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    names = ("conv", "h", "g", "blank", "cut", "audit", "cost", "part", "place", "times", "number", "edit", "fault", "copy")
    return df.selectExpr("*", *(f"concat('x', conv_id) AS `{c}`" for c in names)) if clashing else df


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: report(sorted(r, key=lambda x: (x[0] is not None, x[0] or 0))) for c, r in by.items()}


def found_by(spark, df):
    audits = conversations.audits(spark, df)
    digests = {r.conv_id: r.digest for r in conversations.digests(conversations.repaired(df, audits)).collect()}
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[r.conv_id]) for r in audits.collect()
    }


@pytest.mark.parametrize("piece", [2048, 2, 1])
def test_equals_search(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = made(150)
    assert found_by(spark, frame(spark, rows)) == expected(rows)


def test_tables_are_made_from_the_grammar():
    assert len(conversations.STACKS) == 6
    for roles in ("", "ua", "sua", "uaua", "suaua", "s", "u", "a", "uau", "suas", "usa"):
        tops = {0: conversations.STACKS[0]}
        for x in roles:
            tops = {t.state: t for top in tops.values() if (t := top.shifted(x, 0, "K"))}
        accepted = any(t.before(conversations.END).state == conversations.ACCEPT for t in tops.values())
        assert accepted == bool(GOAL.fullmatch(roles)), roles


def test_long_conversation_and_many_copies(spark):
    """A conversation of many pieces with a run of copies longer than a piece; memory and time stay in proportion."""
    rows = [(1, t, "assistant" if t % 2 else "user", f"Row {t}.") for t in range(9_000)]
    rows += [(1, 4_000, "user", "Again and again.")] * 3_000 + [(1, 20_000, "user", "Last one.")]
    got = found_by(spark, frame(spark, rows, clashing=False))[1]
    assert got[:5] == (20_001 - 9_001, 0, 2_999, 0, 3_000)
    cost, audit = got[5:7]
    assert len(audit) == 12_001 and audit.count("D") == 3_001 and cost == 2 * 3_001


def test_rows_of_one_turn_and_order_in_output(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 1, "assistant", "Yes."), (2, 5, "user", "x"), (2, 6, "tool", "Fine.")]
    df = frame(spark, rows)
    out = conversations.repaired(df, conversations.audits(spark, df)).collect()
    first = [r for r in out if r.conv_id == 1]
    assert [(r.edit, r.role) for r in first] == [("K", "user"), ("K", "assistant"), ("D", "user")]
    second = [r for r in out if r.conv_id == 2]
    assert [(r.number, r.edit) for r in second] == [(None, "D"), (None, "D")]


def test_empty_and_query(spark, tmp_path):
    assert found_by(spark, frame(spark, [])) == {}
    rows = made(60, seed=8)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = op13_conversation_repair(spark, str(tmp_path)).collect()
    after = [tuple(r) for r in damaged(frame(spark, rows)).select("conv_id", "turn", "role", "text").collect()]
    want = expected(after)
    none = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert len(found) == len({r[0] for r in rows})
    for r in found:
        assert tuple(r)[1:] == want.get(r.conv_id, none), r


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(8)] + [(None, None, None, None)]
    got = sorted(map(str, map(tuple, damaged(frame(spark, rows)).collect())))
    want = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub(r"[.!?]", "", text)
        if fault == 4:
            role = "user"
        want += [str((conv, turn, role, text))] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert got == sorted(want)
