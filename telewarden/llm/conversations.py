"""Conversation structure repair by generalised LR parsing over the roles.

Roles form an optional system turn and then pairs of user and assistant, or nothing. The tables of the
LR automaton are made from that grammar. Rows are read in order of their turns. Each row may be kept
(its role's first letter is shifted), get another role, or be deleted, and rows may be inserted
anywhere; all stacks are followed at once. Stacks are linked lists that share what lies below; of
stacks with equal tops the one with the least (cost, audit) stays. In this grammar a top has the same
stack below it always, so merging loses nothing. Nor can an audit be the beginning of another one of
the same cost, so the order of two audits stays the same whatever follows.

A long conversation isn't read by one task: rows are spread by ranges of (conversation, turn), and
each task reads its piece of at most ``PIECE`` rows from every top that may have come before. A piece
becomes a table from the top before to the top after with cost and audit; the few tables of a
conversation are put together in order. Rows enter that with a hash of their text. Rows that repeat
another one whole are one row with a count. Then texts meet the finished audit, as a sorted stream.

Faults, in this order, a row's first one counts: blank (no letter but white space), duplicate (an
earlier row has its role and text), truncated (the last letter other than white space is none of
``.!?``). Null role and text count as one space, null turns come first, and null is a conversation
like any other. Rows of one turn are ordered by role and the text's hash. A conversation of any length
is repaired whole; its audit and the running hash over its rows are sequential by their nature. An
empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import Staging

#: The grammar: the start symbol is the first one.
GRAMMAR = (("S", ""), ("S", "P"), ("P", "ua"), ("P", "sua"), ("P", "Pua"))
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
#: What a truncated row costs if it is not deleted.
TRUNCATED = 5
ROLES = {"u": "user", "a": "assistant"}
END = "$"
#: Rows of a piece of a conversation.
PIECE = 2048
#: Neighbouring role initials that are no fault.
LEGAL = ("su", "ua", "au")
#: Fixed: white space.
WHITE = " \t\n\x0b\x0c\r"
#: Pieces of up to so many rows are remembered by a worker with their tables.
SHORT = 16


def automaton() -> tuple[list[dict[str, int]], list[dict[str, int]]]:
    """For each state the next state by symbol, and the rule to reduce by next letter (an SLR table).

    The state after the start symbol accepts.
    """
    rules = [("", GRAMMAR[0][0]), *GRAMMAR]
    heads = {head for head, _ in GRAMMAR}

    def closure(items):
        found, open_ = set(items), list(items)
        while open_:
            rule, dot = open_.pop()
            after = rules[rule][1][dot : dot + 1]
            for i, (head, _) in enumerate(rules):
                if head == after and head and (i, 0) not in found:
                    found.add((i, 0))
                    open_.append((i, 0))
        return frozenset(found)

    follow = {h: {END} if h == GRAMMAR[0][0] else set() for h in heads}
    changed = True
    while changed:
        changed = False
        for head, body in GRAMMAR:
            for i, symbol in enumerate(body):
                if symbol in heads:
                    # No symbol but the start symbol can be empty, and that stands in no body.
                    after = body[i + 1 : i + 2]
                    more = (follow[head] if not after else {after}) - follow[symbol]
                    changed |= bool(more)
                    follow[symbol] |= more
    states, moves, reduces = [closure({(0, 0)})], [], []
    for state in states:
        moved, reduced = {}, {}
        for symbol in sorted({rules[r][1][d] for r, d in state if d < len(rules[r][1])}):
            target = closure({(r, d + 1) for r, d in state if rules[r][1][d : d + 1] == symbol})
            if target not in states:
                states.append(target)
            moved[symbol] = states.index(target)
        for r, d in state:
            if d == len(rules[r][1]) and r:
                reduced |= dict.fromkeys(follow[rules[r][0]], r - 1)
        moves.append(moved)
        reduces.append(reduced)
    return moves, reduces


MOVES, REDUCES = automaton()
ACCEPT = MOVES[0][GRAMMAR[0][0]]


class Top:
    """Top of a stack: its state, what lies below, the cost so far and the audit."""

    __slots__ = ("state", "below", "cost", "audit")

    def __init__(self, state: int, below: Top | None, cost: int = 0, audit: str = ""):
        self.state, self.below, self.cost, self.audit = state, below, cost, audit

    def reduced(self, rule: int) -> Top:
        """The stack with the body of the rule replaced by its head."""
        head, body = GRAMMAR[rule]
        base = self
        for _ in body:
            base = base.below
        return Top(MOVES[base.state][head], base, self.cost, self.audit)

    def before(self, letter: str) -> Top:
        """The stack after all reductions that the next letter asks for."""
        top = self
        while (rule := REDUCES[top.state].get(letter)) is not None:
            top = top.reduced(rule)
        return top

    def shifted(self, letter: str, cost: int, edit: str) -> Top | None:
        top = self.before(letter)
        state = MOVES[top.state].get(letter)
        if state is None:
            return None
        top = Top(state, top, self.cost + cost, self.audit + edit)
        # Where nothing can be shifted the one reduction needs no next letter.
        while not MOVES[top.state] and (rules := set(REDUCES[top.state].values())):
            top = top.reduced(rules.pop())
        return top

    def edited(self, cost: int, edit: str) -> Top:
        return Top(self.state, self.below, self.cost + cost, self.audit + edit)


Tops = dict[int, Top]


def merged(tops: Tops, more: Top | None) -> bool:
    """Put a stack among the others; of equal tops the least (cost, audit) stays."""
    if more is None:
        return False
    old = tops.get(more.state)
    if old is None or (more.cost, more.audit) < (old.cost, old.audit):
        tops[more.state] = more
        return True
    return False


def inserted(tops: Tops) -> Tops:
    """The tops after any number of inserted rows."""
    open_ = list(tops.values())
    while open_:
        top = open_.pop()
        if tops.get(top.state) is top:
            for letter in ROLES:
                more = top.shifted(letter, INSERT, "I")
                if merged(tops, more):
                    open_.append(more)
    return tops


def read(tops: Tops, initial: str, fault: str) -> Tops:
    """The tops after a row. ``fault`` is b(lank), d(uplicate), t(runcated) or empty."""
    out: Tops = {}
    for top in inserted(tops).values():
        merged(out, top.edited(DELETE, "D"))
        if fault not in ("b", "d"):
            more = TRUNCATED if fault == "t" else 0
            merged(out, top.shifted(initial, KEEP + more, "K"))
            for letter in ROLES:
                merged(out, top.shifted(letter, REROLE + more, "R"))
    return out


def stacks() -> Tops:
    """A stack for every top that can stand between two rows, by shifting from the empty one."""
    found = {0: Top(0, None)}
    open_ = [found[0]]
    while open_:
        top = open_.pop()
        for letter in "sua":
            if (more := top.shifted(letter, 0, "")) and more.state not in found:
                found[more.state] = more
                open_.append(more)
    return {s: Top(t.state, t.below) for s, t in found.items()}


STACKS = stacks()
#: From the top after the last row to the end.
Table = dict[int, tuple[int, str]]


def piece_table(rows: tuple[tuple[str, str], ...], start: int) -> Table:
    """Cost and audit by the top after the rows (initial, fault), from the top before them."""
    tops = {start: STACKS[start]}
    for initial, fault in rows:
        tops = read(tops, initial, fault)
    return {state: (top.cost, top.audit) for state, top in tops.items()}


short_table = lru_cache(maxsize=1 << 14)(piece_table)


@lru_cache(maxsize=64)
def ending(start: int) -> tuple[int, str] | None:
    """The cheapest inserted rows after which the roles are complete."""
    ends = [t for t in inserted({start: STACKS[start]}).values() if t.before(END).state == ACCEPT]
    return min(((t.cost, t.audit) for t in ends), default=None)


def initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def text_facts(rows: DataFrame) -> DataFrame:
    """conv, turn, role, the hashes h and g of the text, blank, cut, and how many rows are the same."""
    stripped = F.rtrim("text", F.lit(WHITE))
    return (
        rows.select(
            "conv", "turn", "role",
            F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"),
            (stripped == "").alias("blank"),
            (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"),
        )
        .groupBy("conv", "turn", "role", "h", "g", "blank", "cut")
        .agg(F.count("*").alias("times"))
    )


PIECES = (
    "conv {kind}, part int, place long, tables array<struct<start:int,ends:array<struct<state:int,cost:long,audit:string>>>>,"
    " blank long, duplicate long, truncated long, illegal long, first_role string, last_role string,"
    " first_turn long, last_turn long, turns long"
)


class Piece:
    """Rows of one conversation that follow each other, being collected."""

    def __init__(self, conv, first: bool):
        self.conv, self.first = conv, first
        self.rows: list[tuple[str, str]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, turn, role: str, blank: bool, cut: bool, again: bool, times: int) -> None:
        if self.first_role is None:
            self.first_role = role
        elif self.last_role + role not in LEGAL:
            self.illegal += 1
        self.illegal += times - 1
        self.last_role = role
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if blank:
            self.blank += times
            self.rows += [(role, "b")] * times
        else:
            self.duplicate += times - (not again)
            self.truncated += cut and not again
            self.rows += [(role, "d" if again else "t" if cut else "")] + [(role, "d")] * (times - 1)

    def tables(self) -> list[dict]:
        rows = tuple(self.rows)
        table = short_table if len(rows) <= SHORT else piece_table
        return [
            {"start": s, "ends": [{"state": t, "cost": c, "audit": a} for t, (c, a) in table(rows, s).items()]}
            for s in ([0] if self.first else STACKS)
        ]

    def row(self, part: int, place: int) -> list:
        return [
            self.conv, part, place, self.tables(), self.blank, self.duplicate, self.truncated, self.illegal,
            self.first_role, self.last_role, self.first_turn, self.last_turn, self.turns,
        ]


def pieces(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted rows (conv, turn, initial, blank, cut, again, times) of a task."""
    part, place, piece, out = TaskContext.get().partitionId(), 0, None, []

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return made

    for found in batches:
        for conv, turn, role, blank, cut, again, times in zip(*(c.to_pylist() for c in found.columns)):
            other = piece is None or piece.conv != conv
            # Rows that repeat come as one with a count, which may itself be longer than a piece.
            while times:
                if other or len(piece.rows) >= PIECE:
                    if piece:
                        out.append(piece.row(part, place))
                        place += 1
                    # The first conversation of a task may have begun in the task before.
                    piece = Piece(conv, other and piece is not None)
                    other = False
                now = min(times, max(1, PIECE - len(piece.rows)))
                piece.add(turn, role, blank, cut, again, now)
                times -= now
                again = again or not blank
            if len(out) >= 512:
                yield batch()
    if piece:
        out.append(piece.row(part, place))
    if out:
        yield batch()


REPORT = "conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Joined:
    """The pieces of one conversation put together."""

    def __init__(self, conv):
        self.conv = conv
        self.tops: Table = {0: (0, "")}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last_role = self.first_turn = self.last_turn = None

    def add(self, tables, blank, duplicate, truncated, illegal, first_role, last_role, first_turn, last_turn, turns) -> None:
        after: Table = {}
        for table in tables:
            if (before := self.tops.get(table["start"])) is not None:
                for end in table["ends"]:
                    own = (before[0] + end["cost"], before[1] + end["audit"])
                    if end["state"] not in after or own < after[end["state"]]:
                        after[end["state"]] = own
        self.tops = after
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal + (self.last_role is not None and self.last_role + first_role not in LEGAL)
        self.last_role = last_role
        if turns:
            self.turns += turns - (first_turn == self.last_turn)
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn

    def row(self) -> list:
        ends = ((cost + e[0], audit + e[1]) for state, (cost, audit) in self.tops.items() if (e := ending(state)))
        cost, audit = min(ends)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return [self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit]


def joined(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A report for each conversation, from its pieces in order."""
    now, out = None, []

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return made

    for found in batches:
        for i in range(len(found)):
            conv, _, _, *rest = (c[i].as_py() for c in found.columns)
            if now is None or now.conv != conv:
                if now:
                    out.append(now.row())
                now = Joined(conv)
            now.add(*rest)
            if len(out) >= 512:
                yield batch()
    if now:
        out.append(now.row())
    if out:
        yield batch()


def rows_of(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    def space(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    return df.select(F.col(key).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"))


def arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def audits(
    spark: SparkSession, conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """key, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation."""
    staging = Staging(spark)
    kind = conversations.schema[key].dataType.simpleString()
    facts = staging(text_facts(rows_of(conversations, key, turn, role, text)), "facts")
    same = facts.filter("NOT blank").groupBy("conv", "role", "h", "g").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    )
    # Few rows repeat an earlier one; what is joined is a row for each text that comes back in a later turn.
    same = staging(same.filter("n > 1").select("conv", "role", "h", "g", F.col("first.turn").alias("first"), F.lit(True).alias("several")), "same")
    on = F.col("f.conv").eqNullSafe(F.col("s.conv")) & (F.col("f.role") == F.col("s.role")) & (F.col("f.h") == F.col("s.h")) & (F.col("f.g") == F.col("s.g"))
    again = F.coalesce("several", F.lit(False)) & ~F.col("f.blank") & ~F.col("f.turn").eqNullSafe(F.col("s.first"))
    rows = facts.alias("f").join(same.alias("s"), on, "left").select("f.*", again.alias("again"))
    order = ["conv", "turn", "role", "h", "g"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("conv", "turn", initial(F.col("role")), "blank", "cut", "again", "times")
    schema = PIECES.format(kind=kind)
    form = arrow(schema)
    found = staging(rows.mapInArrow(lambda b: pieces(b, form), schema), "pieces")
    found = found.repartition("conv").sortWithinPartitions("conv", "part", "place")
    report = REPORT.format(kind=kind)
    form_of_report = arrow(report)
    out = staging(found.mapInArrow(lambda b: joined(b, form_of_report), report), "audits")
    return out.withColumnRenamed("conv", key)


def replayed(batches, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Repaired rows from the sorted stream (conv, is_row, audit, turn, role, text): a conversation's audit, then its rows.

    Each comes with its number in the repaired conversation (none for deleted ones), its edit, role and text.
    """
    names = ["conv", "number", "turn", "edit", "role", "text"]
    types = [kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out: list[list] = []
    audit, at, number, expected, conv = "", 0, 0, "u", None

    def put(edit, turn, role, text):
        nonlocal number, expected
        if edit == "D":
            out.append([conv, None, turn, edit, role, text])
            return
        if edit in "IR":
            role = ROLES[expected]
        out.append([conv, number, turn, edit, role, text])
        number += 1
        expected = "a" if role[:1] == "u" else "u"

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        out.clear()
        return made

    def insert(stop):
        nonlocal at
        while at < stop and audit[at] == "I":
            put("I", None, None, "")
            at += 1

    size = 0
    for found in batches:
        for own, is_row, new, turn, role, text in zip(*(c.to_pylist() for c in found.columns)):
            if not is_row:
                insert(len(audit))
                audit, at, number, expected, conv = new, 0, 0, "u", own
                continue
            insert(len(audit))
            put(audit[at], turn, role, text)
            at += 1
            size += len(text) + 100
            if size > 1 << 21:
                yield batch()
                size = 0
    insert(len(audit))
    if out:
        yield batch()


def repaired(
    conversations: DataFrame, audited: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """key, number, turn, edit (K, R, D or I), role and text of all rows, inserted and deleted ones too.

    ``number`` counts the rows that remain, in order, from 0. Rows of a conversation stand in order in
    one partition.
    """
    none = F.lit(None).cast("string")
    rows = rows_of(conversations, key, turn, role, text).select(
        "conv", F.lit(True).alias("is_row"), none.alias("audit"), "turn", "role", "text",
        F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"),
    )
    first = audited.select(
        F.col(key).alias("conv"), F.lit(False).alias("is_row"), "audit", F.lit(None).cast("long").alias("turn"), none.alias("role"),
        none.alias("text"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("g"),
    )
    both = rows.unionByName(first).repartition("conv").sortWithinPartitions("conv", "is_row", "turn", "role", "h", "g")
    both = both.drop("h", "g")
    kind = conversations.schema[key].dataType.simpleString()
    form = arrow(f"conv {kind}").field(0).type
    schema = f"conv {kind}, number long, turn long, edit string, role string, text string"
    return both.mapInArrow(lambda b: replayed(b, form), schema).withColumnRenamed("conv", key)


def hashed(batches, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """conv and the hash of ``role:text`` of its remaining rows, newline-joined, from rows in order."""
    names, types = ["conv", "digest"], [kind, pa.string()]
    here, running, any_row, seen, out = None, None, False, False, []
    for found in batches:
        for conv, number, role, text in zip(*(c.to_pylist() for c in found.columns)):
            if not any_row or conv != here:
                if any_row:
                    out.append((here, running.hexdigest()))
                here, running, any_row, seen = conv, hashlib.sha256(), True, False
            if number is not None:
                running.update((("\n" if seen else "") + f"{role}:{text}").encode())
                seen = True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out = []
    if any_row:
        yield pa.RecordBatch.from_arrays([pa.array([here], kind), pa.array([running.hexdigest()], pa.string())], names)


def digests(repaired_rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """key and digest, in the same partitions as the rows: nothing is shuffled."""
    kind = repaired_rows.schema[key].dataType.simpleString()
    form = arrow(f"conv {kind}").field(0).type
    rows = repaired_rows.select(key, "number", "role", "text")
    return rows.mapInArrow(lambda b: hashed(b, form), f"conv {kind}, digest string").withColumnRenamed("conv", key)
