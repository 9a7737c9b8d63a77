"""Personal data: patterns propose spans, validators confirm them, context words adjust the score.

A proposal has a prior score. A validator (label lengths, octets, Luhn, digit counts, mod-97) drops
it or raises its score; a context word within ``CONTEXT`` letters before it raises it further. Spans
that reach ``THRESHOLD`` are kept. The four base kinds follow fixed patterns, leftmost and without
overlap in a kind, and always pass once valid. Further spans are sought where no base span lies:
cards and phones inside longer runs of digits, phones without a plus sign, account numbers and
social security numbers.

Null text is empty text and has no span. Overlaps between kinds are kept. Texts of any length are
searched whole. Repeated rows and extra columns pass unchanged; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_text, slices, strings

#: Kinds in the order of equal starts.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
THRESHOLD = 0.5
CONTEXT = 40
#: Fixed: the base patterns. Mail addresses are sought from the @ sign and IP addresses from the first
#: digit of a run, which gives the same matches in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Proposals of the method beside the base.
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]+")
INNER_PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])")
PLAIN_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Letters and digits of the shortest account number of any country; less is not tried when a run is cut.
SHORTEST = 15
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: Context words of a kind.
WORDS = {
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|téléphone|teléfono)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social|security|taxpayer)\b"),
}
#: Digits of the groups in which card numbers are written; one group may have 14 to 19.
SHAPES = ((16,), (4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
LUHN_DOUBLE = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(LUHN_DOUBLE[int(d)] for d in even)) % 10 == 0


def mod_97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def accounts(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers; what follows one in capitals or digits is cut off word by word until the check holds."""
    at = 0
    while m := IBAN.search(text, at):
        start, end = m.span()
        at = end
        while end - start >= 12:
            number = text[start:end].replace(" ", "")
            if (end == m.end() or len(number) >= SHORTEST) and IBAN.fullmatch(text, start, end) and mod_97(number):
                yield start, end
                at = end
                break
            end = text.rfind(" ", start, end)
        else:
            # The number may begin in a later word of the run.
            at = start + 1


def digits(text: str) -> str:
    return "".join(GROUP.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def valid_ip(text: str) -> bool:
    return all(len(part := x.lstrip("0")) <= 3 and int(part or 0) <= 255 for x in text.split("."))


def base_spans(text: str, has_digit: bool) -> Iterator[tuple[int, int, str]]:
    """Spans of the four base kinds; a failing match is dropped whole."""
    for start, end in emails(text):
        yield start, end, "email"
    if not has_digit:
        return
    for m in IP.finditer(text):
        if valid_ip(m[0]):
            yield *m.span(), "ip"
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(number := digits(m[0])) <= 19 and luhn(number):
            yield *m.span(), "card"
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits(m[0])) <= 15:
                yield *m.span(), "phone"


def inner_cards(text: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Numbers written in the usual groups inside a longer run that failed as a card."""
    whole = {(a, b) for a, b, kind in base if kind == "card"}
    for m in CARD.finditer(text):
        if m.end() - m.start() < 15 or m.span() in whole:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m[0])]
        sizes = [b - a for a, b in groups]
        first = 0
        while first < len(groups):
            step = 1
            for shape in SHAPES:
                last = first + len(shape)
                own = sizes[first:last]
                if own == list(shape) or len(shape) == 1 and 14 <= own[0] <= 19:
                    start, end = groups[first][0], groups[last - 1][1]
                    if luhn(digits(text[start:end])):
                        yield start, end
                        step = len(shape)
                        break
            first += step


class Held:
    """Spans that hold a part of the text, merged where they overlap and sorted."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return not at or self.ends[at - 1] <= start

    def hold(self, spans: list[tuple[int, int]]) -> None:
        """All at once, as one more span alone would move all that follow it."""
        before, self.starts, self.ends = [*zip(self.starts, self.ends), *spans], [], []
        for start, end in sorted(before):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)


def more_spans(text: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str, float]]:
    """Proposals beside the base spans with prior and validator's score."""
    held = Held()
    held.hold([(a, b) for a, b, _ in base])
    found = [("card", 0.6, list(inner_cards(text, base)))]
    if "+" in text:
        found.append(("phone", 0.7, [m.span() for m in INNER_PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]))
    found.append(("phone", 0.3, [m.span() for m in PLAIN_PHONE.finditer(text)]))
    found.append(("iban", 0.7, list(accounts(text))))
    numbers = []
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            numbers.append(m.span())
    found.append(("ssn", 0.3, numbers))
    # Proposals of one pattern don't overlap with each other.
    for kind, score, spans in sorted(found, key=lambda f: -f[1]):
        spans = [s for s in spans if held.free(*s)]
        held.hold(spans)
        yield from ((start, end, kind, score) for start, end in spans)


def find_spans(text: str) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, end, base, score) in code points, by start and kind."""
    has_digit = DIGIT.search(text) is not None
    if not has_digit and "@" not in text:
        return []
    base = list(base_spans(text, has_digit))
    out = []
    rest = more_spans(text, base) if has_digit else ()
    for start, end, kind, *score in (*base, *rest):
        words = WORDS.get(kind)
        near = words is not None and words.search(text, max(0, start - CONTEXT), start) is not None
        value = min(1.0, (score[0] if score else 0.8) + 0.2 * near)
        if value >= THRESHOLD:
            out.append((kind, start, end, not score, value))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])
)


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans of each row."""
    kind = docs.schema[key].dataType.simpleString()
    names = [f.name for f in SPANS_ARROW.value_type]

    def work():
        def step(batch):
            spans = [[dict(zip(names, s)) for s in find_spans(t)] for t in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPANS_ARROW)], ["key", "spans"])

        return step

    return map_text(docs, work, f"key {kind}, spans {SPANS}", [key, text]).withColumnRenamed("key", key)


def masked(text: str) -> str:
    """The text with a label in the place of each span; overlapping spans give one label."""
    out, end = [], 0
    for kind, start, stop, *_ in find_spans(text):
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]]) if out else text


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns with spans in the text replaced by labels; null texts stay null.

    A length column, if there is one, gets the new length where the text changed.
    """
    names = docs.columns
    place, size = names.index(text), names.index(length) if length in names else None

    def run(batches):
        for batch in slices(batches, place):
            old = batch.column(place).to_pylist()
            new = [x and masked(x) for x in old]
            columns = list(batch.columns)
            columns[place] = pa.array(new, batch.column(place).type)
            if size is not None:
                was = batch.column(size).to_pylist()
                columns[size] = pa.array([w if a is b or a == b else len(b) for w, a, b in zip(was, old, new)], batch.column(size).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and the text of all spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        key,
        *(count(kind) for kind in KINDS[:4]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
