"""Awkward documents for every operator, and small helpers."""

#: Longer than the longest text of the tables.
LONG = " ".join(f"word{i % 977} then" for i in range(30_000))
ROWS = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, LONG, "en", None),
    (4, "one short text, twice", "en", "b"),
    (4, "one short text, twice", "en", "b"),
    (None, "a text without an id", "en", "b"),
    (5, " \n\t ", "en", "c"),
    (6, "🙂 ... 12 \x00 end", "en", "c"),
    (7, "one short text, twice", "en", "c"),
]
#: Names that operators use inside.
CLASHING = (
    "key", "node", "fp", "score", "component_id", "component", "spans", "ids", "runs", "doc", "begin", "kept_key",
    "bad_key", "rows", "t", "p", "q", "part", "of", "id", "label", "a", "b",
)


def documents(spark, rows=ROWS, clashing=True):
    df = spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return df.selectExpr("*", *(f"concat('x', doc_id) AS `{c}`" for c in CLASHING)) if clashing else df


def empty(spark):
    return documents(spark, [])


def by_id(rows):
    """Rows in a fixed order, nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, repr(r)))


def reached(n, links):
    """Smallest node that each of n nodes leads to."""
    labels = list(range(n))

    def root(x):
        while labels[x] != x:
            labels[x] = labels[labels[x]]
            x = labels[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        labels[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]
