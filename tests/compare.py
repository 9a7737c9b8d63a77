"""Compare registered queries with their SQL: columns, row count, values in any order."""

import duckdb


def normal(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value if value is None else str(value)


def tables(sf):
    con = duckdb.connect()
    for name in (
        "region nation customer supplier part orders lineitem events documents embeddings "
        "pages benchmark labels conversations"
    ).split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in data), key=repr
    )


def differences(df, con, sql):
    """Empty text if equal, else what differs."""
    mine_columns, mine = rows(df.columns, df.collect())
    relation = con.sql(sql)
    their_columns, theirs = rows(relation.columns, relation.fetchall())
    if mine_columns != their_columns:
        return f"columns {mine_columns} vs {their_columns}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}: {list(set(mine) ^ set(theirs))[:4]}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ: {wrong[:2]}" if wrong else ""
