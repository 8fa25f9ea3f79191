"""Compare a query with its SQL as multisets of rows."""

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    if isinstance(value, (list, tuple)):
        return tuple(canonical(x) for x in value)
    if isinstance(value, dict):
        return tuple(sorted((k, canonical(x)) for k, x in value.items()))
    return value


def differences(spark, query, sql, sf_dir):
    """Column names of both sides, rows only in one or the other."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    ours = sorted(df.columns)
    got = Counter(tuple(canonical(r[c]) for c in ours) for r in (x.asDict(recursive=True) for x in df.collect()))
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = Counter(tuple(canonical(r[i]) for i in order) for r in cur.fetchall())
    return ours, sorted(names), got - want, want - got
