"""Run registered queries against their oracle SQL and report differences."""
from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    got_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want_rows = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, t in df.dtypes:
        if same.get(t) != want_types[name]:
            return f"type of {name}: {t} != {want_types[name]}"
    got, want = rows_of(df.columns, got_rows), rows_of(want_cols, want_rows)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first got {got[:1]} want {want[:1]}"
    for a, b in zip(got, want):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(sorted(df.columns), a, b) if x != y]
            return f"values {repr(bad)[:700]}"
    return None if got else "empty result"


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = argv[0]
    names = argv[1:]
    spark = make_session()
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                diff = difference(df, con, oracle[name])
            else:
                n = df.count()
                diff = f"{n} rows, no oracle" if n else "empty, no oracle"
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__} {str(e)[:600]}"
        took = time.time() - t
        if diff:
            bad += 1
        print(f"{'ok  ' if not diff else 'DIFF'} {name} {took:.1f}s {diff or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
