"""Run registered queries against their SQL in DuckDB: rows, columns, types and values.

    python tools/verify.py [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return ("", "")
    if isinstance(v, bool):
        return ("n", float(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return ("n", "nan" if math.isnan(f) else float(f"{f:.9g}"))
    return ("s", str(v))


def compare(df, con, sql):
    """None when equal, else what differs."""
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return f"columns: spark {cols} sql {sorted(names)}", len(got)
    pos = [names.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in pos) for r in rel.fetchall())
    if len(got) != len(want):
        return f"rows: spark {len(got)} sql {len(want)}", len(got)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return f"{len(bad)} of {len(got)} rows differ, first: {diff[:4]} in {[x[1] for x in a][:6]}", len(got)
    return None, len(got)


def main(argv):
    import importlib.util
    from umbral.session import local_session
    sf = argv[0] if argv else "0.001"
    spec = importlib.util.spec_from_file_location("entry", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(qs)
    names = [n for n in qs if any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in names)] if argv[1:] else names
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(f"/root/testdata/sf{sf}")
    failed = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, f"/root/testdata/sf{sf}")
            if n in sqls:
                why, rows = compare(df, con, sqls[n])
            else:
                why, rows = None, df.count()
        except Exception as e:  # noqa: BLE001
            why, rows = f"{type(e).__name__}: {str(e)[:700]}", -1
        failed += why is not None
        print(f"{'ok  ' if why is None else 'FAIL'} {n:28s} {rows:7d} rows {time.time() - t0:6.1f}s {'' if n in sqls else '(no sql)'} {why or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
