"""Run registered queries against their SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tables(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        return repr(v)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def difference(spark, con, sf_dir, query, sql):
    """None if both give the same rows, else a short text."""
    want_cols, want = sql_rows(con, sql)
    got_cols, got = spark_rows(query(spark, sf_dir))
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got == want:
        return None if got else "no rows on either side"
    extra, lost = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"{len(got)} rows against {len(want)}; spark only {extra[:3]}; sql only {lost[:3]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from callweave.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = tables(sf), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            fault = difference(session, con, sf, query, sqls[name]) if name in sqls else "no sql"
        except Exception as error:
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        bad += fault is not None
        print(f"{'ok  ' if fault is None else 'FAIL'} {name} {time.time() - start:.2f}s {fault or ''}", flush=True)
    print("failures:", bad)
