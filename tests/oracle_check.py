"""Run registered queries against their DuckDB text: python tests/oracle_check.py [sf] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted([tuple(repr(r[i]) for i in order) for r in rows])


def compare(con, spark, folder, run, sql):
    """Problem text, or None when both sides hold the same rows."""
    df = run(spark, folder)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want_names, want = _rows([c[0] for c in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {got_names}\n   spark {bad[0][0]}\n   duck  {bad[0][1]}" if bad else None


def main():
    import __spark_entry__ as entry
    from orderloom.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0][0].isdigit() else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(folder), []
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in args or queries:
        start = time.time()
        try:
            problem = compare(con, spark, folder, queries[name], sqls.get(name))
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.1f}s {'' if name in sqls else '(rows only)'}", problem or "", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
