"""Run registered queries beside their SQL twins: python tests/oracle.py [sf] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = [p.stem for p in Path("/root/testdata/sf0.001").glob("*.parquet")]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def normal(v):
    if isinstance(v, float):
        return "nan" if v != v else v + 0.0
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def expected(folder, sql):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    result = db.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def differences(spark, folder, build, sql):
    df = build(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return [] if got[1] else ["no rows"], len(got[1])
    want = expected(folder, sql)
    if got[0] != want[0]:
        return [f"columns {got[0]} / {want[0]}"], len(got[1])
    if len(got[1]) != len(want[1]):
        return [f"rows {len(got[1])} / {len(want[1])}"], len(got[1])
    return [f"{a}\n   / {b}" for a, b in zip(got[1], want[1], strict=True) if a != b], len(got[1])


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from hazecast.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(queries())
    failed = []
    for name in names:
        begun = time.time()
        try:
            bad, n = differences(spark, folder, queries()[name], oracle_sql().get(name))
        except Exception as e:  # report and go on with the next query
            bad, n = [f"{type(e).__name__} {str(e)[:1500]}"], -1
        kind = "sql" if name in oracle_sql() else "rows"
        print(f"{'ok ' if not bad else 'BAD'} {name:40s} {kind:4s} {n:7d} rows {time.time() - begun:6.1f}s", flush=True)
        if bad:
            failed.append(name)
            print(f"   {len(bad)} differ, first: {bad[0]}")
    print("failed:", failed)
