"""Runs registered queries beside their check SQL and reports differences."""

from __future__ import annotations

import sys
import time

import duckdb

from glyphlane.plans import load_queries
from glyphlane.plans.registry import TABLES, Tables


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0) if float(v) != 0 else "0.0"
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    entered = load_queries()[name]
    frame = entered.build(Tables(spark, sf_dir))
    got = [tuple(r) for r in frame.collect()]
    if entered.check_sql is None:
        return [] if got else ["no rows"]
    cursor = con.execute(entered.check_sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    problems = []
    if not got:
        problems.append("no rows")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    left, right = canonical(got, frame.columns), canonical(want, names)
    problems += [f"{a}\n      {b}" for a, b in zip(left, right) if a != b][:3]
    return problems


if __name__ == "__main__":
    from glyphlane.session import build_session

    folder = sys.argv[1]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    chosen = sys.argv[2:] or list(load_queries())
    bad = 0
    for name in chosen:
        begin = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(found)
        kind = "" if load_queries()[name].check_sql else " (rows only)"
        print(f"{'FAIL' if found else 'ok  '} {name}{kind} {time.time() - begin:.1f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print("failing:", bad, "of", len(chosen))
