"""Run registered queries beside their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tables(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def oracle_rows(db, sql: str):
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    return [names[i] for i in order], types, rows


def spark_rows(df):
    names = sorted(df.columns)
    rows = sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=repr)
    return names, dict(df.dtypes), rows


def compare(spark, db, sf_dir: str, make, sql: str | None) -> tuple[bool, str]:
    begun = time.time()
    names, types, rows = spark_rows(make(spark, sf_dir))
    taken = time.time() - begun
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows, no SQL, {taken:.1f}s"
    expected_names, expected_types, expected = oracle_rows(db, sql)
    wanted = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE"}
    mistyped = [
        f"{n}: {types[n]} / {expected_types.get(n)}" for n in names if wanted.get(types[n]) != expected_types.get(n)
    ]
    if names != expected_names:
        return False, f"columns {names} / {expected_names}"
    if rows != expected:
        ours, theirs = set(rows) - set(expected), set(expected) - set(rows)
        return False, f"{len(rows)} / {len(expected)} rows; only ours {sorted(ours, key=repr)[:3]}; only SQL {sorted(theirs, key=repr)[:3]}"
    return True, f"{len(rows)} rows, {taken:.1f}s" + (f"; types differ: {mistyped}" if mistyped else "")


if __name__ == "__main__":
    import __spark_entry__ as registry
    from daybook.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    db = tables(sf_dir)
    made, sql = registry.queries(), registry.oracle_sql()
    failed = []
    for name in names or made:
        try:
            good, note = compare(spark, db, sf_dir, made[name], sql.get(name))
        except Exception as error:  # report and go on with the other queries
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if good else "FAIL", name, note, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
