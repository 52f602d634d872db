"""Run the registered queries next to their SQL twins: python tests/compare.py [sf] [names]."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else v
        return v

    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def differences(df, db, sql):
    """An empty string when the Spark result equals the SQL result."""
    mine = df.collect()
    answer = db.execute(sql)
    names = [c[0] for c in answer.description]
    theirs = answer.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    a, b = canonical(mine, df.columns), canonical(theirs, names)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    import __spark_entry__ as entry
    from gleanery.session import local_session

    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("OFF")
    folder = f"/root/testdata/sf{sf}"
    db = connect(folder)
    oracles = entry.oracle_sql()
    chosen = sys.argv[2:] or list(entry.queries())
    for name in chosen:
        started = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            verdict = differences(df, db, oracles[name])
        except Exception as error:
            verdict = f"{type(error).__name__} {str(error)[:1500]}"
        print(f"{'ok  ' if not verdict else 'FAIL'} {name} {time.time() - started:.1f}s {verdict[:1800]}", flush=True)


if __name__ == "__main__":
    main()
