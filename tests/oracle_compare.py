"""Run registered queries against DuckDB and report differences."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree, else a short description of the difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in res.description}
    if types != dict(df.dtypes):
        return f"types {sorted(types.items())} != {sorted(df.dtypes)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first:\n  spark  {bad[0][0]}\n  duckdb {bad[0][1]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    # settings are left alone: results must not depend on them
    spark = SparkSession.builder.master("local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    for name in names:
        t = time.time()
        try:
            diff = compare(spark, con, sf_dir, entry.queries()[name], oracle[name])
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{name}: {'ok' if diff is None else diff} [{time.time() - t:.1f}s]", flush=True)
