"""Runs the queries against their SQL: ``python -m checks.compare <sf_dir> [name ...]``."""

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()
# DuckDB type names and the Spark types they must meet.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _rows(rows):
    return sorted(
        (tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows),
        key=_key,
    )


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def difference(df, db, sql):
    """None where the results agree in columns, types and values, else what differs."""
    names = sorted(df.columns)
    result = db.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    if sorted(described) != names:
        return f"columns {names} against {sorted(described)}"
    types = dict(df.dtypes)
    wrong = [c for c in names if TYPES.get(described[c]) != types[c]]
    if wrong:
        return f"types {[(c, types[c], described[c]) for c in wrong]}"
    order = [list(described).index(c) for c in names]
    expected = _rows([tuple(r[i] for i in order) for r in result.fetchall()])
    actual = _rows([tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            return f"{left} against {right}"
    return None


def main(sf_dir, *only):
    from checks.oracle import oracle
    from checks.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failed = connect(sf_dir), oracle(), 0
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(run(spark, sf_dir), db, sql[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s  {'ok' if problem is None else problem}")
    missing = set(sql) ^ set(QUERIES)
    print(f"{failed} differ; without a counterpart: {sorted(missing)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
