"""Run registered queries next to their DuckDB SQL: python tests/oracle_check.py sf0.01 [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql) -> str | None:
    """``None`` if both sides agree on names and on the bag of rows."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = as_bag(names, found.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: spark {sorted(spark_df.columns)} duckdb {sorted(names)}"
    kinds = dict(zip(names, [str(d[1]) for d in found.description], strict=True))
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind) != kinds[name].upper():
            return f"type of {name}: spark {kind} duckdb {kinds[name]}"
    actual = as_bag(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    return (
        f"rows differ: spark {actual.total()} duckdb {expected.total()}; only spark "
        f"{list((actual - expected).items())[:3]}; only duckdb {list((expected - actual).items())[:3]}"
    )


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    wanted = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                note = problem or "ok"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as exc:
            problem = note = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
