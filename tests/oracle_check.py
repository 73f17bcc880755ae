"""Compare queries with their SQL equivalents: ``python tests/oracle_check.py SF [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows in a fixed order, with equal values spelt equally."""
    columns = sorted(frame.columns)

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "<null>"
        if isinstance(value, pd.Timestamp):
            return value.tz_localize(None).isoformat() if value.tz else value.isoformat()
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, float) and value.is_integer():
            return str(int(value))
        return str(value)

    return sorted(tuple(cell(v) for v in row) for row in frame[columns].itertuples(index=False))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def oracle_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    return connect(sf_dir).execute(sql).df()


# Spark's names for the types the results have.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def oracle_types(sf_dir: str, sql: str) -> dict[str, str]:
    described = connect(sf_dir).execute(f"describe {sql}").fetchall()
    return {row[0]: TYPES.get(row[1], row[1]) for row in described}


def spark_types(df) -> dict[str, str]:
    return dict(df.dtypes)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if equal, else what differs first."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    ours, theirs = normal(spark_frame), normal(sql_frame)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            odd = [(x, y) for x, y in zip(a, b) if x != y]
            return f"row differs: {odd[:3]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from medallion.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", shuffle_partitions=8, conf={"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            ours = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            verdict = difference(ours, oracle_frame(sf_dir, sql[name])) if name in sql else "no oracle"
        except Exception as error:
            took, verdict, ours = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        failed += verdict is not None
        print(f"{name:20} {took:6.2f}s {len(ours):8} {verdict or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
