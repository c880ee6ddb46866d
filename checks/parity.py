"""Run the registered queries and their SQL side by side: `python -m checks.parity <sf_dir> [name ...]`."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

_FAMILIES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


def sql_rows(sf_dir: str, sql: str) -> tuple[dict[str, str], Counter]:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(names)), key=names.__getitem__)
    return types, Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def spark_rows(df: DataFrame) -> tuple[dict[str, str], Counter]:
    types = {name: _FAMILIES.get(kind, kind.upper()) for name, kind in df.dtypes}
    order = sorted(df.columns)
    return types, Counter(tuple(row) for row in df.select(*order).collect())


def differences(spark: SparkSession, sf_dir: str, name: str) -> list[str]:
    """What differs between a query and its SQL; empty when they agree."""
    got_types, got = spark_rows(QUERIES[name](spark, sf_dir))
    want_types, want = sql_rows(sf_dir, ORACLE[name])
    found = []
    if got_types != {k: v.replace("DECIMAL(18, ", "DECIMAL(18,") for k, v in want_types.items()}:
        found.append(f"types {got_types} != {want_types}")
    if got != want:
        found.append(f"{got.total()} rows != {want.total()}: extra {list((got - want).items())[:2]}, missing {list((want - got).items())[:2]}")
    if not got:
        found.append("no rows")
    return found


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        began = time.time()
        try:
            result = differences(spark, sf_dir, name) or ["ok"]
        except Exception as error:  # report and go on with the next query
            result = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{name:24} {time.time() - began:6.2f}s", *result, flush=True)


if __name__ == "__main__":
    main()
