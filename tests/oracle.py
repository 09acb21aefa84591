"""Runs queries beside their SQL twins. As a script: oracle.py SF_DIR [name ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, int | float):
        return "nan" if isinstance(value, float) and math.isnan(value) else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def kind(type_name: str) -> str:
    name = type_name.lower()
    for group, members in {
        "int": ("int", "bigint", "hugeint", "smallint", "tinyint", "long"),
        "float": ("double", "float", "decimal"),
        "text": ("string", "varchar"),
        "time": ("timestamp",),
    }.items():
        if name.startswith(members):
            return group
    return name


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in names, types, row count and values; none if all agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: kind(str(d[1])) for d in cursor.description}
    wanted = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    faults = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        if kind(field.dataType.simpleString()) != types[field.name]:
            faults.append(f"type of {field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    if len(got) != len(wanted):
        faults.append(f"{len(got)} rows against {len(wanted)}")
    wrong = [(g, w) for g, w in zip(got, wanted, strict=False) if g != w]
    if wrong:
        faults.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return faults


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="oracle-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:]
    con, sqls = connect(folder), contract.oracle_sql()
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sqls:
                faults = compare(df, con, sqls[name])
                state = "ok" if not faults else "FAULT " + "; ".join(faults)
            else:
                rows = df.collect()
                state = f"rows {len(rows)}: {rows[0] if rows else None}"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            state = "ERROR " + str(error)[:600]
        print(f"{name:24s} {time.time() - start:7.2f}s {state}", flush=True)
    missing = set(sqls) - set(contract.queries())
    print("oracle without query:", missing or "none")
