"""Run registered queries next to their SQL twins and compare all values.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def kind(column: pd.Series) -> str:
    return {"O": "text", "f": "float", "i": "int", "u": "int", "b": "bool", "M": "time"}.get(column.dtype.kind, "text")


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple("NULL" if v is None or v is pd.NaT or v != v else str(v) for v in row))
    return sorted(rows)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    kinds = [
        f"{c}: {kind(spark_frame[c])}/{kind(sql_frame[c])}"
        for c in spark_frame.columns
        if kind(spark_frame[c]) != kind(sql_frame[c]) and spark_frame[c].notna().all()
    ]
    if kinds and len(spark_frame):
        return "types " + ", ".join(kinds)
    for c in spark_frame.columns:
        if kind(spark_frame[c]) == "time":
            spark_frame[c] = spark_frame[c].astype("datetime64[us]")
            sql_frame[c] = sql_frame[c].astype("datetime64[us]")
        elif kind(spark_frame[c]) == "float" or kind(sql_frame[c]) == "float":
            # adding zero turns -0.0 into 0.0
            spark_frame[c] = spark_frame[c].astype("float64") + 0.0
            sql_frame[c] = sql_frame[c].astype("float64") + 0.0
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first: {wrong[0]}"
    return None


def check(spark, connection, name: str, sf_dir: str) -> tuple[str, int]:
    from tidemark.workload.catalog import ORACLE, QUERIES

    result = QUERIES[name](spark, sf_dir)
    frame = result.toPandas()
    if name not in ORACLE:
        return "no SQL", len(frame)
    cursor = connection.execute(ORACLE[name])
    schema = dict(zip([c[0] for c in cursor.description], [str(c[1]) for c in cursor.description]))
    sql_frame = cursor.df()
    problem = difference(frame, sql_frame)
    if problem is None:
        spark_types = {f.name: f.dataType.simpleString() for f in result.schema.fields}
        pairs = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "DATE": "date"}
        odd = {c: (t, schema[c]) for c, t in spark_types.items() if pairs.get(schema[c]) != t}
        if odd:
            problem = f"schema {odd}"
    return problem or "ok", len(frame)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from tidemark.workload.catalog import QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in wanted:
        begun = time.time()
        try:
            verdict, rows = check(session, connection, name, folder)
        except Exception as failure:
            verdict, rows = f"ERROR {type(failure).__name__}: {str(failure)[:600]}", -1
        bad += verdict not in ("ok", "no SQL")
        print(f"{name:35s} {rows:8d} {time.time() - begun:6.2f}s {verdict}", flush=True)
    print("bad:", bad)
