"""Run queries and their SQL side by side: ``python -m verification.compare [sf_dir] [name ...]``."""

import glob
import math
import os
import sys
import time

import duckdb

from freshet.session import build_session
from verification.oracles import ORACLES
from verification.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def normal(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, sf_dir: str, name: str, connection) -> str | None:
    """None if both sides agree, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    ours = [tuple(r) for r in frame.collect()]
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    a, b = normal(ours, frame.columns), normal(theirs, names)
    if len(a) != len(b):
        return f"{len(a)} / {len(b)} rows; e.g. {(set(a) ^ set(b)).pop() if set(a) ^ set(b) else a[:1]}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                outcome = difference(spark, sf_dir, name, connection) or "ok"
            else:
                outcome = f"rows {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as error:
            outcome = f"ERROR {str(error)[:500]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {outcome}", flush=True)
