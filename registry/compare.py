"""Run registered queries and their checks side by side.

    python -m registry.compare [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from crispstar.session import prepare
from registry.oracle import CHECKS
from registry.queries import queries

# Spark type name -> the DuckDB types that hold the same values.
SAME_TYPE = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP", "TIMESTAMP_NS"},
    "boolean": {"BOOLEAN"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def differences(ours: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> list[str]:
    """What differs between the result of a query and its check: columns, types, rows."""
    theirs = con.execute(CHECKS[name])
    names = [d[0] for d in theirs.description]
    found = []
    if sorted(names) != sorted(ours.columns):
        return [f"columns {ours.columns} against {names}"]
    types = dict(zip(names, (str(d[1]) for d in theirs.description)))
    for field in ours.schema:
        mine = field.dataType.simpleString()
        allowed = SAME_TYPE.get(mine, {mine.upper()})
        if types[field.name] not in allowed and types[field.name] != '"NULL"':
            found.append(f"type of {field.name}: {mine} against {types[field.name]}")
    order = [names.index(c) for c in ours.columns]
    mine = Counter(tuple(row) for row in ours.collect())
    other = Counter(tuple(row[i] for i in order) for row in theirs.fetchall())
    if mine != other:
        extra, missing = mine - other, other - mine
        found.append(
            f"{extra.total()} rows only in the query, {missing.total()} only in the check, of {mine.total()};"
            f" e.g. {list(extra)[:2]} against {list(missing)[:2]}"
        )
    if not mine:
        found.append("no rows")
    return found


def main(folder: str, wanted: list[str]) -> int:
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    spark = prepare(builder.config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in wanted or queries():
        begun = time.time()
        try:
            found = differences(queries()[name](spark, folder), con, name) if name in CHECKS else ["no check"]
        except Exception as e:  # report every query, then fail
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - begun:.2f}s {' | '.join(found)}", flush=True)
    print(f"{bad} of {len(wanted or queries())} differ")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.001", args[1:]) else 0)
