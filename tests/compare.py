"""Run registered queries and their SQL side by side: python tests/compare.py FOLDER [NAME ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def difference(frame, connection, sql):
    """None when rows, names and types agree, else what differs first."""
    result = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    names = sorted(frame.columns)
    if names != sorted(types):
        return f"columns {names} and {sorted(types)}"
    for field in frame.schema:
        wanted = DUCK_TYPES[field.dataType.simpleString()]
        if types[field.name] != wanted:
            return f"type of {field.name}: {wanted} and {types[field.name]}"
    order = list(types)
    expected = sorted((tuple(row[order.index(n)] for n in names) for row in expected_rows), key=repr)
    found = sorted((tuple(row[n] for n in names) for row in frame.collect()), key=repr)
    if len(found) != len(expected):
        return f"{len(found)} rows and {len(expected)}"
    for a, b in zip(found, expected):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"row {a} and {b}"
    return None


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a):
        return math.isnan(b)
    return a == b


def main(folder, names):
    from __spark_entry__ import oracle_sql, queries
    from quipu.session import local_session

    spark = local_session("compare")
    connection = connect(folder)
    sql, run = oracle_sql(), queries()
    bad = 0
    for name in names or run:
        started = time.time()
        try:
            frame = run[name](spark, folder)
            if name in sql:
                found = difference(frame, connection, sql[name])
                verdict = "equal" if found is None else f"DIFFERENT: {found}"
            else:
                rows = frame.collect()
                verdict = f"{len(rows)} rows {frame.columns} {rows[:3]}"
        except Exception as error:  # noqa: BLE001
            verdict = f"FAILED: {str(error)[:600]}"
        bad += "DIFFERENT" in verdict or "FAILED" in verdict
        print(f"{name} [{time.time() - started:.1f}s] {verdict[:900]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
