"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

from checks.inputs import TABLES
from checks.oracle import ORACLE
from checks.queries import QUERIES


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _counted(rows) -> Counter:
    return Counter(tuple(map(_plain, r)) for r in rows)


def differences(spark, db, sf_dir: str, name: str) -> list[str]:
    """What differs between the two answers; empty if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLE:
        return [] if df.count() else ["no rows"]
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(columns)}"]
    kinds = dict(df.dtypes)
    typed = [f"{c}: {kinds[c]} / {d[1]}" for c, d in zip(columns, cursor.description) if SQL_TYPES.get(kinds[c]) != str(d[1])]
    if typed:
        return ["types " + ", ".join(typed)]
    theirs = _counted(cursor.fetchall())
    ours = _counted(df.select(*[f"`{c}`" for c in columns]).collect())
    if not ours:
        return ["no rows"]
    if ours == theirs:
        return []
    return [
        f"rows {ours.total()} / {theirs.total()}",
        f"only Spark: {list((ours - theirs).items())[:2]}",
        f"only SQL: {list((theirs - ours).items())[:2]}",
    ]


def main(argv: list[str]) -> int:
    from fieldloom.session import build_session

    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    db = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        found = differences(spark, db, sf_dir, name)
        bad += bool(found)
        kind = "" if name in ORACLE else " (no SQL)"
        print(f"{'DIFF' if found else 'ok  '} {name}{kind} {time.time() - start:.1f}s", *found, sep="\n     ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
