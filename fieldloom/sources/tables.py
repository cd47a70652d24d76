"""Scans, parameterised SQL and the catalog."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldloom import schemas


def scan(spark: SparkSession, source: str) -> DataFrame:
    """A table by name, or parquet files by path."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def scan_if_exists(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The parquet table at ``path``, or None if nothing was ever written there."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def query(spark: SparkSession, sql: str, **params: Any) -> DataFrame:
    """SQL with named parameters (``:name``, ``identifier(:name)``), never spliced text."""
    return spark.sql(sql, args=params)


def named_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a view of ``df`` and return it by its name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_exists(spark: SparkSession, name: str, schema: str | None = None) -> bool:
    """Is there a table or view of that name? Names are compared in lower case."""
    full = f"{schema}.{name}" if schema else name
    return spark.catalog.tableExists(full.lower())


def known_rows(spark: SparkSession, name: str) -> int | None:
    """The row count that the catalog has of an analysed table; None if it has none.

    Writes through the catalog make it forget a count, so one that is there holds.
    """
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType in ("VIEW", "TEMPORARY"):
        return None
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    described = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted} AS JSON").first()[0])
    return described.get("statistics", {}).get("num_rows")


def filled_tables(spark: SparkSession, pattern: str, schema: str | None = None) -> DataFrame:
    """(table_name, table_rows) of the non-empty tables matching ``pattern``, largest first.

    Counts come from the catalog where a table was analysed. One job counts the others;
    parquet counts come from file footers.
    """
    names = sorted(t.name for t in spark.catalog.listTables(schema) if re.search(pattern, t.name))
    full = {name: f"{schema}.{name}" if schema else name for name in names}
    known = {name: known_rows(spark, full[name]) for name in names}
    counts = spark.createDataFrame([(n, k) for n, k in known.items() if k is not None], "table_name string, table_rows bigint")
    for name in (n for n in names if known[n] is None):
        count = spark.table(full[name]).agg(F.count("*").alias("table_rows"))
        counts = counts.unionAll(count.select(F.lit(name).alias("table_name"), "table_rows"))
    return counts.where("table_rows > 0").orderBy(F.desc("table_rows"), "table_name")


def drop_if_exists(spark: SparkSession, *names: str) -> None:
    for name in names:
        if spark.catalog.tableExists(name):
            table = spark.catalog.getTable(name)
            kind = "VIEW" if table.isTemporary or table.tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} IF EXISTS identifier(:name)", args={"name": name})


def read_workflows(spark: SparkSession, path: str) -> DataFrame:
    """Workflow descriptions, one JSON object per line."""
    return spark.read.schema(schemas.WORKFLOW).json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job descriptions with their runs, newest first, one JSON object per line."""
    return spark.read.schema(schemas.JOB).json(path)
