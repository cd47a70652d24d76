"""Catalog tables that are replaced as a whole, with a layout that joins can use.

Such a table is a view by its name over its current version, a table of its own. A new
version is written beside the old one and becomes current when the view is replaced, in
one step of the catalog; the old version goes last. A run that breaks before that step
leaves the table as it was, and one that breaks after it leaves a version too many, which
the next publication removes.

With a key, versions are bucketed and sorted by it: a join or an aggregation by the key
reads the buckets as they are, without a shuffle on that side. All rows of a bucket are
read by one task, so a key should be one that few rows share (an id, a hash).

One writer at a time. A reader that has planned over a version needs it until it ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from fieldloom.sources.tables import table_exists

BUCKETS = 200


@dataclass(frozen=True)
class VersionedTable:
    """A table by its catalog name (``table`` or ``schema.table``).

    ``partitions`` are columns that become folders; a table has them or a key.
    """

    spark: SparkSession
    name: str
    key: str | None = None
    sort: Sequence[str] = ()
    buckets: int = BUCKETS
    partitions: Sequence[str] = ()

    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    def read(self) -> DataFrame | None:
        """The current version, or None if nothing was ever published."""
        if not self.exists():
            return None
        # another session, as that of a stream's batches, may have added files
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def publish(self, df: DataFrame) -> DataFrame:
        """Make the rows of ``df`` the whole table; ``df`` may read the table itself."""
        version = f"{self.name}__v{uuid.uuid4().hex[:12]}"
        self._writer(df).saveAsTable(version)
        self._point_at(version)
        for old in self._versions():
            if old != version:
                self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(old)}")
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        """Add rows to the current version; the first ones make it."""
        if not self.exists():
            self.publish(df)
            return
        self._writer(df).mode("append").saveAsTable(self.version())

    def version(self) -> str:
        """The name of the table that holds the current version."""
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {_quoted(self.name)} ('fieldloom.version')")
        return shown.first()["value"]

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {_quoted(self.name)}")
        for version in self._versions():
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")

    def _point_at(self, version: str) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(self.name)} TBLPROPERTIES ('fieldloom.version' = '{version}')"
            f" AS SELECT * FROM {_quoted(version)}"
        )

    def _versions(self) -> list[str]:
        schema, _, table = self.name.rpartition(".")
        found = self.spark.catalog.listTables(schema or None, pattern=f"{table}__v*")
        return [f"{schema}.{t.name}" if schema else t.name for t in found if not t.isTemporary]

    def _writer(self, df: DataFrame) -> DataFrameWriter:
        if self.key is None:
            writer = df.write
        else:
            # dealt as the buckets are, so a bucket is one file, or several if it is too large for a task
            writer = df.hint("rebalance", self.buckets, self.key).write.bucketBy(self.buckets, self.key)
            writer = writer.sortBy(self.key, *self.sort)
        if self.partitions:
            writer = writer.partitionBy(*self.partitions)
        return writer.format("parquet").option("compression", "zstd")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))
