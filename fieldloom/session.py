"""Session settings and the shared folder that stage tables go to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str = "fieldloom", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the plans are written for.

    All timestamps are zone-less UTC, so the session zone is pinned to UTC; the
    conversions in ``functions.zones`` do not depend on it. ``shuffle_bytes``, the
    size of the largest shuffle to expect, sets how many partitions shuffles start
    with; the adaptive planner joins small ones but cannot make more.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot join key even where the split costs one more exchange
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if shuffle_bytes is not None:
        partitions = max(200, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may do without the setting; its warehouse folder takes its place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark)}/fieldloom/{uuid.uuid4().hex}/{name}"


def new_name(prefix: str) -> str:
    """A catalog name that no table has yet."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Used where a result is read more than once. Unlike a cached frame it outlives
    lost executors, and its lineage starts at the files.
    """
    return _write_stage(df, new_path(df.sparkSession, name))


def _write_stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """Stage tables of one run, dropped together when its results have been written.

    As a context manager it drops them at the end, but keeps them after an error:
    they may hold the only complete copy of what was being written.
    """

    def __init__(self, spark: SparkSession, run: str):
        self.spark = spark
        self.path = new_path(spark, run)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        return _write_stage(df, f"{self.path}/{name}")

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, error: type | None, *_: object) -> None:
        if error is None:
            self.drop()
