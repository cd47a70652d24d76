"""Tables, views, writes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.operators import sets, windows
from fieldloom.sources import sinks, tables
from fieldloom.sources.versions import VersionedTable


def published(spark, **options):
    return VersionedTable(spark, session.new_name("t"), **options)


def versions(spark, table):
    return [t.name for t in spark.catalog.listTables(pattern=f"{table.name}__v*")]


def test_replacement_reads_what_it_replaces(spark, rows):
    table = published(spark)
    assert table.read() is None and not table.exists()
    table.publish(rows("a int, b string", (1, "x"), (2, "y")))
    table.publish(table.read().where("a = 2").withColumn("c", F.lit(True)))
    assert [tuple(r) for r in table.read().collect()] == [(2, "y", True)]
    assert versions(spark, table) == [table.version()]
    table.drop()
    assert not table.exists() and versions(spark, table) == []


def test_broken_publication_keeps_the_table(spark, rows):
    table = published(spark, key="a", buckets=2)
    table.publish(rows("a int", (1,), (2,)))
    before = table.version()
    with pytest.raises(Exception, match="no"):
        table.publish(table.read().select(F.when(F.col("a") == 2, F.raise_error(F.lit("no")).cast("int")).otherwise(0).alias("a")))
    assert table.version() == before and sorted(r.a for r in table.read().collect()) == [1, 2]
    table.publish(table.read().where("a = 2"))
    assert [r.a for r in table.read().collect()] == [2]


def test_publication_that_breaks_before_the_swap_leaves_no_trace(spark, rows, monkeypatch):
    table = published(spark)
    table.publish(rows("a int", (1,)))
    monkeypatch.setattr(VersionedTable, "_point_at", lambda self, version: (_ for _ in ()).throw(OSError("catalog gone")))
    with pytest.raises(OSError):
        table.publish(rows("a int", (2,)))
    monkeypatch.undo()
    assert [r.a for r in table.read().collect()] == [1] and len(versions(spark, table)) == 2
    table.publish(rows("a int", (3,)))
    assert [r.a for r in table.read().collect()] == [3] and len(versions(spark, table)) == 1


def test_appended_rows_keep_the_layout(spark, rows):
    table = published(spark, key="k", buckets=4)
    for part in range(3):
        table.append(spark.range(part * 100, part * 100 + 100).withColumnRenamed("id", "k"))
    assert table.read().count() == 300 and len(table.read().inputFiles()) == 12
    parts = published(spark, partitions=["p"])
    parts.append(rows("a int, p boolean", (1, True), (2, False)))
    parts.append(rows("a int, p boolean", (3, False)))
    assert sorted(r.a for r in parts.read().where("not p").collect()) == [2, 3]


def test_tables_of_a_schema(spark, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS some_schema")
    table = VersionedTable(spark, "some_schema.named", key="a", buckets=2)
    table.publish(rows("a int", (1,)))
    table.publish(rows("a int", (2,)))
    assert [r.a for r in spark.table("some_schema.named").collect()] == [2]
    table.drop()
    assert spark.catalog.listTables("some_schema") == []


def test_hot_key_is_written_by_several_tasks(spark):
    """A third of the rows share a key: their bucket becomes several files."""
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        table = published(spark, key="k", buckets=4)
        table.publish(df)
        assert table.read().count() == 60000 and len(table.read().inputFiles()) > 4
        assert table.read().where("k = -1").select(F.input_file_name()).distinct().count() > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_keyed_layout_sorts_files(spark):
    path = session.new_path(spark, "keyed")
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    got = sinks.write_keyed(df, path, "k")
    assert got.count() == 3000
    unsorted = (
        got.select("k", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"))
        .selectExpr("k < lag(k) over (partition by f order by n) as wrong")
        .where("wrong")
    )
    assert unsorted.count() == 0


def test_append_creates(spark, rows):
    path = session.new_path(spark, "t")
    assert tables.scan_if_exists(spark, path) is None
    sinks.append_or_create(rows("a int", (1,)), path)
    sinks.append_or_create(rows("a int", (2,)), path)
    assert sorted(r.a for r in tables.scan(spark, path).collect()) == [1, 2]


def test_csv_keeps_quotes_and_lines(spark, rows):
    path = session.new_path(spark, "csv")
    df = rows("a string, b string", ('he said "hi", twice', "x"), ("two\nlines", "y"), (None, "z"))
    sinks.write_csv(df, path)
    got = spark.read.schema(df.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_catalog(spark, rows):
    tables.named_view(rows("a int", (1,), (2,)), "part_one")
    tables.named_view(rows("a int", (3,), (4,), (5,)), "part_two")
    tables.named_view(rows("a int"), "part_three")
    assert tables.table_exists(spark, "PART_ONE") and not tables.table_exists(spark, "part_four")
    assert [tuple(r) for r in tables.filled_tables(spark, "^part_").collect()] == [("part_two", 3), ("part_one", 2)]
    assert tables.filled_tables(spark, "^nothing_").collect() == []
    tables.drop_if_exists(spark, "part_one", "part_two", "part_three", "part_four")
    assert not tables.table_exists(spark, "part_one")


def test_sizes_from_the_catalog(spark, rows):
    """An analysed table is not read; one that was written to since, or never analysed, is counted."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS sizes")
    for name, n in (("size_a", 3), ("size_b", 5), ("size_c", 0), ("size_d", 4)):
        spark.range(n).write.saveAsTable(f"sizes.{name}")
    for name in ("size_a", "size_c", "size_d"):
        spark.sql(f"ANALYZE TABLE sizes.{name} COMPUTE STATISTICS")
    spark.range(2).write.mode("append").saveAsTable("sizes.size_d")
    known = {n: tables.known_rows(spark, f"sizes.size_{n}") for n in "abcd"}
    assert known["a"] == 3 and known["b"] is None and known["c"] == 0 and known["d"] in (None, 6)
    found = tables.filled_tables(spark, "^size_", "sizes")
    assert [tuple(r) for r in found.collect()] == [("size_d", 6), ("size_b", 5), ("size_a", 3)]
    shown = found._jdf.queryExecution().executedPlan().toString()
    assert "size_a" not in shown.replace("[size_a", "") and "sizes.size_b" in shown
    assert tables.known_rows(spark, "sizes.no_such") is None
    tables.named_view(rows("a int", (1,)), "size_view")
    assert tables.known_rows(spark, "size_view") is None
    spark.sql("DROP SCHEMA sizes CASCADE")


def test_saved_table(spark, rows):
    rows("a int", (1,)).write.option("path", session.new_path(spark, "saved")).saveAsTable("saved_rows")
    assert tables.table_exists(spark, "Saved_Rows", "DEFAULT")
    assert tables.scan(spark, "saved_rows").count() == 1
    tables.drop_if_exists(spark, "saved_rows")
    assert not tables.table_exists(spark, "saved_rows", "default")


def test_parameters_are_not_spliced(spark, rows):
    tables.named_view(rows("a string", ("x' OR '1'='1",), ("y",)), "quoted")
    got = tables.query(spark, "SELECT * FROM identifier(:t) WHERE a = :v", t="quoted", v="x' OR '1'='1")
    assert got.count() == 1


def test_union_or_empty(spark, rows):
    a, b = rows("x int, y int", (1, 2)), rows("y int, x int", (3, 4))
    assert sorted(map(tuple, sets.union_or_empty(spark, [a, b], a.schema).collect())) == [(1, 2), (4, 3)]
    empty = sets.union_or_empty(spark, [], a.schema)
    assert empty.schema == a.schema and empty.count() == 0


def test_count_difference(rows):
    a, b = rows("x int", (1,), (2,)), rows("x int")
    assert tuple(sets.count_difference(a, b).first()) == (2, 0, 2)
    assert tuple(sets.count_difference(b, a).first()) == (0, 2, 2)


@pytest.mark.parametrize("keep", [1, 7, 1500, 2500, 10_000])
def test_lowest_per_key(spark, keep):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 6 == 0, F.lit("rare")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("d"),
        "id",
    )
    got = sorted(map(tuple, windows.lowest_per_key(df, ["k"], "d", ["id"], keep).collect()), key=str)
    rows = [tuple(r) for r in df.collect()]
    wanted = [r for k in ("hot", "rare", None) for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1])[:keep]]
    assert got == sorted(wanted, key=str)


def test_chunks_are_even_and_stable(spark):
    df = spark.range(30000).select("id", windows.chunk_of(F.col("id"), 3).alias("chunk"))
    sizes = {r.chunk: r["count"] for r in df.groupBy("chunk").count().collect()}
    assert sorted(sizes) == [1, 2, 3] and all(9500 < n < 10500 for n in sizes.values())
    assert df.exceptAll(df.repartition(7)).count() == 0


@pytest.mark.parametrize("tiles", [1, 3, 7, 250])
def test_tiles_are_those_of_a_global_order(spark, tiles):
    """As ``ntile`` over an order in which a third of the rows are equal, without its one task."""
    df = spark.range(0, 200, 1, 5).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("o"), "id")
    numbered = windows.numbered(df.repartition(6), [F.desc("o")], session.stage_table, "n")
    got = numbered.select("o", "n", windows.tile_of(F.col("n"), 200, tiles).alias("tile")).collect()
    assert sorted(r.n for r in got) == list(range(200))
    ordered = [r.o for r in sorted(got, key=lambda r: r.n)]
    assert ordered == sorted(ordered, reverse=True)
    expected = spark.sql(f"SELECT n, ntile({tiles}) OVER (ORDER BY n) AS tile FROM range(200) r(n)")
    assert sorted((r.n, r.tile) for r in got) == sorted(map(tuple, expected.collect()))


def test_numbers_of_no_rows(spark):
    df = spark.range(0).select("id")
    assert windows.numbered(df, [F.col("id")], session.stage_table).collect() == []


def test_equal_rows_are_numbered_by_several_tasks(spark):
    df = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("o"))
    small = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in small}
    written = []

    def write(frame, name):
        for k, v in small.items():
            spark.conf.set(k, v)
        written.append(session.stage_table(frame, name))
        for k, v in before.items():
            spark.conf.set(k, v)
        return written[-1]

    numbers = windows.numbered(df, [F.col("o")], write).agg(F.countDistinct("number"), F.max("number")).first()
    assert tuple(numbers) == (20000, 19999)
    assert written[0].groupBy("_number_part").count().agg(F.max("count")).first()[0] < 6000


def test_shared_dir_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stage_keeps_types(spark, rows):
    df = rows("t timestamp_ntz, a array<string>", (datetime(2024, 1, 1), ["x"]))
    assert session.stage_table(df, "s").schema == df.schema


def test_staging_is_kept_after_an_error(spark, rows):
    with pytest.raises(KeyError), session.Staging(spark, "run") as staging:
        staging.table(rows("a int", (1,)), "t")
        raise KeyError
    assert spark.read.parquet(f"{staging.path}/t").count() == 1
    staging.drop()
    assert tables.scan_if_exists(spark, f"{staging.path}/t") is None
