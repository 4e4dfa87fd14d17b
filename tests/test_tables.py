import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import merge
from gridlake.plans import gold
from gridlake.sources import tables

DDL = "k string, t int, v int"


def _table(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def test_upsert_is_repeatable(spark):
    target = _table(spark, ("a", 1, 1), ("b", 1, 2), (None, 1, 3))
    source = _table(spark, ("b", 2, 20), ("b", 3, 30), ("c", 2, 4), (None, 2, 5))
    once = merge.upsert(target, source, ("k",), "t")
    assert rows(once) == [(None, 2, 5), ("a", 1, 1), ("b", 3, 30), ("c", 2, 4)]
    assert rows(merge.upsert(once, source, ("k",), "t")) == rows(once)


def test_insert_absent(spark):
    target = _table(spark, ("a", 1, 1))
    source = _table(spark, ("a", 2, 2), ("b", 1, 3), ("b", 2, 4))
    assert rows(merge.insert_absent(target, source, ("k",), "t")) == [("a", 1, 1), ("b", 2, 4)]


def test_table_diff(spark):
    old = _table(spark, ("a", 1, 1), ("b", 1, None), ("c", 1, 1))
    new = _table(spark, ("a", 1, 1), ("b", 1, 2), ("d", 1, 1))
    assert rows(merge.table_diff(old, new, ("k",)), "change_type", "k", "v") == [
        ("delete", "c", 1), ("insert", "d", 1), ("update", "b", 2),
    ]
    assert merge.table_diff(old, old, ("k",)).isEmpty()


def test_upsert_table_touches_only_its_partitions(spark, folder):
    path = folder("upsert")
    first = spark.createDataFrame([("a", 1, 1, 1), ("b", 1, 1, 2)], "k string, t int, v int, month int")
    late = spark.createDataFrame([("b", 2, 9, 2), ("c", 1, 1, 2)], "k string, t int, v int, month int")
    old = spark.createDataFrame([("b", 0, 7, 2)], "k string, t int, v int, month int")

    def files():
        return sorted(f for f in spark.read.parquet(path).inputFiles() if "month=1" in f)

    for batch in (first, late, old, late):
        if batch is late:
            before = files()
        merge.upsert_table(spark, path, batch, ("k",), ("month",), ("t",))
    stored = spark.read.parquet(path)
    assert rows(stored, "k", "t", "v", "month") == [("a", 1, 1, 1), ("b", 2, 9, 2), ("c", 1, 1, 2)]
    assert files() == before


def test_appended_columns_are_united(spark, folder):
    path = folder("evolve")
    tables.append_table(_table(spark, ("a", 1, 1)), path)
    tables.append_table(_table(spark, ("b", 1, 1)).withColumn("w", F.lit(5)), path)
    assert rows(tables.read_table(spark, path, merge=True), "k", "w") == [("a", None), ("b", 5)]
    assert tables.unite(_table(spark), _table(spark).withColumn("w", F.lit(1))).columns == ["k", "t", "v", "w"]


def test_overwrites(spark, folder):
    path = folder("overwrite")
    tables.overwrite_table(_table(spark, ("a", 1, 1), ("b", 2, 1)), path, ("t",))
    tables.overwrite_partitions(_table(spark, ("c", 2, 2)), path, ("t",))
    assert rows(spark.read.parquet(path), "k", "t") == [("a", 1), ("c", 2)]
    counts = tables.checked_write(_table(spark, ("z", 3, 1)), path, ("t",), big=F.count_if(F.col("v") > 5))
    assert counts == {"rows": 1, "big": 0} and spark.read.parquet(path).count() == 1


def test_save_as_table(spark):
    tables.save_as_table(_table(spark, ("a", 1, 1)), "saved_rows")
    tables.save_as_table(_table(spark, ("b", 1, 1)), "saved_rows")
    assert rows(spark.table("saved_rows")) == [("b", 1, 1)]
    spark.sql("DROP TABLE saved_rows")


def test_compaction_keeps_rows_and_merges_files(spark, folder):
    source, target = folder("small"), folder("large")
    df = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    df.repartition(20).write.parquet(source)
    tables.compact_table(spark, source, target, ("k",), "v")
    assert len(spark.read.parquet(target).inputFiles()) < 20
    assert spark.read.parquet(target).exceptAll(df).isEmpty() and spark.read.parquet(target).count() == 2000


def test_empty_table(spark):
    assert schemas.empty_table(spark, schemas.FACT_POWER).schema == schemas.FACT_POWER


@pytest.fixture(scope="module")
def pairs(spark):
    return lambda *types: spark.createDataFrame([(t, "de") for t in types], "production_type string, country string")


def _state(dim):
    return rows(dim, "production_plant_name", "active_flag", F.col("effective_date").cast("string"), F.col("expiry_date").cast("string"))


def test_dimension_history(spark, pairs):
    day1, day2 = utc(2024, 1, 1), utc(2024, 1, 2)
    dim = gold.dim_production_type([pairs("Wind", "Solar", None)], day1)
    changed = gold.dim_production_type([pairs("Wind", "Nuclear")], day2).withColumn(
        "description", F.concat("description", F.lit("!"))
    )
    merged = merge.scd2_merge(dim, changed, day2)
    assert merged.schema.names == dim.schema.names
    assert _state(merged) == [
        ("Nuclear", True, "2024-01-02", None),
        ("Solar", True, "2024-01-01", None),
        ("Wind", False, "2024-01-01", "2024-01-02"),
        ("Wind", True, "2024-01-02", None),
    ]
    assert _state(merge.scd2_merge(merged, changed, utc(2024, 1, 3))) == _state(merged)
    closed = merge.scd2_merge(merged, changed, utc(2024, 1, 3), close_missing=True)
    assert ("Solar", False, "2024-01-01", "2024-01-03") in _state(closed)


def test_family_names_are_unique(spark, pairs):
    dim = gold.dim_production_type([pairs("Wind offshore", "Wind onshore", "Wind")], utc(2024, 1, 1), "family")
    assert dim.count() == 1 and dim.first().production_plant_name == "Wind"


def test_upsert_loses_no_column_and_prefers_what_arrives(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for shuffles in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            path = folder("upserted")
            first = spark.range(300).selectExpr("id AS k", "1 AS t", "id AS v", "concat('x', id) AS extra", "id % 3 AS p")
            merge.upsert_table(spark, path, first, ("k",), ("p",), ("t",))
            # The same rows again by another rule, without one column and with a new one, in another order.
            again = spark.range(300).repartition(5).filter("id % 3 < 2").selectExpr("id AS k", "1 AS t", "id + 1000 AS v", "true AS fresh", "id % 3 AS p")
            merge.upsert_table(spark, path, again, ("k",), ("p",), ("t",))
            stored = spark.read.option("mergeSchema", "true").parquet(path)
            assert stored.count() == 300
            assert stored.filter("extra <> concat('x', k) or extra is null").isEmpty()
            assert stored.filter("p < 2 and (v <> k + 1000 or not fresh)").isEmpty()
            assert stored.filter("p = 2 and (v <> k or fresh)").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_compaction_keeps_folders_and_sizes_files(spark, folder):
    source, target = folder("scattered"), folder("compacted")
    rows_in = spark.range(40_000).selectExpr("id % 4 AS p", "id AS k", "md5(cast(id AS string)) AS v")
    rows_in.repartition(32).write.partitionBy("p").parquet(source)
    files = tables.compact_table(spark, source, target, ("k",), "v", partition_by=("p",), file_bytes=300_000)
    written = spark.read.parquet(target).inputFiles()
    assert files == -(-tables.folder_bytes(spark, source) // 300_000) and files <= len(written) <= files + 4 < 32
    assert all("/p=" in f for f in written) and spark.read.parquet(target).count() == 40_000


def test_compaction_sorts_no_more_than_a_task_holds(spark, folder):
    """Rows that take a few bytes on disk and 1.2 GB in memory: not one task for all of them."""
    source, target = folder("packed"), folder("compacted")
    spark.range(0, 24_000, 1, 8).selectExpr("id AS k", "repeat('x', 50000) AS v").write.parquet(source)
    assert tables.folder_bytes(spark, source) < 10 << 20
    assert tables.compact_table(spark, source, target, ("k",), "k") == 2
    spans = rows(spark.read.parquet(target).groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n")), "a", "b", "n")
    assert len(spans) == 2 and all(b - a + 1 == n < 18_000 for a, b, n in spans) and sum(n for _, _, n in spans) == 24_000


def test_compaction_with_a_large_folder_sorts_no_more_than_a_task_holds(spark, folder):
    """Most rows lie in one folder and all have one key: the folder is still cut, and each task holds about its share."""
    source, target = folder("packed"), folder("compacted")
    df = spark.range(0, 24_000, 1, 8).selectExpr("if(id % 8 = 0, 'a', 'b') AS p", "'hot' AS k", "id AS v", "repeat('x', 50000) AS t")
    df.write.partitionBy("p").parquet(source)
    assert tables.folder_bytes(spark, source) < 10 << 20
    assert tables.compact_table(spark, source, target, ("k",), "v", partition_by=("p",)) == 2
    stored = spark.read.parquet(target)
    task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
    assert all(n < 18_000 for (n,) in rows(stored.groupBy(task).count(), "count"))
    assert rows(stored.groupBy("p").agg(F.count_distinct("v").alias("n")), "p", "n") == [("a", 3_000), ("b", 21_000)]


@pytest.mark.parametrize("by", [(), ("p",)])
def test_compaction_in_small_sorts_keeps_all_rows(spark, folder, by):
    """Null and repeated keys, null folders, and nested columns come through, in order."""
    source, target = folder("scattered"), folder("compacted")
    df = spark.range(6000).selectExpr(
        "nullif(id % 3, 2) AS p", "nullif(id % 50, 7) AS k", "cast(nullif(id % 2000, 9) AS string) AS v",
        "CASE WHEN id % 5 > 0 THEN array(struct(id AS a, cast(id AS string) AS b), NULL) END AS l", "map('m', nullif(id % 2, 1)) AS m",
        "CAST(id AS decimal(30,2)) AS `d.e`",
    )
    df.repartition(9).write.partitionBy(*by).parquet(source)
    files = tables.compact_table(spark, source, target, ("k",), "v", partition_by=by, sort_bytes=200_000)
    assert files == -(-tables.sort_memory(spark.read.parquet(source)) // 200_000) and files > 5
    stored = spark.read.parquet(target)
    texts = [F.to_json(F.struct(F.col("p").cast("long"), "k", "v", "l", "m", "`d.e`")).alias("t")]
    before, after = df.select(*texts), stored.select(*texts)
    assert stored.count() == 6000 and before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    kept = [r.k for r in spark.read.parquet(stored.inputFiles()[0]).select("k").collect()]
    assert kept == sorted(kept, key=lambda k: (k is not None, k))


def test_sort_memory_counts_unpacked_values(spark):
    def of(*expressions, n=1000):
        return tables.sort_memory(spark.range(0, n, 1, 4).selectExpr(*expressions))

    assert of("id", n=0) == 0
    assert of("id") == 1000 * (tables.SORT_ENTRY + 16)
    assert of("id", "CAST(NULL AS string) AS s") == of("id", "1 AS s") == 1000 * (tables.SORT_ENTRY + 24)
    assert of("id", "repeat('ä', 500) AS s") >= 1000 * 1000
    assert of("array_repeat(repeat('x', 100), 10) AS l") >= 1000 * 1000 > of("CAST(NULL AS array<string>) AS l")
    assert of("array_repeat(id, 20) AS l") == 1000 * (tables.SORT_ENTRY + 16 + 16 + 160)
    assert of("map(repeat('x', 500), repeat('y', 500)) AS m") >= 1000 * 1000
    assert of("struct(array(struct(repeat('x', 1000) AS a)) AS b) AS s") >= 1000 * 1000
    assert of("parse_json(concat('{\"a\":\"', repeat('x', 1000), '\"}')) AS j") >= 1000 * 1000


def test_many_folders_make_a_flat_condition(spark):
    from gridlake.operators.merge import _one_of

    folders = [{"y": y, "d": d} for y in range(150) for d in (*range(20), None)]
    df = spark.createDataFrame([(3, 5), (3, 77), (3, None), (200, 1)], "y int, d int")
    assert df.filter(_one_of(folders, ("y", "d"))).count() == 2
