"""Pruning, options and metadata of tables."""

import os

import pytest

from granary.functions.types import PromotionError, promote
from granary.operators.compare import compare_roundtrip
from granary.session import scratch_path
from granary.sources.metadata import count_exact, row_group_stats
from granary.sources.reader import SchemaMismatch, read_table
from granary.sources.writer import write_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(read_table(spark, f"{SF}/orders.parquet").where("o_orderkey > 1400").select("o_totalprice"))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,1400)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def scanned_rows(df):
    """Rows that the file scans of a frame gave, by Spark's own metric, when it is run."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()
        leaves = plan.collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_row_groups_are_skipped(spark):
    """Sorted groups of 100 rows in one file: only those that may hold a match are read."""
    path = scratch_path(spark, "skip")
    write_table(read_table(spark, f"{SF}/orders.parquet").coalesce(1).sortWithinPartitions("o_orderkey"), path, row_group_size=100)
    assert count_exact(spark, path) == 1500
    groups = row_group_stats(spark, path).where("column_name = 'o_orderkey'").collect()
    assert len({g.file for g in groups}) == 1 and len(groups) == 15
    assert all(int(g.min_value) <= int(g.max_value) and g.row_count == 100 and g.row_start == 100 * g.row_group for g in groups)
    for where, most in (("o_orderkey > 1450", 100), ("o_orderkey = 777", 100), ("o_orderkey IN (1, 1499)", 200), ("o_orderkey < 250", 300), ("o_orderkey < 0", 0), ("o_totalprice IS NULL", 0)):
        df = read_table(spark, path).where(where)
        assert scanned_rows(df) <= most < 1500, where
        assert df.count() == read_table(spark, f"{SF}/orders.parquet").where(where).count()
    assert scanned_rows(read_table(spark, path).where("o_orderkey % 2 = 0")) == 1500


def test_manifest_is_read_instead_of_footers(spark, monkeypatch):
    from granary.sources import metadata

    path = scratch_path(spark, "manifest")
    write_table(spark.range(1000).repartition(3), path, inline_footer=False)
    monkeypatch.setattr(metadata, "_heads", None)
    assert read_table(spark, path).count() == 1000 and count_exact(spark, path) == 1000
    spark.range(5).write.mode("append").parquet(path)  # the manifest doesn't name this file
    with pytest.raises(TypeError):
        read_table(spark, path)


def test_many_files_give_one_head_a_schema(spark, monkeypatch):
    from granary.sources import metadata

    path = scratch_path(spark, "many")
    write_table(spark.range(100).selectExpr("cast(id as int) AS x"), f"{path}/a", partitions=5, preserve_order=False)
    write_table(spark.range(100).selectExpr("id AS x"), f"{path}/b", partitions=5, preserve_order=False)
    monkeypatch.setattr(metadata, "DRIVER_FILES", 3)
    heads = metadata.schema_heads(spark, [path])
    assert [(h["columns"], int(h["row_count"])) for h in heads] == [([["x", "int"]], 100), ([["x", "bigint"]], 100)]
    df = read_table(spark, path)
    assert df.schema["x"].dataType.simpleString() == "bigint" and df.count() == 200


def test_out_of_range_projection_is_an_error(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_table(spark, f"{SF}/nation.parquet").select("n_nationkey", "no_such_column").collect()


def test_asof_join_by_brute_force(spark):
    import random

    from granary.operators.joins import asof_join

    r = random.Random(3)
    some = lambda most: r.choice([None, *range(most)])
    left = [(i, some(4), some(60)) for i in range(300)]
    right = sorted({(some(4), some(60)): some(9) for _ in range(90)}.items(), key=str)
    right = [(k, t, v) for (k, t), v in right]
    want = {}
    for i, k, t in left:
        able = [(s, v) for key, s, v in right if None not in (k, t, key, s) and key == k and s <= t]
        want[i] = max(able, key=lambda x: x[0])[1] if able else None
    a, b = spark.createDataFrame(left, "id long, k long, t long"), spark.createDataFrame(right, "k long, t long, v long")
    for slices in (1, 2, 16):
        assert {x.id: x.last for x in asof_join(a, b, "k", "t", "t", "v", "last", slices).collect()} == want
    assert asof_join(a, b.where("1 = 0"), "k", "t", "t", "v", "last").where("last IS NOT NULL").count() == 0


def test_symbols_round_trip_on_odd_texts(spark):
    from granary.operators import symbols

    texts = [None, "", "a", "aaaaaaaaaaaaaaaaa", "é☃é☃é☃", "\x00\xff\x00", "the then these there", "x" * 1000, "\n\t.*+?()"]
    df = spark.createDataFrame(list(enumerate(texts)), "pos int, val string")
    for bits in (8, 12):
        for sample in (df, df.where("1 = 0")):
            table = symbols.train_symbols(sample, bits=bits)
            assert len(table) <= symbols.SIZES[bits]
            back = symbols.symbol_decode(symbols.symbol_encode(df, table, bits=bits), table, bits=bits)
            assert {r.pos: r.val for r in back.collect()} == dict(enumerate(texts))


def test_progress_of_a_scan(spark):
    import threading
    import time

    from pyspark.sql import functions as F

    from granary.sources.progress import scan_progress

    @F.udf("long")
    def slow(x):
        time.sleep(0.01)
        return x

    assert scan_progress(spark) == 100.0
    running = threading.Thread(target=lambda: spark.range(0, 1600, 1, 32).select(slow("id")).agg(F.sum("slow(id)")).collect())
    running.start()
    seen = []
    while running.is_alive():
        seen.append(scan_progress(spark))
        time.sleep(0.02)
    running.join()
    assert all(0 <= x <= 100 for x in seen) and any(0 < x < 100 for x in seen)


def test_settings_of_threads_are_put_back(spark):
    from granary.session import setting

    name = "spark.sql.sources.default"
    before = spark.conf.get(name)
    with setting(spark, name, "orc"), setting(spark, name, "orc"):
        assert spark.conf.get(name) == "orc"
    assert spark.conf.get(name) == before


def test_discarded_tables_are_gone(spark):
    from granary.session import discard, materialize

    df = materialize(spark.range(9), "gone")
    [*files] = df.inputFiles()
    path = files[0].removeprefix("file://")
    assert os.path.exists(path)
    discard(df)
    assert not os.path.exists(path)


def test_promotion_lattice():
    assert promote("tinyint", "bigint") == "bigint"
    assert promote("utinyint", "tinyint") == "smallint"
    assert promote("uint", "int") == "bigint"
    assert promote("usmallint", "uint") == "uint"
    assert promote("float", "double") == "double"
    for a, b in [("ubigint", "bigint"), ("int", "float"), ("date", "timestamp"), ("boolean", "int")]:
        with pytest.raises(PromotionError):
            promote(a, b)


@pytest.mark.parametrize("options", [{"row_group_size": 0}, {"row_group_size": "9"}, {"nulls": "maybe"}, {"unknown": 1}, {"row_groups_per_file": [1, 2]}, {"mode": None}])
def test_write_options(spark, options):
    with pytest.raises(ValueError):
        write_table(spark.range(1), scratch_path(spark, "bad"), **options)


def test_read_options(spark):
    for options in ({"unknown": 1}, {"union_by_name": None}, {"explicit_cardinality": -1}):
        with pytest.raises(ValueError):
            read_table(spark, f"{SF}/nation.parquet", **options)
    assert read_table(spark, f"{SF}/nation.parquet", FILE_ROW_NUMBER=True).columns[-1] == "file_row_number"


def test_strict_schema_names_the_file(spark):
    path = scratch_path(spark, "strict")
    write_table(spark.range(2).selectExpr("id", "id AS a"), f"{path}/a")
    write_table(spark.range(2), f"{path}/b")
    with pytest.raises(SchemaMismatch, match="/b/"):
        read_table(spark, path)


def test_compare_tells_changed_and_dropped_rows(spark):
    df = spark.range(1, 101).selectExpr("id", "if(id % 10 = 0, null, id) AS col")
    assert compare_roundtrip(df, df).count() == 0
    assert [r.orig_id for r in compare_roundtrip(df, df.selectExpr("id", "if(id = 7, 8, col) AS col")).collect()] == [7]
    assert compare_roundtrip(df, df.where("id < 100")).count() == 1


def test_entry_without_the_optional_part(spark, tmp_path):
    """The registry imports and the other queries stay when the optional subpackage is gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("granary", "__spark_entry__.py"):
        target = tmp_path / name
        if os.path.isdir(f"{root}/{name}"):
            shutil.copytree(f"{root}/{name}", target, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(f"{root}/{name}", target)
    out = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    count, there = out.stdout.split()
    assert int(count) > 100 and there == "False"
