"""Queries on scans, sinks and several files."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.types import PromotionError
from granary.operators.compare import compare_roundtrip
from granary.plans.tables import query, rewritten, table
from granary.session import scratch_path
from granary.sources.metadata import count_exact, estimate_cardinality, file_heads, partition_stats, row_group_stats, table_stats
from granary.sources.reader import SchemaMismatch, bound_options, read_table
from granary.sources.reader import file_row_number as row_number_column
from granary.sources.writer import append_from, write_table

Q1_SQL = """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 4) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus"""


def pricing_summary(lineitem):
    price, less = F.col("l_extendedprice"), 1 - F.col("l_discount")
    return (
        lineitem.where("l_shipdate <= date'1998-09-02'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum(price), 2).alias("sum_base_price"),
            F.round(F.sum(price * less), 2).alias("sum_disc_price"),
            F.round(F.sum(price * less * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
            F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
            F.round(F.avg("l_discount"), 4).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
    )


@query("q1_pricing_summary", Q1_SQL)
def q1_pricing_summary(spark, d):
    return pricing_summary(table(spark, d, "lineitem"))


@query("q1_written_and_read", Q1_SQL)
def q1_written_and_read(spark, d):
    return pricing_summary(rewritten(spark, table(spark, d, "lineitem"), "q1", row_group_size=16_384))


query("scan_all", "SELECT * FROM nation")(lambda spark, d: table(spark, d, "nation"))
@query("scan_list", "SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def scan_list(spark, d):
    path = scratch_path(spark, "list")
    write_table(table(spark, d, "nation").selectExpr("n_nationkey AS k", "n_name AS name"), f"{path}/a")
    write_table(table(spark, d, "region").selectExpr("r_regionkey AS k", "r_name AS name"), f"{path}/b")
    return read_table(spark, [f"{path}/a", f"{path}/b"])


query("scan_project", "SELECT o_orderkey, o_totalprice FROM orders")(lambda spark, d: table(spark, d, "orders").select("o_orderkey", "o_totalprice"))

FILTERS = {
    "gt": "o_totalprice > 300000",
    "ge": "o_orderkey >= 500",
    "lt": "o_totalprice < 5000",
    "le": "o_orderkey <= 100",
    "eq": "o_custkey = 7",
    "ne": "o_orderstatus <> 'F'",
    "in": "o_orderpriority IN ('1-URGENT', '5-LOW')",
    "between": "o_orderkey BETWEEN 100 AND 200",
    "isnotnull": "o_custkey IS NOT NULL",
    "isnull": "o_custkey IS NULL",
    "like": "o_orderpriority LIKE '%-H%'",
    "or": "o_orderkey < 10 OR o_totalprice > 400000",
    "expr": "o_orderkey % 7 = 3 AND o_totalprice * 2 > 100000",
    "date": "o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'",
}
for _name, _where in FILTERS.items():
    query(f"filter_{_name}", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {_where}")(
        lambda spark, d, where=_where: table(spark, d, "orders").where(where.replace("TIMESTAMP", "TIMESTAMP_NTZ")).select("o_orderkey", "o_custkey", "o_totalprice")
    )


def _sorted_orders(spark, d, **options):
    """Files of ranges of the key, each sorted, in path order."""
    df = table(spark, d, "orders").repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
    return rewritten(spark, df, "orders", **options)


def _one_file(spark, d):
    """A sorted excerpt that one file is meant to hold."""
    return table(spark, d, "orders").where("o_orderkey < 5000").coalesce(1).sortWithinPartitions("o_orderkey")


@query("filter_row_group_skipping", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 1400")
def filter_row_group_skipping(spark, d):
    return _sorted_orders(spark, d, row_group_size=512).where("o_orderkey > 1400").select("o_orderkey", "o_totalprice")


@query("filter_only_columns", "SELECT o_totalprice FROM orders WHERE o_custkey < 100")
def filter_only_columns(spark, d):
    return table(spark, d, "orders").where("o_custkey < 100").select("o_totalprice")


NUMBERED = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS file_row_number FROM orders WHERE o_orderkey < 5000"


@query("file_row_number", NUMBERED)
def file_row_number(spark, d):
    return rewritten(spark, _one_file(spark, d), "numbered", read={"file_row_number": True}).select("o_orderkey", "file_row_number")


@query("file_row_number_filter", f"SELECT * FROM ({NUMBERED}) WHERE file_row_number BETWEEN 100 AND 299")
def file_row_number_filter(spark, d):
    return file_row_number(spark, d).where("file_row_number BETWEEN 100 AND 299")


@query("file_row_number_kept_by_filter", f"SELECT * FROM ({NUMBERED}) WHERE o_orderkey % 3 = 0")
def file_row_number_kept_by_filter(spark, d):
    return file_row_number(spark, d).where("o_orderkey % 3 = 0")


@query("virtual_row_number", NUMBERED)
def virtual_row_number(spark, d):
    """Selected without the option."""
    return rewritten(spark, _one_file(spark, d), "virtual").select("o_orderkey", row_number_column())


@query("virtual_row_number_sql", f"SELECT o_orderkey, file_row_number FROM ({NUMBERED}) WHERE file_row_number % 10 = 0")
def virtual_row_number_sql(spark, d):
    path = scratch_path(spark, "virtual")
    write_table(_one_file(spark, d), path)
    return spark.sql(f"SELECT o_orderkey, _metadata.row_index AS file_row_number FROM parquet.`{path}` WHERE _metadata.row_index % 10 = 0")


@query("table_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS table_row_number FROM orders")
def table_row_number(spark, d):
    return _sorted_orders(spark, d, read={"table_row_number": True}).select("o_orderkey", "table_row_number")


@query("row_id", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 400 AS file_index, (row_number() OVER (ORDER BY o_orderkey) - 1) % 400 AS file_row_number FROM orders WHERE o_orderkey < 5000")
def row_id(spark, d):
    read = {"file_index": True, "file_row_number": True}
    return rewritten(spark, _one_file(spark, d), "rowid", row_group_size=400, row_groups_per_file=1, read=read).select("o_orderkey", "file_index", "file_row_number")


@query("row_id_of_equal_names", "SELECT 0 AS file_index, n_nationkey AS id FROM nation UNION ALL SELECT 1, n_nationkey FROM nation WHERE n_regionkey = 1")
def row_id_of_equal_names(spark, d):
    """Files of one name in two folders, copied there by the file system."""
    path = scratch_path(spark, "names")
    nation = table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey")
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    for name, df in (("a", nation), ("b", nation.where("n_regionkey = 1"))):
        write_table(df.select("id").coalesce(1), f"{path}/{name}-written")
        [file] = spark.read.parquet(f"{path}/{name}-written").inputFiles()
        system = hadoop.Path(path).getFileSystem(conf)
        system.mkdirs(hadoop.Path(f"{path}/{name}"))
        system.rename(hadoop.Path(file), hadoop.Path(f"{path}/{name}/same.parquet"))
    return read_table(spark, [f"{path}/a", f"{path}/b"], file_index=True).select(F.col("file_index").cast("int").alias("file_index"), "id")


query("explicit_cardinality", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")(
    lambda spark, d: table(spark, d, "nation").join(table(spark, d, "region", explicit_cardinality=5), F.expr("n_regionkey = r_regionkey")).select("n_name", "r_name")
)
query("count_star", "SELECT count(*) AS n FROM lineitem")(lambda spark, d: table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n")))
query("count_exact", "SELECT count(*) AS n FROM lineitem")(lambda spark, d: spark.createDataFrame([(count_exact(spark, f"{d}/lineitem.parquet"),)], "n long"))
query("empty_projection_count", "SELECT count(*) AS n FROM orders WHERE o_orderkey > 50")(lambda spark, d: table(spark, d, "orders").where("o_orderkey > 50").select().agg(F.count(F.lit(1)).alias("n")))
query("scan_literals_only", "SELECT 1 AS one FROM supplier")(lambda spark, d: table(spark, d, "supplier").select(F.lit(1).alias("one")))
query("cardinality_estimate", "SELECT count(*) AS one_file, greatest(count(*), 42) * 2 AS two_files, 17::BIGINT AS explicit FROM nation")(
    lambda spark, d: spark.createDataFrame([(estimate_cardinality(spark, f"{d}/nation.parquet"), _twice(spark, d), estimate_cardinality(spark, f"{d}/nation.parquet", explicit=17))], "one_file long, two_files long, explicit long")
)


def _twice(spark, d):
    path = scratch_path(spark, "nation2")
    write_table(table(spark, d, "nation"), f"{path}/a")
    write_table(table(spark, d, "nation"), f"{path}/b")
    return estimate_cardinality(spark, path)


@query("min_max_stats", "SELECT 'o_orderkey' AS column_name, min(o_orderkey)::VARCHAR AS min_value, max(o_orderkey)::VARCHAR AS max_value, count(*)::BIGINT AS row_count FROM orders UNION ALL SELECT 'o_orderstatus', min(o_orderstatus), max(o_orderstatus), count(*) FROM orders")
def min_max_stats(spark, d):
    return table_stats(spark, f"{d}/orders.parquet", {"o_orderkey": "bigint", "o_orderstatus": "string"}).select("column_name", "min_value", "max_value", "row_count")


@query("row_group_min_max", "SELECT rn // 500 AS row_group, min(o_orderkey)::VARCHAR AS min_value, max(o_orderkey)::VARCHAR AS max_value, count(*) AS row_count FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders WHERE o_orderkey < 5000) GROUP BY 1")
def row_group_min_max(spark, d):
    path = scratch_path(spark, "groups")
    write_table(_one_file(spark, d), path, row_group_size=500)
    return row_group_stats(spark, path).where("column_name = 'o_orderkey'").select("row_group", "min_value", "max_value", "row_count")


@query("partition_row_counts", "SELECT count(*) AS row_count FROM orders")
def partition_row_counts(spark, d):
    path = scratch_path(spark, "parts")
    write_table(table(spark, d, "orders"), path, row_group_size=1000, partitions=4)
    return partition_stats(spark, path).agg(F.sum("row_count").cast("bigint").alias("row_count"))


@query("row_group_offsets", "SELECT rn // 300 AS row_group, min(rn) AS row_start, count(*) AS row_count, min(o_orderkey) AS first_key FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders WHERE o_orderkey < 5000) GROUP BY 1")
def row_group_offsets(spark, d):
    """Each group's first row by the footers, and the key that stands there."""
    path = scratch_path(spark, "offsets")
    write_table(_one_file(spark, d), path, row_group_size=300)
    rows = read_table(spark, path, file_row_number=True).select(F.col("o_orderkey").alias("first_key"), F.col("file_row_number").alias("row_start"))
    return partition_stats(spark, path).select("row_group", "row_start", "row_count").join(rows, "row_start").select("row_group", "row_start", "row_count", "first_key")


@query("rotate_files", "SELECT f AS file_index, least(3000, 10000 - f * 3000) AS n FROM (SELECT unnest(generate_series(0, 3)) AS f)")
def rotate_files(spark, d):
    df = rewritten(spark, spark.range(10_000).coalesce(1), "rotate", row_group_size=1000, row_groups_per_file=3, read={"file_index": True})
    return df.groupBy("file_index").agg(F.count(F.lit(1)).alias("n"))


@query("row_group_split", "SELECT rn // 1024 AS row_group, count(*) AS n, min(o_orderkey)::VARCHAR AS lo, max(o_orderkey)::VARCHAR AS hi FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders WHERE o_orderkey < 5000) GROUP BY 1")
def row_group_split(spark, d):
    """The groups that the file's footer names."""
    path = scratch_path(spark, "split")
    write_table(_one_file(spark, d), path, row_group_size=1024)
    return row_group_stats(spark, path).where("column_name = 'o_orderkey'").selectExpr("row_group", "row_count AS n", "min_value AS lo", "max_value AS hi")


@query("ordered_write", "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS table_row_number FROM events")
def ordered_write(spark, d):
    df = table(spark, d, "events").select("event_id").repartitionByRange(6, "event_id").sortWithinPartitions("event_id")
    return rewritten(spark, df, "ordered", preserve_order=True, partitions=3, read={"table_row_number": True})


@query("append_write", "SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region")
def append_write(spark, d):
    """Rows appended to a table that is there already."""
    path = scratch_path(spark, "append")
    write_table(table(spark, d, "nation").selectExpr("n_nationkey AS k"), path)
    write_table(table(spark, d, "region").selectExpr("r_regionkey AS k"), path, mode="append")
    return read_table(spark, path)


@query("append_from_files", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey + 100, n_name FROM nation")
def append_from_files(spark, d):
    """A table loaded from other tables' files."""
    path, other = scratch_path(spark, "into"), scratch_path(spark, "from")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    write_table(nation, path)
    write_table(nation.selectExpr("n_nationkey + 100 AS n_nationkey", "n_name"), other)
    append_from(spark, path, other)
    return read_table(spark, path)


@query("bound_options", "SELECT 'file_row_number' AS name, 'true' AS value UNION ALL SELECT 'explicit_cardinality', '7' UNION ALL SELECT 'union_by_name', 'false' UNION ALL SELECT 'filename', 'false' UNION ALL SELECT 'file_index', 'false' UNION ALL SELECT 'table_row_number', 'false' UNION ALL SELECT 'widen', 'true'")
def bound_options_of_a_scan(spark, d):
    bound = bound_options(FILE_ROW_NUMBER=True, explicit_cardinality=7)
    return spark.createDataFrame([(k, str(v).lower()) for k, v in bound.items()], "name string, value string")


@query("unordered_write", "SELECT event_id, value FROM events")
def unordered_write(spark, d):
    return rewritten(spark, table(spark, d, "events").select("event_id", "value"), "unordered", preserve_order=False, partitions=4)


@query("combine_remainders", "SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events")
def combine_remainders(spark, d):
    df = rewritten(spark, table(spark, d, "events").repartition(7), "combine", row_group_size=999, partitions=2)
    return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids"))


@query("sidecar_manifest", "SELECT count(*) AS n FROM orders")
def sidecar_manifest(spark, d):
    path = scratch_path(spark, "manifest")
    write_table(table(spark, d, "orders"), path, inline_footer=False, partitions=3, preserve_order=False)
    assert len(file_heads(spark, [path])) == 3  # by the manifest
    return spark.read.json(f"{path}/_manifest").agg(F.sum("row_count").cast("bigint").alias("n"))


# Round trips: what was written, read back; 1024 rows of each type.
WIDE = "469231731687303715884105728"
ROUNDTRIPS = {
    "boolean": ("id % 2 = 0", "id % 2 = 0"),
    "tinyint": ("cast(id % 256 - 128 as tinyint)", "(id % 256 - 128)::TINYINT"),
    "smallint": ("cast(id % 65536 - 32768 as smallint)", "(id % 65536 - 32768)::SMALLINT"),
    "int": ("cast(id as int)", "id::INTEGER"),
    "bigint": ("id * 10", "id * 10"),
    "ubigint": ("cast(id * 10 as decimal(20,0))", "(id * 10)::DECIMAL(20,0)"),
    "hugeint": (f"cast(cast(id as decimal(10,0)) * cast(-{WIDE} as decimal(27,0)) as string)", f"(id::HUGEINT * -{WIDE}::HUGEINT)::VARCHAR"),
    "uhugeint": (f"cast(cast(id as decimal(10,0)) * cast({WIDE} as decimal(27,0)) as string)", f"(id::HUGEINT * {WIDE}::HUGEINT)::VARCHAR"),
    "float": ("cast(cast(id as float) / 100 as float)", "(id::FLOAT / 100)::FLOAT"),
    "double": ("id / 1000D", "id / 1000::DOUBLE"),
    "decimal": ("cast(id / 10.0 as decimal(12,3))", "(id::DECIMAL(12,3) / 10)::DECIMAL(12,3)"),
    "decimal38": ("cast(concat('9', lpad(id, 35, '7'), '.25') as decimal(38,2))", "('9' || lpad(id::VARCHAR, 35, '7') || '.25')::DECIMAL(38,2)"),
    "varchar": ("concat('Value ', id)", "'Value ' || id"),
    "date": ("date_add(date'1992-03-22', cast(id as int))", "DATE '1992-03-22' + id::INTEGER"),
    "timestamp": ("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)", "TIMESTAMP '2025-01-01 00:00:00' + to_seconds(id)"),
    "timestamp_s": ("date_trunc('second', timestamp_ntz'2025-01-01 00:00:00') + make_dt_interval(0, 0, 0, id)", "TIMESTAMP '2025-01-01 00:00:00' + to_seconds(id)"),
    "timestamp_ms": ("timestamp_ntz'2025-01-01 00:00:00.123' + make_dt_interval(0, 0, 0, id)", "TIMESTAMP '2025-01-01 00:00:00.123' + to_seconds(id)"),
    "timestamp_us": ("timestamp_ntz'2025-01-01 00:00:00.123456' + make_dt_interval(0, 0, 0, id)", "TIMESTAMP '2025-01-01 00:00:00.123456' + to_seconds(id)"),
    "blob": ("cast(md5(cast(id as string)) as binary)", "encode(md5(id::VARCHAR))"),
    "nulls": ("if(id % 5 = 0, null, id)", "CASE WHEN id % 5 = 0 THEN NULL ELSE id END"),
    "array": ("array(id, if(id % 3 = 0, null, id + 1))", "[id, CASE WHEN id % 3 = 0 THEN NULL ELSE id + 1 END]"),
    "empty_array": ("if(id % 2 = 0, array(), if(id % 3 = 0, null, array(id)))", "CASE WHEN id % 2 = 0 THEN [] WHEN id % 3 = 0 THEN NULL ELSE [id] END"),
}


def fixture(spark, expression, rows=1024):
    return spark.range(1, rows + 1).selectExpr("id", f"{expression} AS col")


for _name, (_spark, _duck) in ROUNDTRIPS.items():
    query(f"roundtrip_{_name}", f"SELECT id, {_duck} AS col FROM (SELECT unnest(generate_series(1, 1024)) AS id)")(
        lambda spark, d, e=_spark, n=_name: rewritten(spark, fixture(spark, e), f"rt-{n}", partitions=2, row_group_size=1024)
    )


@query("roundtrip_nested", "SELECT id, [id, id * 2] AS xs, id::VARCHAR AS name FROM (SELECT unnest(generate_series(1, 100)) AS id)")
def roundtrip_nested(spark, d):
    df = spark.range(1, 101).selectExpr("id", "array(id, id * 2) AS xs", "named_struct('name', cast(id AS string)) AS s")
    return rewritten(spark, df, "nested").selectExpr("id", "xs", "s.name AS name")


@query("compare_roundtrip_equal", "SELECT 0::BIGINT AS n")
def compare_roundtrip_equal(spark, d):
    df = fixture(spark, "concat('Value ', id)")
    return compare_roundtrip(df, rewritten(spark, df, "cmp")).agg(F.count(F.lit(1)).alias("n"))


@query("compare_roundtrip_diff", "SELECT row_number() OVER (ORDER BY o_orderkey) AS row_pos, o_orderkey AS orig_id, o_orderkey AS rt_id, o_custkey AS orig_col, o_custkey + 1 AS rt_col FROM orders QUALIFY o_orderkey % 1000 = 0")
def compare_roundtrip_diff(spark, d):
    df = table(spark, d, "orders").selectExpr("o_orderkey AS id", "o_custkey AS col")
    return compare_roundtrip(df, rewritten(spark, df.withColumn("col", F.expr("if(id % 1000 = 0, col + 1, col)")), "cmp"))


# Several files.
@query("union_by_name", "SELECT n_nationkey AS id, n_name AS name, NULL::INTEGER AS region FROM nation UNION ALL SELECT n_nationkey, NULL, n_regionkey FROM nation")
def union_by_name(spark, d):
    path, nation = scratch_path(spark, "byname"), table(spark, d, "nation")
    write_table(nation.selectExpr("n_nationkey AS id", "n_name AS name"), f"{path}/a")
    write_table(nation.selectExpr("n_nationkey AS id", "n_regionkey AS region"), f"{path}/b")
    return read_table(spark, path, union_by_name=True).select("id", "name", "region")


@query("multi_file_reordered_columns", "SELECT n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def multi_file_reordered_columns(spark, d):
    path, nation = scratch_path(spark, "reordered"), table(spark, d, "nation")
    write_table(nation.selectExpr("n_nationkey AS id", "n_name AS name"), f"{path}/a")
    write_table(nation.selectExpr("n_name AS name", "n_nationkey AS id"), f"{path}/b")
    return read_table(spark, path)


@query("glob_scan", "SELECT n_nationkey AS id FROM nation UNION ALL SELECT n_nationkey FROM nation")
def glob_scan(spark, d):
    path, nation = scratch_path(spark, "glob"), table(spark, d, "nation").selectExpr("n_nationkey AS id")
    for part in ("x1", "x2", "y"):
        write_table(nation, f"{path}/{part}")
    return read_table(spark, f"{path}/x*")


def _raises(spark, error, action):
    try:
        action()
    except error:
        return spark.createDataFrame([(True,)], "raised boolean")
    return spark.createDataFrame([(False,)], "raised boolean")


@query("missing_column_error", "SELECT true AS raised")
def missing_column_error(spark, d):
    path = scratch_path(spark, "missing")
    write_table(spark.range(3).selectExpr("id", "id AS a"), f"{path}/a")
    write_table(spark.range(3), f"{path}/b")
    return _raises(spark, SchemaMismatch, lambda: read_table(spark, path))


PROMOTIONS = {"int8_int64": ("tinyint", "bigint", "BIGINT"), "int16_int32": ("smallint", "int", "INTEGER"), "float_double": ("float", "double", "DOUBLE")}
for _name, (_a, _b, _duck) in PROMOTIONS.items():

    def _promoted(spark, d, a=_a, b=_b):
        path = scratch_path(spark, "promote")
        write_table(spark.range(100).selectExpr(f"cast(id AS {a}) AS x"), f"{path}/a")
        write_table(spark.range(100).selectExpr(f"cast(id * 3 AS {b}) AS x"), f"{path}/b")
        return read_table(spark, path)

    query(f"promote_{_name}", f"SELECT id::{_duck} AS x FROM (SELECT unnest(generate_series(0, 99)) AS id) UNION ALL SELECT (id * 3)::{_duck} FROM (SELECT unnest(generate_series(0, 99)) AS id)")(_promoted)


@query("promote_error", "SELECT true AS raised")
def promote_error(spark, d):
    path = scratch_path(spark, "promote")
    write_table(spark.range(3).selectExpr("cast(id AS int) AS x"), f"{path}/a")
    write_table(spark.range(3).selectExpr("cast(id AS double) AS x"), f"{path}/b")
    return _raises(spark, PromotionError, lambda: read_table(spark, path))


query("unknown_option_error", "SELECT true AS raised")(lambda spark, d: _raises(spark, ValueError, lambda: table(spark, d, "nation", no_such_option=1)))
query("null_option_error", "SELECT true AS raised")(lambda spark, d: _raises(spark, ValueError, lambda: table(spark, d, "nation", file_row_number=None)))


@query("nulls_reject_error", "SELECT true AS raised")
def nulls_reject_error(spark, d):
    return _raises(spark, Exception, lambda: write_table(fixture(spark, "if(id = 9, null, id)"), scratch_path(spark, "rejected"), nulls="reject"))


@query("describe_query", "SELECT 'o_orderkey' AS col_name, 'bigint' AS data_type UNION ALL SELECT 'o_custkey', 'bigint' UNION ALL SELECT 'total', 'double'")
def describe_query(spark, d):
    df = table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice * 2 AS total")
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "col_name string, data_type string")


query("scan_csv", "SELECT n_nationkey, n_name FROM nation")(lambda spark, d: _through(spark, d, "csv"))
query("scan_json", "SELECT n_nationkey, n_name FROM nation")(lambda spark, d: _through(spark, d, "json"))
query("scan_orc", "SELECT n_nationkey, n_name FROM nation")(lambda spark, d: _through(spark, d, "orc"))


def _through(spark, d, kind):
    path, df = scratch_path(spark, kind), table(spark, d, "nation").select("n_nationkey", "n_name")
    df.write.format(kind).save(path)
    return spark.read.schema(df.schema).format(kind).load(path)
