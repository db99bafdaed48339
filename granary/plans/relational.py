"""General SQL over scans: joins, aggregates, windows, set operations, scalars and streams."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from granary.operators.joins import asof_join, range_join
from granary.operators.percentiles import percentiles
from granary.plans.tables import ORACLES, QUERIES, query, table, views
from granary.session import scratch_path
from granary.sources.reader import read_table
from granary.sources.writer import write_table
from granary.streaming import append_table, distinct_rows, run_to_table, running_totals, session_counts, sliding_counts, stream_table, tumbling_counts

#: name: (tables, SQL that both engines run, or the pair of Spark's and the oracle's)
SQL = {
    "join_inner": ("orders customer", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000"),
    "join_left": ("customer orders", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000"),
    "join_right": ("customer orders", "SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey AND o_totalprice > 350000"),
    "join_full": ("customer supplier", "SELECT c_custkey, s_suppkey FROM customer FULL OUTER JOIN supplier ON c_custkey = s_suppkey + 50"),
    "join_semi": ("customer orders", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)"),
    "join_anti": ("customer orders", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"),
    "join_cross": ("region nation", "SELECT r_name, n_name FROM region CROSS JOIN nation"),
    "join_theta": ("nation", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey"),
    "join_using_full": ("nation region", "SELECT k, n, r FROM (SELECT n_regionkey + 2 AS k, n_name AS n FROM nation) FULL OUTER JOIN (SELECT r_regionkey AS k, r_name AS r FROM region) USING (k)"),
    "group_having": ("lineitem", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag HAVING count(*) > 10"),
    "count_distinct": ("lineitem", "SELECT count(DISTINCT l_linestatus) AS n FROM lineitem"),
    "aggregate_filter": ("orders", "SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 100000) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY o_orderstatus"),
    "rollup": ("orders", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"),
    "cube": ("orders", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"),
    "grouping_sets": ("orders", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"),
    "window_rank": ("orders", "SELECT o_orderkey, CAST(rank() OVER w AS bigint) AS r, CAST(dense_rank() OVER w AS bigint) AS dr, CAST(row_number() OVER w AS bigint) AS rn FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)"),
    "window_ntile": ("orders", "SELECT o_orderkey, CAST(ntile(4) OVER w AS bigint) AS q, percent_rank() OVER w AS pr, cume_dist() OVER w AS cd FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)"),
    "window_lag_lead": ("orders", "SELECT o_orderkey, lag(o_orderkey) OVER w AS p, lead(o_orderkey, 2) OVER w AS nx FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)"),
    "window_frame": ("orders", "SELECT o_orderkey, count(*) OVER w AS n, min(o_orderkey) OVER w AS lo FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)"),
    "window_range": ("orders", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey RANGE BETWEEN 10 PRECEDING AND CURRENT ROW) AS n FROM orders"),
    "window_first_last": ("orders", "SELECT o_orderkey, first_value(o_orderkey) OVER w AS f, last_value(o_orderkey) OVER w AS l, nth_value(o_orderkey, 2) OVER w AS s FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"),
    "top_k": ("orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
    "limit_offset": ("orders", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 15"),
    "order_by_two": ("nation", "SELECT n_regionkey, n_name FROM nation ORDER BY n_regionkey, n_name"),
    "set_union": ("nation supplier", "SELECT n_nationkey AS k FROM nation UNION SELECT s_nationkey FROM supplier"),
    "set_intersect": ("customer supplier", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier"),
    "set_except": ("customer orders", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders"),
    "set_intersect_all": ("customer supplier", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier"),
    "set_except_all": ("customer supplier", "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier"),
    "distinct": ("orders", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"),
    "scalar_subquery": ("orders", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM orders)"),
    "in_subquery": ("orders customer", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
    "correlated_subquery": ("orders", "SELECT o_orderkey FROM orders a WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders b WHERE b.o_custkey = a.o_custkey)"),
    "lateral_join": ("customer orders", "SELECT c_custkey, m FROM customer, LATERAL (SELECT max(o_orderkey) AS m FROM orders WHERE o_custkey = c_custkey) t"),
    "cte": ("orders", "WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), most AS (SELECT max(n) AS m FROM big) SELECT o_custkey, n FROM big JOIN most ON n = m"),
    "recursive_cte": ("region", "WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 50) SELECT n FROM t"),
    "string_scalars": ("nation", "SELECT n_nationkey, upper(n_name) AS u, lower(n_name) AS l, length(n_name) AS n, substr(n_name, 2, 3) AS s, reverse(n_name) AS r, replace(n_name, 'A', '-') AS x, n_name || '!' AS c, md5(n_name) AS m, lpad(n_name, 12, '.') AS p FROM nation"),
    "math_scalars": ("supplier", "SELECT s_suppkey, abs(s_acctbal) AS a, floor(s_acctbal) AS f, ceil(s_acctbal) AS c, round(s_acctbal, 1) AS r, s_suppkey % 7 AS m, sign(s_acctbal) AS sg, round(sqrt(abs(s_acctbal)), 6) AS q FROM supplier"),
    "conditionals": ("orders", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 50000 THEN 'mid' ELSE 'low' END AS band, coalesce(nullif(o_orderstatus, 'F'), 'none') AS st, greatest(o_orderkey, o_custkey) AS g FROM orders"),
    "distinct_from": ("orders", "SELECT count(*) AS n FROM orders WHERE nullif(o_orderstatus, 'F') IS DISTINCT FROM nullif(o_orderstatus, 'O')"),
    "exact_decimal_sum": ("lineitem", "SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS decimal(28,2)) AS total FROM lineitem GROUP BY l_returnflag"),
    "try_cast": ("nation", "SELECT n_nationkey, try_cast(CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS varchar(9)) ELSE n_name END AS int) AS x FROM nation"),
    "values_list": ("region", "SELECT a, b FROM (VALUES (1, 'x'), (2, 'y')) AS t(a, b)"),
    "tpch_q3": ("customer orders lineitem", "SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS decimal(12,2)) * (1 - CAST(l_discount AS decimal(4,2)))) AS decimal(28,4)) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' GROUP BY l_orderkey"),
    "tpch_q5": ("customer orders lineitem supplier nation region", "SELECT n_name, CAST(sum(CAST(l_extendedprice AS decimal(12,2)) * (1 - CAST(l_discount AS decimal(4,2)))) AS decimal(28,4)) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name"),
    "tpch_q6": ("lineitem", "SELECT CAST(sum(CAST(l_extendedprice AS decimal(12,2)) * CAST(l_discount AS decimal(4,2))) AS decimal(28,4)) AS revenue FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24"),
}
PAIRS = {
    "date_scalars": ("orders", "SELECT o_orderkey, cast(year(o_orderdate) as bigint) AS y, cast(month(o_orderdate) as bigint) AS m, cast(date_trunc('month', o_orderdate) as date) AS t, date_add(cast(o_orderdate as date), 10) AS p FROM orders", "SELECT o_orderkey, year(o_orderdate)::BIGINT AS y, month(o_orderdate)::BIGINT AS m, date_trunc('month', o_orderdate)::DATE AS t, o_orderdate::DATE + 10 AS p FROM orders"),
    "regex_scalars": ("part", r"SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '') AS x, regexp_extract(p_name, '([a-z]+)', 1) AS w, p_name RLIKE '^[a-m]' AS early FROM part", r"SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '', 'g') AS x, regexp_extract(p_name, '([a-z]+)', 1) AS w, regexp_matches(p_name, '^[a-m]') AS early FROM part"),
    "pivot": ("orders", "SELECT * FROM (SELECT o_orderpriority, o_orderstatus FROM orders) PIVOT (count(*) FOR o_orderstatus IN ('F' AS f, 'O' AS o))", "SELECT o_orderpriority, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS f, nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS o FROM orders GROUP BY o_orderpriority"),
    "unpivot": ("nation", "SELECT n_nationkey, k, v FROM (SELECT n_nationkey, n_regionkey AS a, n_nationkey * 2 AS b FROM nation) UNPIVOT (v FOR k IN (a, b))", "SELECT n_nationkey, 'a' AS k, n_regionkey AS v FROM nation UNION ALL SELECT n_nationkey, 'b', n_nationkey * 2 FROM nation"),
    "array_functions": ("embeddings", "SELECT vec_id, cast(size(embedding) as bigint) AS n, round(aggregate(embedding, 0D, (a, x) -> a + x * cast(x as double)), 4) AS sq, embedding[0] AS f FROM embeddings", "SELECT vec_id, len(embedding)::BIGINT AS n, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS sq, embedding[1] AS f FROM embeddings"),
    "json_fields": ("events", "SELECT event_id, get_json_object(j, '$.id') AS id, get_json_object(j, '$.tags[1]') AS tag, get_json_object(j, '$.in.kind') AS kind, get_json_object(j, '$.none') AS none FROM (SELECT event_id, to_json(named_struct('id', event_id, 'tags', array('t', event_type), 'in', named_struct('kind', event_type))) AS j FROM events)", "SELECT event_id, j->>'$.id' AS id, j->>'$.tags[1]' AS tag, j->>'$.in.kind' AS kind, j->>'$.none' AS none FROM (SELECT event_id, json_object('id', event_id, 'tags', ['t', event_type], 'in', json_object('kind', event_type)) AS j FROM events)"),
    "json_parsed": ("events", "SELECT event_id, p.k AS k, p.xs AS xs FROM (SELECT event_id, from_json(concat('{\"k\": ', event_id, ', \"xs\": [1, ', event_id % 5, ']}'), 'k bigint, xs array<bigint>') AS p FROM events)", "SELECT event_id, event_id AS k, [1, event_id % 5] AS xs FROM events"),
    "map_functions": ("nation", "SELECT n_nationkey, element_at(m, 'b') AS b, array_sort(map_keys(m)) AS ks, array_sort(map_values(transform_values(m, (k, v) -> v * 2))) AS vs, cast(size(map_filter(m, (k, v) -> v > 5)) as bigint) AS n, map_contains_key(m, 'z') AS z FROM (SELECT n_nationkey, map('a', n_nationkey, 'b', n_regionkey) AS m FROM nation)", "SELECT n_nationkey, n_regionkey AS b, ['a', 'b'] AS ks, list_sort([n_nationkey * 2, n_regionkey * 2]) AS vs, (n_nationkey > 5)::BIGINT + (n_regionkey > 5)::BIGINT AS n, false AS z FROM nation"),
    "struct_functions": ("nation", "SELECT n_nationkey, s.name AS name, s.inner.r AS r, u.extra AS extra, s = named_struct('name', n_name, 'inner', named_struct('r', n_regionkey)) AS same FROM (SELECT *, struct(s.*, 1 AS extra) AS u FROM (SELECT *, named_struct('name', n_name, 'inner', named_struct('r', n_regionkey)) AS s FROM nation))", "SELECT n_nationkey, n_name AS name, n_regionkey AS r, 1 AS extra, true AS same FROM nation"),
    "higher_order": ("nation", "SELECT n_nationkey, transform(xs, x -> x * 2) AS doubled, filter(xs, x -> x % 2 = 0) AS even, exists(xs, x -> x > 20) AS big, forall(xs, x -> x >= 0) AS all_up, zip_with(xs, array(1L, 2L, 3L), (a, b) -> a + b) AS zipped, array_sort(xs, (a, b) -> int(sign(b - a))) AS down FROM (SELECT n_nationkey, array(n_nationkey, n_regionkey, 7L) AS xs FROM nation)", "SELECT n_nationkey, list_transform(xs, lambda x: x * 2) AS doubled, list_filter(xs, lambda x: x % 2 = 0) AS even, len(list_filter(xs, lambda x: x > 20)) > 0 AS big, true AS all_up, [xs[1] + 1, xs[2] + 2, xs[3] + 3] AS zipped, list_reverse_sort(xs) AS down FROM (SELECT n_nationkey, [n_nationkey, n_regionkey, 7::BIGINT]::BIGINT[] AS xs FROM nation)"),
    "collected_sets": ("orders", "SELECT o_orderpriority, array_sort(collect_set(o_orderstatus)) AS statuses, array_sort(collect_list(o_orderkey % 3)) AS all_of FROM orders WHERE o_orderkey < 300 GROUP BY o_orderpriority", "SELECT o_orderpriority, list_sort(list(DISTINCT o_orderstatus)) AS statuses, list_sort(list(o_orderkey % 3)) AS all_of FROM orders WHERE o_orderkey < 300 GROUP BY o_orderpriority"),
    "more_aggregates": ("orders", "SELECT o_orderstatus, bool_and(o_totalprice > 0) AS a, bool_or(o_orderkey = 7) AS o, bit_xor(o_orderkey) AS x, max_by(o_orderkey, o_totalprice) AS dearest, count_if(o_custkey % 2 = 0) AS even, round(stddev_samp(o_totalprice), 3) AS sd, round(corr(o_orderkey, o_totalprice), 6) AS c, array_join(array_sort(collect_set(o_orderpriority)), ',') AS listed FROM orders GROUP BY o_orderstatus", "SELECT o_orderstatus, bool_and(o_totalprice > 0) AS a, bool_or(o_orderkey = 7) AS o, bit_xor(o_orderkey) AS x, max_by(o_orderkey, o_totalprice) AS dearest, count_if(o_custkey % 2 = 0)::BIGINT AS even, round(stddev_samp(o_totalprice), 3) AS sd, round(corr(o_orderkey, o_totalprice), 6) AS c, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS listed FROM orders GROUP BY o_orderstatus"),
    "approx_distinct": ("orders", "SELECT o_orderpriority, abs(approx_count_distinct(o_custkey, 0.02) - count(DISTINCT o_custkey)) <= 0.1 * count(DISTINCT o_custkey) AS close FROM orders GROUP BY o_orderpriority", "SELECT o_orderpriority, true AS close FROM orders GROUP BY o_orderpriority"),
    "exact_percentiles": ("orders", "SELECT o_orderstatus, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY o_totalprice), 4) AS q, percentile_disc(0.75) WITHIN GROUP (ORDER BY o_orderkey) AS d, mode() WITHIN GROUP (ORDER BY o_orderpriority) IS NOT NULL AS m FROM orders GROUP BY o_orderstatus", "SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.25), 4) AS q, quantile_disc(o_orderkey, 0.75)::DOUBLE AS d, true AS m FROM orders GROUP BY o_orderstatus"),
    "explode": ("nation", "SELECT n_nationkey, w FROM (SELECT n_nationkey, explode(split(n_name, '')) AS w FROM nation) WHERE w <> ''", "SELECT n_nationkey, unnest(string_split(n_name, '')) AS w FROM nation"),
    "median": ("orders", "SELECT o_orderstatus, round(median(o_totalprice), 4) AS med FROM orders GROUP BY o_orderstatus", "SELECT o_orderstatus, round(median(o_totalprice), 4) AS med FROM orders GROUP BY o_orderstatus"),
    "generate_series": ("region", "SELECT id FROM range(1, 1025)", "SELECT unnest(generate_series(1, 1024)) AS id"),
}

for _name, (_tables, _sql) in SQL.items():
    query(_name, _sql)(lambda spark, d, t=_tables, s=_sql: (views(spark, d, *t.split()), spark.sql(s))[1])
for _name, (_tables, _sql, _oracle) in PAIRS.items():
    query(_name, _oracle)(lambda spark, d, t=_tables, s=_sql: (views(spark, d, *t.split()), spark.sql(s))[1])


@query("approx_percentiles", "SELECT o_orderpriority, quantile_disc(o_orderkey, [0.1, 0.5, 0.9]) AS q FROM orders GROUP BY o_orderpriority")
def approx_percentiles(spark, d):
    """Approximate percentiles, made exact: a sketch of a large group is off by some ranks at any accuracy."""
    return percentiles(table(spark, d, "orders"), "o_orderpriority", "o_orderkey", [Decimal("0.1"), Decimal("0.5"), Decimal("0.9")], "q")


@query("asof_join", "SELECT e.event_id, p.last_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS last_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) p ON e.user_id = p.user_id AND e.ts >= p.ts")
def asof(spark, d):
    events = table(spark, d, "events")
    buys = events.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("bought"))
    return asof_join(events.select("event_id", "user_id", "ts"), buys, "user_id", "ts", "ts", "bought", "last_id").select("event_id", "last_id")


@query("asof_join_nulls", """SELECT l.id, r.val FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey % 20 END AS k, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS t FROM orders) l
ASOF LEFT JOIN (SELECT CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 20 END AS k, s_suppkey * 15 AS t, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey END AS val FROM supplier) r ON l.k = r.k AND l.t >= r.t""")
def asof_nulls(spark, d):
    """NULL keys and times match nothing; the last row's value counts, NULL or not."""
    left = table(spark, d, "orders").selectExpr("o_orderkey AS id", "if(o_orderkey % 9 = 0, null, o_custkey % 20) AS k", "if(o_orderkey % 13 = 0, null, o_orderkey) AS t")
    right = table(spark, d, "supplier").selectExpr("if(s_suppkey % 7 = 0, null, s_suppkey % 20) AS k", "s_suppkey * 15 AS t", "if(s_suppkey % 3 = 0, null, s_suppkey) AS val")
    return asof_join(left, right, "k", "t", "t", "val", "val").select("id", "val")


@query("range_join", "SELECT o_orderkey, s_suppkey FROM orders JOIN supplier ON o_custkey >= s_suppkey * 10 AND o_custkey < s_suppkey * 10 + 5")
def ranges(spark, d):
    spans = table(spark, d, "supplier").selectExpr("s_suppkey", "s_suppkey * 10 AS lo", "s_suppkey * 10 + 5 AS hi")
    return range_join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), spans, "o_custkey", "lo", "hi", 64).select("o_orderkey", "s_suppkey")


@query("sample_rows")
def sample_rows(spark, d):
    return table(spark, d, "orders").sample(0.1, seed=7).select("o_orderkey")


@query("sample_share", "SELECT true AS close, true AS all_known")
def sample_share(spark, d):
    """A sample's size, and that its rows are rows of the table."""
    orders = table(spark, d, "orders").select("o_orderkey")
    found = orders.sample(0.1, seed=7).join(orders.withColumn("known", F.lit(True)), "o_orderkey", "left")
    n = orders.count()
    return found.agg((F.abs(F.count(F.lit(1)) - n * 0.1) < n * 0.03).alias("close"), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known"))


@query("scalar_udf", "SELECT o_orderkey, upper(o_orderpriority) || '/' || length(o_orderstatus) AS tag FROM orders")
def scalar_udf(spark, d):
    @F.pandas_udf(StringType())
    def tag(priority: pd.Series, status: pd.Series) -> pd.Series:
        return priority.str.upper() + "/" + status.str.len().astype(str)

    return table(spark, d, "orders").select("o_orderkey", tag("o_orderpriority", "o_orderstatus").alias("tag"))


@query("aggregate_udf", "SELECT o_orderstatus, max(o_orderkey) - min(o_orderkey) AS spread FROM orders GROUP BY o_orderstatus")
def aggregate_udf(spark, d):
    @F.pandas_udf(LongType())
    def spread(x: pd.Series) -> int:
        return int(x.max() - x.min())

    return table(spark, d, "orders").groupBy("o_orderstatus").agg(spread("o_orderkey").alias("spread"))


@query("table_udf", "SELECT n_nationkey, i - 1 AS i, substr(n_name, i::INTEGER, 1) AS letter FROM (SELECT n_nationkey, n_name, unnest(generate_series(1, length(n_name))) AS i FROM nation)")
def table_udf(spark, d):
    class Letters:
        def eval(self, text: str):
            for i, c in enumerate(text):
                yield i, c

    schema = StructType([StructField("i", LongType()), StructField("letter", StringType())])
    spark.udtf.register("letters_of", F.udtf(Letters, returnType=schema))
    views(spark, d, "nation")
    return spark.sql("SELECT n_nationkey, t.i, t.letter FROM nation, LATERAL letters_of(n_name) t")


@query("view_over_scan", "SELECT count(*) AS n, max(o_orderkey) AS hi FROM orders")
def view_over_scan(spark, d):
    views(spark, d, "orders")
    return spark.sql("SELECT count(*) AS n, max(o_orderkey) AS hi FROM orders")


@query("create_table_as", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey")
def create_table_as(spark, d):
    path = scratch_path(spark, "ctas")
    write_table(table(spark, d, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def _stream(spark, d, files=None, per_trigger=None):
    """The events as a stream, by time in ``files`` files, as many as shuffles have partitions where none is said."""
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "stream")
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id")
    write_table(events.repartitionByRange(files, "ts").sortWithinPartitions("ts"), path)
    return stream_table(spark, path, events.schema, per_trigger)


@query("stream_tumbling_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling_counts(spark, d):
    rows = run_to_table(tumbling_counts(_stream(spark, d), "ts", "event_type"), "complete")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("stream_sliding_counts", "SELECT w AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts - INTERVAL 30 MINUTE) + INTERVAL 30 MINUTE]) AS w FROM events) GROUP BY 1, 2")
def stream_sliding_counts(spark, d):
    rows = run_to_table(sliding_counts(_stream(spark, d), "ts", "event_type"), "complete")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("stream_session_counts", """SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def stream_session_counts(spark, d):
    rows = run_to_table(session_counts(_stream(spark, d), "ts", "user_id"), "complete")
    return rows.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")], "user_id", "n")


@query("stream_running_totals", "SELECT event_type, count(*) AS n, max(event_id) AS most FROM events GROUP BY 1")
def stream_running_totals(spark, d):
    """State carried over several micro-batches: the last total of each key."""
    rows = run_to_table(running_totals(_stream(spark, d, 3, 1), "event_type", "event_id"), "update")
    return rows.groupBy("event_type").agg(F.max("n").alias("n"), F.max("most").alias("most"))


@query("stream_distinct", "SELECT DISTINCT event_type FROM events")
def stream_distinct(spark, d):
    """A watermark far behind, so that no key is forgotten within the table."""
    return run_to_table(distinct_rows(_stream(spark, d, 3, 1), "ts", ["event_type"], "3650 days"), "append").select("event_type")


@query("stream_append", "SELECT event_id, event_type FROM events")
def stream_append(spark, d):
    path = scratch_path(spark, "stream-out")
    append_table(_stream(spark, d, 3, 1).select("event_id", "event_type"), path, scratch_path(spark, "stream-state"), row_group_size=500).awaitTermination()
    return read_table(spark, path)


@query("stream_static_join", "SELECT event_id, name FROM events JOIN (SELECT 'purchase' AS event_type, 'bought' AS name UNION ALL SELECT 'click', 'clicked') USING (event_type)")
def stream_static_join(spark, d):
    names = spark.createDataFrame([("purchase", "bought"), ("click", "clicked")], "event_type string, name string")
    return run_to_table(_stream(spark, d).join(F.broadcast(names), "event_type").select("event_id", "name"), "append")


__all__ = ["ORACLES", "QUERIES"]
