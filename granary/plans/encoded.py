"""Queries on column encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import encodings as E
from granary.operators import symbols as S
from granary.plans.tables import query, table


def _events(spark, d, column):
    return table(spark, d, "events").selectExpr("event_id AS pos", f"{column} AS val")


def _orders(spark, d, column):
    """Positions by rank of the unique key, through the table's row numbers (files sorted by key)."""
    from granary.plans.scans import _sorted_orders

    return _sorted_orders(spark, d, read={"table_row_number": True}).selectExpr("table_row_number AS pos", f"{column} AS val")


EVENTS = "(SELECT event_id AS pos, event_type AS val FROM events)"
ORDERS = "(SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_custkey AS val FROM orders)"
RUNS = f"SELECT min(pos) AS run_start, count(*) AS run_length, first(val) AS val FROM (SELECT pos, val, sum(n) OVER (ORDER BY pos) AS g FROM (SELECT *, CASE WHEN val IS DISTINCT FROM lag(val) OVER (ORDER BY pos) THEN 1 ELSE 0 END AS n FROM {EVENTS})) GROUP BY g"

query("rle_encode", RUNS)(lambda spark, d: E.rle_encode(_events(spark, d, "event_type")))
query("rle_decode", f"SELECT * FROM {EVENTS}")(lambda spark, d: E.rle_decode(E.rle_encode(_events(spark, d, "event_type"))))
query("rle_map_decode", f"SELECT * FROM {EVENTS}")(lambda spark, d: E.rle_map_decode(*E.rle_map_encode(_events(spark, d, "event_type"))))
query("rle_map_runs", f"SELECT pos // 1024 AS vec, count(*) AS n_runs FROM (SELECT *, lag(val) OVER (PARTITION BY pos // 1024 ORDER BY pos) AS p, row_number() OVER (PARTITION BY pos // 1024 ORDER BY pos) AS r FROM {EVENTS}) WHERE r = 1 OR val IS DISTINCT FROM p GROUP BY 1")(
    lambda spark, d: E.rle_map_encode(_events(spark, d, "event_type"))[0].groupBy("vec").agg(F.count(F.lit(1)).alias("n_runs"))
)
query("dict_encode_string", f"SELECT pos, dense_rank() OVER (ORDER BY val) - 1 AS code FROM {EVENTS}")(lambda spark, d: E.dict_encode(_events(spark, d, "event_type"))[1])
query("dict_decode_string", f"SELECT * FROM {EVENTS}")(lambda spark, d: E.dict_decode(*E.dict_encode(_events(spark, d, "event_type"))))
query("dict_encode_number", f"SELECT pos, dense_rank() OVER (ORDER BY val) - 1 AS code FROM {ORDERS}")(lambda spark, d: E.dict_encode(_orders(spark, d, "o_custkey"))[1])
query("dict_keys_double", "SELECT DISTINCT l_discount AS val, dense_rank() OVER (ORDER BY l_discount) - 1 AS code FROM lineitem")(lambda spark, d: E.dict_encode(table(spark, d, "lineitem").selectExpr("l_orderkey AS pos", "l_discount AS val"))[0])
TOP = f"SELECT val FROM {EVENTS} GROUP BY val ORDER BY count(*) DESC, val LIMIT 1"
query("frequency_exceptions", f"SELECT pos, val FROM {EVENTS} WHERE val <> ({TOP})")(lambda spark, d: E.frequency_encode(_events(spark, d, "event_type"))[1])


@query("frequency_decode", "SELECT pos, val FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderstatus AS val FROM orders)")
def frequency_decode(spark, d):
    df = _orders(spark, d, "o_orderstatus")
    return E.frequency_decode(*E.frequency_encode(df), df.count())


WIDTH = "CASE WHEN max(val) = min(val) THEN 0 ELSE length(bin(max(val) - min(val))) END::BIGINT"
query("for_bitwidth", f"SELECT pos // 1024 AS vec, min(val) AS base, {WIDTH} AS bit_width, count(*) AS n FROM {ORDERS} GROUP BY 1")(lambda spark, d: E.for_encode(_orders(spark, d, "o_custkey")))
query("for_decode", f"SELECT * FROM {ORDERS}")(lambda spark, d: E.for_decode(E.for_offsets(_orders(spark, d, "o_custkey"))))
query(
    "patched_exceptions",
    f"WITH o AS (SELECT pos, pos // 1024 AS vec, val - min(val) OVER (PARTITION BY pos // 1024) AS \"offset\" FROM {ORDERS}), w AS (SELECT *, CASE WHEN \"offset\" = 0 THEN 0 ELSE length(bin(\"offset\")) END::BIGINT AS width FROM o), c AS (SELECT vec, quantile_disc(width, 0.5) AS cap FROM w GROUP BY vec) SELECT w.vec, pos, cap, \"offset\" FROM w JOIN c USING (vec) WHERE width > cap",
)(lambda spark, d: E.patched_exceptions(_orders(spark, d, "o_custkey"), 0.5))
query("constant_vectors", "SELECT pos // 1024 AS vec, min(val) AS val, count(*) AS n FROM (SELECT event_id AS pos, event_id // 3000 AS val FROM events) GROUP BY 1 HAVING min(val) = max(val)")(lambda spark, d: E.constant_vectors(_events(spark, d, "event_id div 3000")))
query("constant_vectors_string", "SELECT pos // 1024 AS vec, min(val) AS val, count(*) AS n FROM (SELECT event_id AS pos, 'k' || (event_id // 3000) AS val FROM events) GROUP BY 1 HAVING min(val) = max(val)")(lambda spark, d: E.constant_vectors(_events(spark, d, "concat('k', event_id div 3000)")))
query("alp_exponent", "SELECT pos // 1024 AS vec, CASE WHEN min(e) < 0 THEN -1 ELSE max(e) END::BIGINT AS exponent FROM (SELECT pos, CASE WHEN round(val) = val THEN 0 WHEN round(val * 10) / 10 = val THEN 1 WHEN round(val * 100) / 100 = val THEN 2 WHEN round(val * 1000) / 1000 = val THEN 3 ELSE -1 END AS e FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_totalprice AS val FROM orders)) GROUP BY 1")(
    lambda spark, d: E.alp_exponent(_orders(spark, d, "o_totalprice"), most=3)
)
query("alp_rd_glue", "SELECT value AS val FROM events")(lambda spark, d: E.real_glue(E.real_split(_events(spark, d, "value"))))
query("uncompressed_bytes", "SELECT pos // 1024 AS vec, sum(octet_length(encode(val)))::BIGINT AS n_bytes FROM (SELECT event_id AS pos, props AS val FROM events) GROUP BY 1")(lambda spark, d: E.uncompressed_bytes(_events(spark, d, "props")))


@query("untranspose", f"SELECT * FROM {EVENTS}")
def untranspose(spark, d):
    df = _events(spark, d, "event_type")
    n = df.count()
    return E.untranspose_lanes(E.transpose_lanes(df, rows=n), rows=n)


query("symbol_table", "SELECT symbol, n FROM (SELECT val[i:i+1] AS symbol, count(*) AS n FROM (SELECT event_type AS val, unnest(generate_series(1, length(event_type) - 1)) AS i FROM events) GROUP BY 1) ORDER BY n DESC, symbol LIMIT 255")(lambda spark, d: E.symbol_table(_events(spark, d, "event_type")))
query("duplicate_columns", "SELECT 'a' AS col_a, 'c' AS col_b")(lambda spark, d: E.duplicate_columns(table(spark, d, "orders").selectExpr("o_orderkey AS a", "o_custkey AS b", "o_orderkey AS c"), ["a", "b", "c"]))

# The same encodings of numbers.
STEPS = "(SELECT event_id AS pos, event_id // 37 AS val FROM events)"
RUNS_OF = RUNS.replace(EVENTS, STEPS)
query("rle_encode_number", RUNS_OF)(lambda spark, d: E.rle_encode(_events(spark, d, "event_id div 37")))
query("rle_decode_number", f"SELECT * FROM {STEPS}")(lambda spark, d: E.rle_decode(E.rle_encode(_events(spark, d, "event_id div 37"))))
query("rle_map_decode_number", f"SELECT * FROM {STEPS}")(lambda spark, d: E.rle_map_decode(*E.rle_map_encode(_events(spark, d, "event_id div 37"))))
query("rle_encode_nulls", RUNS.replace(EVENTS, "(SELECT event_id AS pos, CASE WHEN event_id // 5 % 3 <> 0 THEN event_id // 10 END AS val FROM events)"))(lambda spark, d: E.rle_encode(_events(spark, d, "if(event_id div 5 % 3 <> 0, event_id div 10, null)")))
FEW = "(SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, CASE WHEN o_custkey % 5 < 3 THEN 0 ELSE o_custkey % 5 END AS val FROM orders)"
few = lambda spark, d: _orders(spark, d, "if(o_custkey % 5 < 3, 0, o_custkey % 5)")
query("frequency_exceptions_number", f"SELECT pos, val FROM {FEW} WHERE val <> 0")(lambda spark, d: E.frequency_encode(few(spark, d))[1])


@query("frequency_decode_number", f"SELECT * FROM {FEW}")
def frequency_decode_number(spark, d):
    df = few(spark, d)
    return E.frequency_decode(*E.frequency_encode(df), df.count())


PRICES = "(SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_totalprice / 3 ELSE o_totalprice END AS val FROM orders)"
prices = lambda spark, d: _orders(spark, d, "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_totalprice / 3 ELSE o_totalprice END")
query("patched_decode", f"SELECT * FROM {ORDERS}")(lambda spark, d: E.patched_decode(*E.patched_encode(_orders(spark, d, "o_custkey"), 0.5)))
query("patched_widths", f"WITH o AS (SELECT pos // 1024 AS vec, val - min(val) OVER (PARTITION BY pos // 1024) AS x FROM {ORDERS}), c AS (SELECT vec, quantile_disc(CASE WHEN x = 0 THEN 0 ELSE length(bin(x)) END, 0.5)::BIGINT AS cap FROM o GROUP BY vec) SELECT vec, cap, max(x & ((1::BIGINT << cap) - 1))::BIGINT AS most FROM o JOIN c USING (vec) GROUP BY vec, cap")(
    lambda spark, d: E.patched_encode(_orders(spark, d, "o_custkey"), 0.5)[0].groupBy("vec", "cap").agg(F.max("low").alias("most"))
)
query("alp_decode", f"SELECT * FROM {PRICES}")(lambda spark, d: E.alp_decode(*E.alp_encode(prices(spark, d))))
query("alp_digits", "SELECT pos, (round(val * 100))::BIGINT AS digits FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, floor(o_totalprice) + 0.25 AS val FROM orders)")(lambda spark, d: E.alp_encode(_orders(spark, d, "floor(o_totalprice) + 0.25D"))[0].select("pos", "digits"))
CONSTANT = "(SELECT event_id AS pos, CASE WHEN event_id // 3000 % 4 <> 1 THEN event_id // 3000 END AS val FROM events)"
query("constant_decode", f"SELECT * FROM {CONSTANT}")(lambda spark, d: E.constant_decode(*E.constant_encode(_events(spark, d, "if(event_id div 3000 % 4 <> 1, event_id div 3000, null)"))))
PROPS = "(SELECT event_id AS pos, CASE WHEN event_id % 11 = 0 THEN NULL ELSE props || ' é☃' END AS val FROM events)"
props = lambda spark, d: _events(spark, d, "if(event_id % 11 = 0, null, concat(props, ' é☃'))")
for _bits, _name in ((8, "symbol"), (12, "symbol12")):

    def _symbols(spark, d, bits=_bits):
        df = props(spark, d)
        table = S.train_symbols(df, bits=bits)
        return S.symbol_decode(S.symbol_encode(df, table, bits=bits), table, bits=bits)

    def _symbols_of_keys(spark, d, bits=_bits):
        df = _events(spark, d, "event_type")
        table = S.train_symbols(df, bits=bits)
        return S.symbol_dict_decode(*S.symbol_dict_encode(df, table, bits=bits), table, bits=bits)

    def _smaller(spark, d, bits=_bits):
        df = props(spark, d)
        packed = S.symbol_encode(df, S.train_symbols(df, bits=bits), bits=bits)
        sums = packed.agg(F.sum(F.octet_length("packed")).alias("n")).crossJoin(df.agg(F.sum(F.octet_length("val")).alias("plain")))
        return sums.select((F.col("n") * 10 < F.col("plain") * 6).alias("smaller"))

    query(f"{_name}_decode", f"SELECT * FROM {PROPS}")(_symbols)
    query(f"{_name}_dict_decode", f"SELECT * FROM {EVENTS}")(_symbols_of_keys)
    query(f"{_name}_is_smaller", "SELECT true AS smaller")(_smaller)
