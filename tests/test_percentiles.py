"""Percentiles against their SQL, in groups too large for a sketch to be exact."""

from decimal import Decimal

from oracle import compare, connect
from pyspark.sql import functions as F

from granary.operators.percentiles import percentiles
from granary.plans import relational  # noqa: F401
from granary.plans.tables import ORACLES, QUERIES
from granary.session import scratch_path


def test_query_on_large_groups(spark):
    """Failed with percentile_approx, whose ranks were off by one or two."""
    path = scratch_path(spark, "orders").removeprefix("file:")
    rows = spark.range(600_000).select((F.xxhash64("id") % 10**12).alias("o_orderkey"), F.concat(F.lit("p"), F.col("id") % 3).alias("o_orderpriority"))
    rows.write.parquet(f"{path}/orders.parquet")
    con = connect(path)
    con.execute(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM read_parquet('{path}/orders.parquet/*.parquet')")
    compare(QUERIES["approx_percentiles"](spark, path), con, ORACLES["approx_percentiles"])


def test_nulls_repeats_and_small_groups(spark):
    values = {"one": [7], "even": [4, 1, 3, 2], "ten": list(range(10)), "hot": [5] * 3000 + [1, 9], "gaps": [None, 3, None, 8, 1], "none": [None, None], None: [2, 6, 4], "large": [2**60 + i for i in range(11)]}
    rows = [(g, v) for g, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: r.q for r in percentiles(df, "g", "v", [Decimal("0"), Decimal("0.1"), Decimal("0.5"), Decimal("0.9"), Decimal("1")], "q").collect()}
    for g, vs in values.items():
        s = sorted(v for v in vs if v is not None)
        assert got[g] == ([s[max(1, -(-len(s) * p // 10)) - 1] for p in (0, 1, 5, 9, 10)] if s else None), g
    assert len(got) == len(values)
    assert percentiles(df.where("v < 0"), "g", "v", [Decimal("0.5")], "q").collect() == []
