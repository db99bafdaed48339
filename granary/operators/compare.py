"""Row-by-row comparison of a table with its copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compare_roundtrip(original: DataFrame, copy: DataFrame, key: str = "id", value: str = "col") -> DataFrame:
    """Rows that differ: number both sides by ``key``, join fully on the number, keep distinct pairs.

    The numbering is one global order, so it is made without a single-task
    window: rows are range-partitioned by key, counted per partition, and each
    partition numbers its own rows from the sum of those before.
    """
    left = number_rows(original.select(F.col(key).alias("orig_id"), F.col(value).alias("orig_col")), "orig_id")
    right = number_rows(copy.select(F.col(key).alias("rt_id"), F.col(value).alias("rt_col")), "rt_id")
    differs = ~F.col("orig_id").eqNullSafe(F.col("rt_id")) | ~F.col("orig_col").eqNullSafe(F.col("rt_col"))
    return left.join(right, "row_pos", "full").where(differs).select("row_pos", "orig_id", "rt_id", "orig_col", "rt_col")


def number_rows(df: DataFrame, order: str, name: str = "row_pos") -> DataFrame:
    """1-based row numbers over the whole frame in the order of one column, without a single-task sort.

    Buckets are quantile ranges of the column; only the bucket counts meet in
    one place (at most ``n_buckets`` rows), and rows are ranked in their bucket.
    """
    spark = df.sparkSession
    n_buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.select(F.percentile_approx(order, [i / n_buckets for i in range(1, n_buckets)], 1000)).first()[0]
    cuts = sorted(set(cuts or []))
    bucket = F.lit(0)
    if cuts:
        bucket = F.aggregate(F.array(*[F.lit(c) for c in cuts]), F.lit(0), lambda n, c: n + F.when(F.col(order) > c, 1).otherwise(0))
    dealt = df.withColumn("__bucket", bucket)
    before = dealt.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    earlier = before.select("__bucket", (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__before"))
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy("__bucket").orderBy(order)))
    return ranked.join(F.broadcast(earlier), "__bucket").withColumn(name, (F.col("__before") + F.col("__rank")).cast("bigint")).drop("__bucket", "__before", "__rank")
