"""Exact percentiles of large groups: approximate ones find the stretch that holds a rank, which alone is sorted."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The stretch that is sorted goes this share of a group below and above the percentile sought.
MARGIN = Decimal("0.01")


def percentiles(df: DataFrame, by: str, value: str, shares: list[Decimal], name: str) -> DataFrame:
    """(by, name): per group, for each share the smallest value that so many of the group's values don't exceed.

    Approximate percentiles cut a group into stretches; counts say exactly which
    of them holds a rank, however far off the cuts are. Equal values are one row
    with a count, so neither a hot value nor a large group is held in memory.
    Ranks are computed in decimals. Nulls don't count; a group of nothing else
    has null.
    """
    rows = df.select(F.col(by).alias("g"), F.col(value).alias("v"))
    edges = sorted({min(Decimal(1), max(Decimal(0), p + m)) for p in shares for m in (-MARGIN, MARGIN)})
    cuts = rows.groupBy("g").agg(F.count("v").alias("n"), F.percentile_approx("v", [float(e) for e in edges], 10_000).alias("cuts"))
    own = cuts.select(F.col("g").alias("h"), "cuts")
    placed = rows.where("v IS NOT NULL").join(own, F.col("g").eqNullSafe(F.col("h"))).select("g", "v", F.expr("size(filter(cuts, c -> c < v))").alias("part"))
    running = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("held")).withColumn("upto", F.sum("held").over(running))
    rank = F.greatest(F.lit(1), F.ceil(F.col("n").cast("decimal(20,0)") * F.col("share")).cast("long"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).cast("decimal(17,16)").alias("share")) for i, p in enumerate(shares)])
    ranks = cuts.where("n > 0").select(F.col("g").alias("h"), "n", F.inline(wanted)).select("h", "i", rank.alias("rank"))
    at = parts.join(ranks, F.col("g").eqNullSafe(F.col("h")) & (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("held")))
    at = at.select("h", F.col("part").alias("stretch"), "i", (F.col("rank") - F.col("upto") + F.col("held")).alias("rank"))
    near = placed.join(at, F.col("g").eqNullSafe(F.col("h")) & (F.col("part") == F.col("stretch"))).groupBy("g", "i", "rank", "v").agg(F.count(F.lit(1)).alias("held"))
    running = Window.partitionBy("g", "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    hit = near.withColumn("upto", F.sum("held").over(running)).where("rank <= upto AND rank > upto - held")
    found = hit.groupBy(F.col("g").alias("h")).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("q"))
    return cuts.join(found, F.col("g").eqNullSafe(F.col("h")), "left").select(F.col("g").alias(by), F.col("q.v").alias(name))
