"""Joins that Spark has no operator for, made from its equi-joins and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Time ranges into which a key's rows are cut, so that a hot key is no single task's.
SLICES = 16


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, out: str, slices: int = SLICES) -> DataFrame:
    """For each left row the ``value`` of the last right row of its key at or before its time, NULL where there is none.

    A NULL key or time matches nothing, on either side; a NULL value of the
    last right row is its value. Of right rows with one time the largest value
    counts. Both sides are merged into one sorted run per key and time range,
    and the last row is carried forward, into a range from the last one that had
    any: no pair of rows is ever made, and a key's rows meet in as many tasks
    as there are ranges.
    """
    names = left.columns
    events = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(F.col(key).alias("__k"), F.col(right_time).alias("__t"), F.struct(F.col(value).alias("v")).alias("__v"))
    slice_of = _slices(events, slices)
    events = events.withColumn("__s", slice_of("__t"))
    lasts = events.groupBy("__k", "__s").agg(F.max(F.struct("__t", "__v")).getField("__v").alias("__v"))
    until = F.coalesce(F.lead("__s").over(Window.partitionBy("__k").orderBy("__s")), F.lit(slices - 1))
    carried = lasts.withColumn("__to", until).where("__to > __s").select("__k", "__v", F.explode(F.sequence(F.col("__s") + 1, F.col("__to"))).alias("__s"))
    seeking = left.withColumn("__row", F.struct(*[F.col(f"`{n}`") for n in names])).select("__row", F.col(f"`{key}`").alias("__k"), F.col(f"`{left_time}`").alias("__t"))
    able = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    row, held, when = seeking.schema["__row"].dataType, events.schema["__v"].dataType, events.schema["__t"].dataType
    merged = seeking.where(able).select("__row", "__k", slice_of("__t").alias("__s"), F.col("__t").cast(when).alias("__t"), F.lit(None).cast(held).alias("__v"))
    merged = merged.unionByName(events.select(F.lit(None).cast(row).alias("__row"), "__k", "__s", "__t", "__v"))
    merged = merged.unionByName(carried.select(F.lit(None).cast(row).alias("__row"), "__k", "__s", F.lit(None).cast(when).alias("__t"), "__v"))
    order = Window.partitionBy("__k", "__s").orderBy(F.asc_nulls_first("__t"), F.col("__row").isNotNull(), F.asc_nulls_first("__v")).rowsBetween(Window.unboundedPreceding, 0)
    found = merged.withColumn("__last", F.last("__v", ignorenulls=True).over(order)).where("__row IS NOT NULL").select("__row", F.col("__last.v").alias("__out"))
    alone = seeking.where(~able).select("__row", F.lit(None).cast(right.schema[value].dataType).alias("__out"))
    return found.unionByName(alone).select(*[F.col(f"__row.`{n}`").alias(n) for n in names], F.col("__out").alias(out))


def _slices(events: DataFrame, slices: int):
    """A function from a time column to the number of its range; the borders are quantiles of the events' times."""
    cuts = events.select(F.percentile_approx("__t", [i / slices for i in range(1, slices)], 1000)).first()[0] if slices > 1 else []
    kind = events.schema["__t"].dataType
    borders = [F.lit(c).cast(kind) for c in sorted(set(cuts or []))]

    def number(time: str) -> Column:
        total = F.lit(0)
        for border in borders:
            total += F.when(F.col(time) > border, 1).otherwise(0)
        return total

    return number


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Rows of ``left`` whose ``point`` lies in [low, high) of a ``right`` row.

    Intervals are dealt to the cells of ``width`` that they touch, points to
    theirs, so an equi-join on the cell does the work instead of a nested loop.
    """
    cells = right.withColumn("__cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    dealt = left.withColumn("__cell", F.floor(F.col(point) / width))
    return dealt.join(cells, "__cell").where((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("__cell")
