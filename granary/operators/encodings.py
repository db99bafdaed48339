"""Lightweight column encodings as DataFrame expressions.

Storage picks its own encodings; these show what each would do to a column,
with positions 0.. in ``pos`` and values in ``val``, cut into vectors of
``VECTOR`` rows. Encoders and decoders are inverse to each other, NULLs included.

Runs, codes and widths are found per vector or per key, so every window is
partitioned: by vector, or by block for runs across vectors, whose border runs
meet in larger blocks, step by step, until few are left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import materialize

VECTOR = 1024
#: Rows to a block in which runs are joined; only the first and last run of each go on to the next.
RUN_BLOCKS = (1 << 16, 1 << 22, 1 << 28)


def with_vector(df: DataFrame, pos: str = "pos") -> DataFrame:
    return df.withColumn("vec", F.floor(F.col(pos) / VECTOR).cast("bigint"))


def rle_encode(df: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    """Runs of equal neighbours over the whole column: run_start, run_length, val."""
    runs = df.select(F.col(pos).alias("run_start"), F.lit(1).cast("bigint").alias("run_length"), val)
    done = None
    for block in RUN_BLOCKS:
        joined = _join_runs(runs, F.floor(F.col("run_start") / block), val)
        edge = Window.partitionBy("__b")
        tagged = joined.withColumn("__edge", (F.col("run_start") == F.min("run_start").over(edge)) | (F.col("run_start") == F.max("run_start").over(edge)))
        inner = tagged.where("NOT __edge").select("run_start", "run_length", val)
        done = inner if done is None else done.unionByName(inner)
        runs = tagged.where("__edge").select("run_start", "run_length", val)
    return done.unionByName(_join_runs(runs, F.lit(0), val).select("run_start", "run_length", val))  # two rows a block of the largest


def _join_runs(runs: DataFrame, block: Column, val: str) -> DataFrame:
    """Neighbouring runs of one value joined within each block."""
    w = Window.partitionBy("__b").orderBy("run_start")
    goes_on = F.col(val).eqNullSafe(F.lag(val).over(w)) & (F.col("run_start") == F.lag(F.col("run_start") + F.col("run_length")).over(w))
    marked = runs.withColumn("__b", block).withColumn("__new", F.when(goes_on, 0).otherwise(1))
    numbered = marked.withColumn("__run", F.sum("__new").over(w))
    return numbered.groupBy("__b", "__run").agg(F.min("run_start").alias("run_start"), F.sum("run_length").alias("run_length"), F.first(val).alias(val))


def rle_decode(runs: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    return runs.select(F.explode(F.sequence("run_start", F.col("run_start") + F.col("run_length") - 1)).alias(pos), val)


def rle_map_encode(df: DataFrame, pos: str = "pos", val: str = "val") -> tuple[DataFrame, DataFrame]:
    """Per vector: the values of its runs by number, and the run number of each position."""
    w = Window.partitionBy("vec").orderBy(pos)
    marked = with_vector(df, pos).withColumn("__new", F.when((F.row_number().over(w) == 1) | ~F.col(val).eqNullSafe(F.lag(val).over(w)), 1).otherwise(0))
    indexed = marked.withColumn("run_idx", F.sum("__new").over(w) - 1)
    return indexed.where("__new = 1").select("vec", "run_idx", val), indexed.select(pos, "vec", "run_idx")


def rle_map_decode(values: DataFrame, index: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    return index.join(values, ["vec", "run_idx"]).select(pos, val)


def dict_encode(df: DataFrame, pos: str = "pos", val: str = "val") -> tuple[DataFrame, DataFrame]:
    """The sorted distinct values with codes 0.., and the code of each position (NULL for NULL).

    The values are ranked by ranges of them, so any number will do: each range
    is sorted by itself, and only the ranges' sizes meet in one place.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = df.where(F.col(val).isNotNull()).select(val).distinct().repartitionByRange(n, val).sortWithinPartitions(val)
    keys = materialize(keys.withColumn("__id", F.monotonically_increasing_id()), "dict-keys")  # the range's number is in the upper bits
    of_range, rank = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = keys.groupBy(of_range.alias("__range")).count()
    before = sizes.select("__range", (F.sum("count").over(Window.orderBy("__range")) - F.col("count")).alias("__before"))  # a row a range
    keys = keys.withColumn("__range", of_range).join(F.broadcast(before), "__range").select(val, (F.col("__before") + rank).alias("code"))
    return keys, df.join(keys, val, "left").select(pos, "code")


def dict_decode(keys: DataFrame, codes: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    return codes.join(keys, "code", "left").select(pos, val)


def frequency_encode(df: DataFrame, pos: str = "pos", val: str = "val") -> tuple[DataFrame, DataFrame]:
    """The most frequent value (the smallest of several) and the rows that hold another."""
    top = df.groupBy(val).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(val)).limit(1).select(F.col(val).alias("top_val"))
    return top, df.join(F.broadcast(top)).where(~F.col(val).eqNullSafe(F.col("top_val"))).select(pos, val)


def frequency_decode(top: DataFrame, exceptions: DataFrame, n: int, pos: str = "pos", val: str = "val") -> DataFrame:
    """``n`` positions of the frequent value, but for the exceptions."""
    every = df_range(top, n, pos).join(F.broadcast(top))
    held = exceptions.select(pos, F.col(val).alias("__e"), F.lit(True).alias("__x"))
    return every.join(held, pos, "left").select(pos, F.when(F.col("__x"), F.col("__e")).otherwise(F.col("top_val")).alias(val))


def df_range(like: DataFrame, n: int, pos: str) -> DataFrame:
    return like.sparkSession.range(n).withColumnRenamed("id", pos)


def bits(span: Column) -> Column:
    """Bits that hold 0..span, exactly."""
    return F.when(span <= 0, 0).otherwise(F.length(F.bin(span.cast("bigint")))).cast("bigint")


def for_encode(df: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    """Frame of reference per vector: base and bits of the offsets."""
    return with_vector(df, pos).groupBy("vec").agg(F.min(val).alias("base"), bits(F.max(val) - F.min(val)).alias("bit_width"), F.count(F.lit(1)).alias("n"))


def for_offsets(df: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    w = Window.partitionBy("vec")
    return with_vector(df, pos).withColumn("base", F.min(val).over(w)).select(pos, "vec", "base", (F.col(val) - F.col("base")).alias("offset"))


def for_decode(offsets: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    return offsets.select(pos, (F.col("base") + F.col("offset")).alias(val))


def _patched(df: DataFrame, share: float, pos: str, val: str) -> DataFrame:
    """Offsets with the width that ``share`` of a vector's offsets need."""
    off = for_offsets(df, pos, val).withColumn("width", bits(F.col("offset")))
    cap = off.groupBy("vec").agg(F.expr(f"percentile_disc({share}) within group (order by width)").cast("bigint").alias("cap"))
    return off.join(cap, "vec")


def patched_exceptions(df: DataFrame, share: float = 0.95, pos: str = "pos", val: str = "val") -> DataFrame:
    """Offsets wider than the width that ``share`` of a vector's offsets need, with their places."""
    return _patched(df, share, pos, val).where(F.col("width") > F.col("cap")).select("vec", pos, "cap", "offset")


def patched_encode(df: DataFrame, share: float = 0.95, pos: str = "pos", val: str = "val") -> tuple[DataFrame, DataFrame]:
    """Per position the vector's base and width and the lowest bits of the offset; and the bits above them of wider offsets."""
    off = _patched(df, share, pos, val)
    low = F.expr("CAST(offset AS bigint) & (shiftleft(1L, CAST(cap AS int)) - 1)")
    high = F.expr("shiftrightunsigned(CAST(offset AS bigint), CAST(cap AS int))")
    return off.select(pos, "vec", "base", "cap", low.alias("low")), off.where(F.col("width") > F.col("cap")).select(pos, high.alias("high"))


def patched_decode(packed: DataFrame, patches: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    whole = F.col("low") + F.coalesce(F.expr("shiftleft(high, CAST(cap AS int))"), F.lit(0))
    return packed.join(patches, pos, "left").select(pos, (F.col("base") + whole).alias(val))


def constant_vectors(df: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    """Vectors that hold one value throughout."""
    g = with_vector(df, pos).groupBy("vec").agg(F.min(val).alias("val"), F.max(val).alias("__hi"), F.count(val).alias("__n"), F.count(F.lit(1)).alias("n"))
    return g.where((F.col("val") == F.col("__hi")) & (F.col("__n") == F.col("n"))).select("vec", "val", "n")


def constant_encode(df: DataFrame, pos: str = "pos", val: str = "val") -> tuple[DataFrame, DataFrame]:
    """Vectors of one value as their first position, length and value; and the rows of all others."""
    rows = with_vector(df, pos)
    g = rows.groupBy("vec").agg(F.min(pos).alias("first"), F.count(F.lit(1)).alias("n"), F.min(val).alias("val"), F.max(val).alias("__hi"), F.count(val).alias("__n"))
    constant = g.where((F.col("val") == F.col("__hi")) & (F.col("__n") == F.col("n"))).select("vec", "first", "n", "val")
    return constant, rows.join(constant.select("vec"), "vec", "left_anti").select(pos, val)


def constant_decode(constant: DataFrame, rest: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    return constant.select(F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias(pos), F.col("val").alias(val)).unionByName(rest)


def _least_exponent(x: Column, most: int) -> Column:
    least = F.lit(-1)
    for e in range(most, -1, -1):
        scale = F.lit(float(10**e))
        least = F.when(F.round(x * scale) / scale == x, F.lit(e)).otherwise(least)
    return least


def alp_exponent(df: DataFrame, pos: str = "pos", val: str = "val", most: int = 10) -> DataFrame:
    """Per vector, the least e with round(x * 10^e) / 10^e = x for all its numbers; -1 if none up to ``most``."""
    per_row = with_vector(df, pos).withColumn("__e", _least_exponent(F.col(val), most))
    return per_row.groupBy("vec").agg(F.when(F.min("__e") < 0, -1).otherwise(F.max("__e")).cast("bigint").alias("exponent"))


def alp_encode(df: DataFrame, pos: str = "pos", val: str = "val", most: int = 10) -> tuple[DataFrame, DataFrame]:
    """Numbers as whole ``digits`` over a power of ten of their vector; and those that are none, with NULLs, as they are."""
    rows = with_vector(df, pos).withColumn("__e", _least_exponent(F.col(val), most))
    exponent = rows.groupBy("vec").agg(F.greatest(F.max("__e"), F.lit(0)).alias("exponent"))
    rows = rows.join(exponent, "vec")
    scale = F.pow(F.lit(10.0), F.col("exponent"))
    digits = F.round(F.col(val) * scale)
    # 2^53: beyond it doubles skip whole numbers. A zero with a sign isn't the digit 0.
    exact = F.coalesce((digits / scale == F.col(val)) & (F.abs(digits) < float(1 << 53)) & ~((F.col(val) == 0) & F.col(val).cast("string").startswith("-")), F.lit(False))
    return rows.where(exact).select(pos, "vec", "exponent", digits.cast("bigint").alias("digits")), rows.where(~exact).select(pos, val)


def alp_decode(packed: DataFrame, exceptions: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    number = F.col("digits").cast("double") / F.pow(F.lit(10.0), F.col("exponent"))
    return packed.select(pos, number.alias(val)).unionByName(exceptions)


def uncompressed_bytes(df: DataFrame, pos: str = "pos", val: str = "val") -> DataFrame:
    """Plain size of a text column per vector."""
    return with_vector(df, pos).groupBy("vec").agg(F.sum(F.octet_length(val)).cast("bigint").alias("n_bytes"))


def transpose_lanes(df: DataFrame, lanes: int = 32, pos: str = "pos", val: str = "val", rows: int | None = None) -> DataFrame:
    """Each full vector seen as rows of ``lanes`` values and turned: a permutation of positions.

    With ``rows``, the column's length, a last vector that isn't full stays as it is.
    """
    p = F.col(pos) % VECTOR
    turned = F.col(pos) - p + (p % lanes) * (VECTOR // lanes) + F.floor(p / lanes)
    if rows is not None:
        turned = F.when(F.col(pos) < rows // VECTOR * VECTOR, turned).otherwise(F.col(pos))
    return df.select(turned.cast("bigint").alias(pos), val)


def untranspose_lanes(df: DataFrame, lanes: int = 32, pos: str = "pos", val: str = "val", rows: int | None = None) -> DataFrame:
    return transpose_lanes(df, VECTOR // lanes, pos, val, rows)


def symbol_table(df: DataFrame, val: str = "val", size: int = 255) -> DataFrame:
    """The ``size`` two-character symbols that would save most bytes, ties by symbol."""
    grams = df.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(val) - 1, F.lit(1))), lambda i: F.substring(F.col(val), i, F.lit(2)))).alias("symbol"))
    return grams.where(F.length("symbol") == 2).groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "symbol").limit(size)


def real_split(df: DataFrame, left_bits: int = 16, val: str = "val") -> DataFrame:
    """Doubles cut into the left bits, of few distinct values, and the rest.

    Spark has no expression for the bits of a double, so this one analyzer is an Arrow batch function.
    """

    def split(batches):
        for batch in batches:
            raw = batch[val].to_numpy(dtype="float64").view("uint64")
            yield pd.DataFrame({val: batch[val], "left_part": (raw >> np.uint64(64 - left_bits)).astype("int64"), "right_part": (raw & np.uint64((1 << (64 - left_bits)) - 1)).astype("int64")})

    return df.select(val).mapInPandas(split, f"{val} double, left_part long, right_part long")


def real_glue(parts: DataFrame, left_bits: int = 16, val: str = "val") -> DataFrame:
    """The doubles that ``real_split`` has cut."""

    def glue(batches):
        for batch in batches:
            raw = (batch["left_part"].to_numpy("uint64") << np.uint64(64 - left_bits)) | batch["right_part"].to_numpy("uint64")
            yield pd.DataFrame({val: raw.view("float64")})

    return parts.mapInPandas(glue, f"{val} double")


def duplicate_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Pairs of columns that are equal on every row, in one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    sums = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"{a}\x1f{b}") for a, b in pairs])
    stacked = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}\x1f{b}`").alias("equal")) for a, b in pairs])
    return sums.select(F.inline(stacked)).where("equal").select("col_a", "col_b")
