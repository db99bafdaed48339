"""``write_table``: rows to columnar files, with row groups, file rotation and ordered or parallel writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.types import reject_nulls
from granary.sources.metadata import file_heads
from granary.sources.reader import read_table

OPTIONS = {"row_group_size", "row_groups_per_file", "inline_footer", "preserve_order", "nulls", "mode", "partitions"}
ROW_GROUP_SIZE = 65_536
BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
TEXT_BYTES = 32
#: Bytes below which no row group is cut for its size; the row count cuts it.
GROUP_BYTES = 128 << 20


def _options(given: dict) -> dict:
    out = {}
    for key, value in given.items():
        name = key.lower()
        if name not in OPTIONS:
            raise ValueError(f"unrecognized option {key!r}; known: {', '.join(sorted(OPTIONS))}")
        if isinstance(value, (list, tuple)):
            if len(value) != 1:
                raise ValueError(f"option {name} takes one value")
            value = value[0]
        if value is None:
            raise ValueError(f"option {name} must not be NULL")
        if name in ("row_group_size", "row_groups_per_file", "partitions") and (isinstance(value, bool) or not isinstance(value, int) or value < (name != "row_groups_per_file")):
            raise ValueError(f"{name} must be a whole number from {int(name != 'row_groups_per_file')}")
        if name == "nulls" and value not in ("preserve", "reject"):
            raise ValueError("nulls is 'preserve' or 'reject'")
        out[name] = value
    return out


def row_bytes(df: DataFrame) -> int:
    """A rough width of a row, to size row groups that storage measures in bytes."""
    return sum(BYTES.get(f.dataType.simpleString(), TEXT_BYTES) for f in df.schema.fields) or 1


def _in_order(df: DataFrame, partitions: int) -> DataFrame:
    """The rows in as many partitions, in the order of the frame's own and of the rows in them; merging whole ones would follow where they lie."""
    name = "__place"
    dealt = df.withColumn(name, F.monotonically_increasing_id()).repartitionByRange(partitions, name)
    return dealt.sortWithinPartitions(name).drop(name)


def write_table(df: DataFrame, path: str, **given) -> None:
    """Write ``df`` below ``path``.

    row_group_size: rows to a row group at most; a file's groups have just as
        many, but for its last one.
    row_groups_per_file: rotate to a new file after so many groups (0: never).
    partitions: number of parallel write tasks; each rotates its own files.
    preserve_order: keep the frame's order in file-name order (the default). The
        frame's own partitioning is kept, whose order is that of part numbers;
        with partitions given, rows are dealt anew by their place in it.
        False deals rows evenly over tasks, as Spark sees fit.
    nulls: 'preserve', or 'reject' to fail at the first NULL.
    inline_footer: False also writes a manifest of the files beside them.
    """
    options = _options(given)
    size, per_file = options.get("row_group_size", ROW_GROUP_SIZE), options.get("row_groups_per_file", 0)
    if options.get("nulls", "preserve") == "reject":
        df = reject_nulls(df)
    if "partitions" in options:
        ordered = options.get("preserve_order", True)
        df = _in_order(df, options["partitions"]) if ordered else df.repartition(options["partitions"])
    elif not options.get("preserve_order", True):
        df = df.hint("rebalance")
    writer = df.write.mode(options.get("mode", "errorifexists")).option("parquet.block.row.count.limit", size)
    writer = writer.option("parquet.block.size", max(GROUP_BYTES, 2 * size * row_bytes(df)))
    if per_file:
        writer = writer.option("maxRecordsPerFile", size * per_file)
    writer.parquet(path)
    if not options.get("inline_footer", True):
        spark = df.sparkSession
        rows = [(h["file"], int(h["row_count"]), int(h["n_row_groups"]), json.dumps(h["columns"])) for h in file_heads(spark, [path])]
        spark.createDataFrame(rows, "file string, row_count long, n_row_groups long, columns string").coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")


def append_from(spark: SparkSession, path: str, paths: str | list[str], **given) -> None:
    """Append the rows of other tables' files to the table at ``path``, with its columns by name, in its types."""
    here = read_table(spark, path)
    rows = read_table(spark, paths, union_by_name=True)
    missing = [c for c in here.columns if c not in rows.columns]
    if missing:
        raise ValueError(f"the files lack {', '.join(missing)}")
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in here.schema.fields]
    write_table(rows.select(*columns), path, **given, mode="append")
