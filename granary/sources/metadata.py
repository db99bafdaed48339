"""Footers of a table's files: schemas, exact counts and min/max statistics without reading rows.

Few files are looked at from the driver; many are dealt to executors, one
footer per row of a small DataFrame, and only the digest comes back.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.types import logical_name

DRIVER_FILES = 64
STATS_SCHEMA = "file string, row_group long, row_start long, row_count long, column_name string, min_value string, max_value string, null_count long"
HEAD_SCHEMA = "file string, row_count long, n_row_groups long, columns string"
MULTI_FILE_FLOOR = 42


def list_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """All data files below the paths (globs allowed), in path order, through Spark's own listing."""
    return sorted(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths).inputFiles())


def _open(uri: str) -> pq.ParquetFile:
    system, path = fs.FileSystem.from_uri(uri)
    return pq.ParquetFile(system.open_input_file(path))


def _heads(batches):
    for batch in batches:
        rows = []
        for uri in batch["file"]:
            with _open(uri) as f:
                columns = [[x.name, logical_name(x.type)] for x in f.schema_arrow]
                rows.append((uri, f.metadata.num_rows, f.metadata.num_row_groups, json.dumps(columns)))
        yield pd.DataFrame(rows, columns=["file", "row_count", "n_row_groups", "columns"])


def _as_text(value) -> str | None:
    return None if value is None else value.isoformat() if hasattr(value, "isoformat") else str(value)


def _stats(batches):
    for batch in batches:
        rows = []
        for uri in batch["file"]:
            with _open(uri) as f:
                start = 0
                for g in range(f.metadata.num_row_groups):
                    group = f.metadata.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        s = chunk.statistics
                        known = s is not None and s.has_min_max
                        rows.append((uri, g, start, group.num_rows, chunk.path_in_schema, _as_text(s.min) if known else None, _as_text(s.max) if known else None, s.null_count if s is not None and s.has_null_count else None))
                    start += group.num_rows
        yield pd.DataFrame(rows, columns=["file", "row_group", "row_start", "row_count", "column_name", "min_value", "max_value", "null_count"])


def _over_files(spark: SparkSession, files: list[str], function, schema: str) -> DataFrame:
    frame = pd.DataFrame({"file": files})
    if len(files) <= DRIVER_FILES:
        return spark.createDataFrame(pd.concat(function([frame])), schema)
    return spark.createDataFrame(frame).repartition(min(len(files), 512)).mapInPandas(function, schema)


def manifest(spark: SparkSession, path: str, files: list[str]) -> DataFrame | None:
    """The manifest that was written beside a table's files, if there is one and it names just these files."""
    where = f"{path.rstrip('/')}/_manifest"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(where)
    if "*" in path or not hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path):
        return None
    rows = spark.read.schema(HEAD_SCHEMA).json(where)
    told = rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("file"))).first()
    here = spark.createDataFrame([(f,) for f in files], "file string").agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("file"))).first()
    return rows if told == here else None


def schema_heads(spark: SparkSession, paths: list[str]) -> list[dict]:
    """One head for each distinct schema: its first file, and the sums over its files. No row per file comes to the driver."""
    files = list_files(spark, paths)
    rows = manifest(spark, paths[0], files) if len(paths) == 1 else None
    if rows is None and len(files) <= DRIVER_FILES:
        return file_heads(spark, paths)
    rows = rows if rows is not None else _over_files(spark, files, _heads, HEAD_SCHEMA)
    kinds = rows.groupBy("columns").agg(F.min("file").alias("file"), F.sum("row_count").alias("row_count"), F.sum("n_row_groups").alias("n_row_groups")).collect()
    return [r.asDict() | {"columns": json.loads(r["columns"])} for r in sorted(kinds, key=lambda r: r["file"])]


def file_heads(spark: SparkSession, paths: list[str]) -> list[dict]:
    """Per file: name, row count, number of row groups, and (column, logical type) pairs."""
    files = list_files(spark, paths)
    written = manifest(spark, paths[0], files) if len(paths) == 1 else None
    if written is not None:
        rows = [r.asDict() for r in written.toLocalIterator()]
    elif len(files) <= DRIVER_FILES:
        rows = pd.concat([pd.DataFrame(columns=["file", "row_count", "n_row_groups", "columns"]), *_heads([pd.DataFrame({"file": files})])]).to_dict("records")
    else:
        rows = [r.asDict() for r in _over_files(spark, files, _heads, HEAD_SCHEMA).toLocalIterator()]
    return [r | {"columns": json.loads(r["columns"])} for r in sorted(rows, key=lambda r: r["file"])]


def row_group_stats(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per file, row group and column, values as text; none read from the data itself."""
    return _over_files(spark, list_files(spark, list(paths)), _stats, STATS_SCHEMA)


def partition_stats(spark: SparkSession, *paths: str) -> DataFrame:
    """Exact row count and first row of every row group."""
    return row_group_stats(spark, *paths).select("file", "row_group", "row_start", "row_count").distinct()


def table_stats(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Merged min/max per column over all row groups; ``columns`` maps a name to the type to compare in."""
    stats = row_group_stats(spark, path).where(F.col("column_name").isin(list(columns)))
    sums = []
    for i, kind in enumerate(columns.values()):
        sums += [F.min(F.col("min_value").try_cast(kind)).cast("string").alias(f"lo{i}"), F.max(F.col("max_value").try_cast(kind)).cast("string").alias(f"hi{i}")]
    merged = stats.groupBy("column_name").agg(*sums, F.sum("null_count").alias("null_count"), F.sum("row_count").alias("row_count"))
    pick = lambda side: F.coalesce(*[F.when(F.col("column_name") == name, F.col(f"{side}{i}")) for i, name in enumerate(columns)])
    return merged.select("column_name", pick("lo").alias("min_value"), pick("hi").alias("max_value"), "null_count", "row_count")


def file_starts(spark: SparkSession, *paths: str) -> DataFrame:
    """The number of rows in the files before each one, in path order, and its rank: (file, file_index, first_row)."""
    at, rows = 0, []
    for i, h in enumerate(file_heads(spark, list(paths))):
        rows.append((path_of(h["file"]), i, at))
        at += int(h["row_count"])
    return spark.createDataFrame(rows, "file string, file_index long, first_row long")


def path_of(uri: str) -> str:
    """A file's path below its store's root, as ``file_path`` has it but for how the store is written."""
    return "/" + unquote(uri).split(":", 1)[-1].lstrip("/")


def count_exact(spark: SparkSession, *paths: str) -> int:
    """The exact row count, from footers alone."""
    return sum(int(h["row_count"]) for h in file_heads(spark, list(paths)))


def estimate_cardinality(spark: SparkSession, *paths: str, explicit: int | None = None) -> int:
    """Planner estimate: the stated one; else exact for one file; else first file's count times files, with a floor."""
    if explicit is not None:
        return explicit
    files = list_files(spark, list(paths))
    if not files:
        return 0
    first = int(next(iter(_heads([pd.DataFrame({"file": files[:1]})])))["row_count"][0])
    return first if len(files) == 1 else max(first, MULTI_FILE_FLOOR) * len(files)
