"""``read_table``: one or many files as one DataFrame, with row numbers, strict or merged schemas, and widening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.types import promote, storage_name
from granary.sources.metadata import file_starts, schema_heads

OPTIONS = {"union_by_name", "file_row_number", "filename", "file_index", "table_row_number", "explicit_cardinality", "widen"}
BROADCAST_ROWS = 100_000


class SchemaMismatch(ValueError):
    """A file lacks a column of the first file, and the scan isn't by union of names."""


def _options(given: dict) -> dict:
    out = {}
    for key, value in given.items():
        name = key.lower()
        if name not in OPTIONS:
            raise ValueError(f"unknown option {key!r}; known: {', '.join(sorted(OPTIONS))}")
        if value is None:
            raise ValueError(f"option {name} must not be NULL")
        if name == "explicit_cardinality" and (isinstance(value, bool) or not isinstance(value, int) or value < 0):
            raise ValueError("explicit_cardinality must be a whole number from 0")
        out[name] = value
    return out


def bound_options(**given) -> dict:
    """What a scan with these options is bound to: all options, those not given with their defaults."""
    defaults = {name: name == "widen" for name in OPTIONS if name != "explicit_cardinality"}
    return defaults | {"explicit_cardinality": None} | _options(given)


def merged_schema(heads: list[dict], union_by_name: bool, widen: bool = True) -> T.StructType:
    """The schema of the scan: names of the first file (strict) or of all files (union), types widened over files."""
    if not heads:
        raise ValueError("no data files")
    kinds: dict[str, str] = {}
    names = [n for n, _ in heads[0]["columns"]]
    for head in heads:
        here = dict(head["columns"])
        missing = [n for n in names if n not in here] if not union_by_name else []
        if missing:
            raise SchemaMismatch(f"{head['file']} lacks {', '.join(missing)}")
        for name, kind in here.items():
            if name not in kinds:
                if union_by_name and name not in names:
                    names.append(name)
                kinds[name] = kind
            elif kind != kinds[name] and name in names:
                if not widen:
                    raise SchemaMismatch(f"{head['file']}: {name} is {kind}, before it was {kinds[name]}")
                kinds[name] = kinds[name] if kind.startswith("decimal") and kinds[name].startswith("decimal") else promote(kinds[name], kind)
    return T.StructType.fromDDL(", ".join(f"`{n}` {storage_name(kinds[n])}" for n in names))


def read_table(spark: SparkSession, paths: str | list[str], **given) -> DataFrame:
    """Scan a table.

    union_by_name: the columns of all files, NULL where a file lacks one;
        otherwise the first file's columns, and a file that lacks one is an error.
    file_row_number: append the 0-based position of the row in its file.
    filename, file_index: append the file's path, or its rank in path order.
    table_row_number: append the 0-based position in the table, files in path order.
    widen: hold a column in the type that covers all files (default true).
    explicit_cardinality: rows to plan with; small ones become a broadcast hint.

    Columns, filters and row-group skipping reach the scan through Catalyst.
    ``file_row_number()`` can be selected from any scan, also without the option.
    """
    options = _options(given)
    paths = [paths] if isinstance(paths, str) else list(paths)
    heads = schema_heads(spark, paths)
    schema = merged_schema(heads, options.get("union_by_name", False), options.get("widen", True))
    kinds = {tuple(map(tuple, h["columns"])) for h in heads}
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    df = (reader if len(kinds) == 1 else reader.schema(schema)).parquet(*paths)
    out = [F.col(f"`{n}`") for n in schema.names]
    if options.get("file_row_number"):
        out.append(F.col("_metadata.row_index").alias("file_row_number"))
    if options.get("filename"):
        out.append(F.col("_metadata.file_path").alias("filename"))
    ranked = [n for n in ("file_index", "table_row_number") if options.get(n)]
    if ranked:
        # A row per file; joined by the whole path, as files in several folders may share a name.
        starts = file_starts(spark, *paths)
        starts = F.broadcast(starts) if len(df.inputFiles()) <= BROADCAST_ROWS else starts
        path = F.concat(F.lit("/"), F.regexp_replace("_metadata.file_path", "^([A-Za-z0-9+.-]+:)?/*", ""))
        df = df.select(*out, path.alias("__file"), F.col("_metadata.row_index").alias("__row")).join(starts, F.col("__file") == F.col("file"))
        number = F.col("first_row") + F.col("__row")
        extra = {"file_index": F.col("file_index"), "table_row_number": number.alias("table_row_number")}
        df = df.select(*[F.col(f"`{n}`") for n in df.columns[: len(out)]], *[extra[n] for n in ranked])
    elif len(out) > len(schema.names) or len(kinds) > 1:
        df = df.select(*out)
    if options.get("explicit_cardinality", BROADCAST_ROWS + 1) <= BROADCAST_ROWS and sum(int(h["row_count"]) for h in heads) <= BROADCAST_ROWS:
        df = df.hint("broadcast")  # the stated size is checked against the footers first
    return df


def file_row_number() -> Column:
    """The 0-based position of a row in its file, from any scan; SQL finds it as ``_metadata.row_index``."""
    return F.col("_metadata.row_index").alias("file_row_number")


def create_view(spark: SparkSession, name: str, paths: str | list[str], **given) -> DataFrame:
    """A temporary view over a scan, for SQL."""
    df = read_table(spark, paths, **given)
    df.createOrReplaceTempView(name)
    return df
