"""Structured Streaming over the same tables."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from granary.session import scratch_path, setting
from granary.sources.reader import read_table
from granary.sources.writer import write_table

#: Keeps state on the executors' disks, with bounded memory in front; Spark's own default holds all of it in their heaps.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}


def stream_table(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A table folder as a stream of its files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def tumbling_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per key and window; rows later than ``late`` behind the watermark are left out."""
    return sliding_counts(events, ts, key, width, width, late)


def sliding_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", step: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows per key and window of ``width``, one every ``step``."""
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, width, step).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), key, "n")


def session_counts(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows per key and session; a session ends when ``gap`` passes without a row."""
    counted = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")


def distinct_rows(events: DataFrame, ts: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first row of each key; what is remembered goes when the watermark has passed it."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def running_totals(events: DataFrame, key: str, value: str) -> DataFrame:
    """After each micro-batch, of each key that it holds: the rows and the greatest value so far, kept as state."""

    def advance(name: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, most = state.get if state.exists else (0, None)
        for batch in batches:
            n += len(batch)
            top = batch[value].max()
            if not pd.isna(top):
                most = top if most is None else max(most, top)
        state.update((n, most))
        yield pd.DataFrame({key: [name[0]], "n": [n], "most": [most]})

    kinds = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    state = f"n long, most {kinds[value]}"
    return events.select(key, value).groupBy(key).applyInPandasWithState(advance, f"`{key}` {kinds[key]}, {state}", state, "update", GroupStateTimeout.NoTimeout)


def append_table(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Write every micro-batch as ``write_table`` would, with its options, once what has arrived is done.

    A batch has a folder of its own, which a repeated batch writes over, so each
    row arrives once.
    """
    if "mode" in {k.lower() for k in options}:
        raise ValueError("mode: batches are always added")

    def add(batch: DataFrame, number: int) -> None:
        write_table(batch, f"{path}/batch-{number:012d}", mode="overwrite", **options)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, mode: str) -> DataFrame:
    """The rows that a stream gives until what has arrived is done, as a table in the shared folder: none pass through the driver.

    In mode 'complete' they are those of the last micro-batch, in 'append' and
    'update' those of all. A stream of nothing gives no rows.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, "stream-rows"), scratch_path(spark, "stream-state")
    ran: list[int] = []

    def add(batch: DataFrame, number: int) -> None:
        name = "all" if mode == "complete" else f"batch-{number:012d}"
        write_table(batch, f"{path}/{name}", mode="overwrite")
        ran.append(number)

    with contextlib.ExitStack() as settings:
        for name, value in STATE.items():
            settings.enter_context(setting(spark, name, value))
        stream.writeStream.foreachBatch(add).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_table(spark, path) if ran else spark.createDataFrame([], stream.schema)
