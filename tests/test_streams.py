"""Streams write what they give to tables."""

import pytest
from pyspark.sql import functions as F

from granary.plans import relational  # noqa: F401
from granary.plans.tables import QUERIES
from granary.session import scratch_path
from granary.sources.writer import write_table
from granary.streaming import run_to_table, session_counts, stream_table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["stream_session_counts", "stream_tumbling_counts", "stream_running_totals", "stream_distinct", "stream_static_join"])
def test_rows_of_a_stream_are_in_files(spark, name):
    """Failed while a memory sink held every row on the driver."""
    df = QUERIES[name](spark, SF)
    assert "MemoryPlan" not in df._jdf.queryExecution().toString()
    assert df.inputFiles()


def test_sessions_over_micro_batches(spark):
    """Files come in no set order, so rows may be a day late. Complete mode gives the last micro-batch's rows, each once; a stream of no rows gives none."""
    path = scratch_path(spark, "sessions")
    rows = spark.range(600).select((F.lit(1_700_000_000) + F.col("id") * 60 + F.when(F.col("id") >= 300, 7200).otherwise(0)).cast("timestamp").alias("ts"), (F.col("id") % 3).alias("user"))
    write_table(rows.repartitionByRange(4, "ts"), path)
    got = run_to_table(session_counts(stream_table(spark, path, rows.schema, 1), "ts", "user", late="1 day"), "complete")
    assert sorted((r.user, r.n) for r in got.collect()) == [(u, 100) for u in range(3) for _ in range(2)]
    empty = scratch_path(spark, "sessions")
    write_table(rows.limit(0), empty)
    none = run_to_table(session_counts(stream_table(spark, empty, rows.schema), "ts", "user"), "complete")
    assert none.collect() == [] and none.columns == got.columns
