"""granary: typed columnar tables on Spark, with every scan, sink, statistic and encoding expressed as DataFrames."""

from granary.operators.compare import compare_roundtrip
from granary.sources.reader import read_table
from granary.sources.writer import write_table

__all__ = ["compare_roundtrip", "read_table", "write_table"]
