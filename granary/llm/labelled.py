"""Bounded samples of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import fold_held_out


def sampled(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows of the learning folds, by the hash order of their ids: the same ones whatever the partitioning."""
    return rows.where(F.col(id_col).isNotNull() & ~fold_held_out(id_col)).orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)).limit(most)
