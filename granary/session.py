"""Session helpers: defaults for local use and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
import weakref
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("granary")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Makes Spark delete an execution's shuffle files when it ends, rather than when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_LOCK = threading.Lock()
_HELD: Counter = Counter()
_BEFORE: dict[tuple[int, str], str | None] = {}
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block; of several blocks at once, in threads too, the last to end puts back what was."""
    key = (id(spark), name)
    with _LOCK:
        if not _HELD[key]:
            _BEFORE[key] = spark.conf.get(name, None)
            spark.conf.set(name, value)
        _HELD[key] += 1
    try:
        yield
    finally:
        with _LOCK:
            _HELD[key] -= 1
            if not _HELD[key]:
                before = _BEFORE.pop(key)
                if before is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a local
    folder is made, and set as the checkpoint folder of this session; on a
    cluster that is an error, as executors wouldn't see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="granary-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, not yet made, below the shared folder."""
    return f"{scratch_root(spark)}/granary/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The copy survives the loss of any executor, unlike a local checkpoint. The
    shuffle files of the write go with it: nothing reads them once it is done.
    Who knows that nothing will read the copy again may ``discard`` it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``materialize`` gave, once all that reads them has run."""
    for df in frames:
        path = _PATHS.pop(df, None)
        if path is not None:
            remove_path(df.sparkSession, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
