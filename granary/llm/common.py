"""What the operators share: batches in and out of Arrow, folds, and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import weakref
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import discard, materialize

#: Bytes of text that one step of a Python worker holds at a time.
STEP_BYTES = 3 << 20


def bounded_batches(spark: SparkSession, rows: int = 250) -> None:
    """Fewer rows to an Arrow batch, for this session, where it names no number: batches of whole texts are held off-heap more than once.

    The setting is read when a frame runs, which is after the call that made it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    unset = "-987654321"  # given back where the session names none
    if spark.conf.get(name, unset) == unset:
        spark.conf.set(name, str(rows))


#: Bytes of input, by Spark's estimate, that a partition is to stand for.
PARTITION_BYTES = 128 << 20


def partitions_of(df: DataFrame) -> int:
    """Shuffle partitions for work on ``df``: the session's number, or more where the tables that it reads are large."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    size = sum(x for x in sizes if x < 1 << 60)  # others are rows in memory, whose size Spark doesn't know
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PARTITION_BYTES)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold_held_out(id_col: str) -> Column:
    """True for rows of the held-out fold; a null id belongs to none."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def steps(batches: Iterable[pa.RecordBatch], text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in steps whose texts hold up to ``limit`` bytes, but for longer single rows; small batches are put together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        total = np.cumsum(_lengths(batch.column(text)))
        if size + total[-1] <= limit:
            held.append(batch)
            size += int(total[-1])
            continue
        if held:
            yield pa.concat_batches(held)
            held, size = [], 0
        if total[-1] <= limit:
            held, size = [batch], int(total[-1])
            continue
        i = 0
        while i < n:
            base = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(i, j - i)
            i = j
    if held:
        yield pa.concat_batches(held)


def _lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; a null has none."""
    return pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - (np.cumsum(lengths) - lengths)
    kind = np.int32 if total < 1 << 30 and int(starts.max()) < 1 << 30 else np.int64  # half the memory where it holds
    out = np.repeat(shift.astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


#: Words whose values are copied at a time: their indices stay in a core's cache.
GATHERED = 1 << 14


class WordCache:
    """Numbers for words seen so far, and a flat store of what was computed for each.

    ``compute(words)`` gives (flat values, lengths) for new words. The cache
    forgets everything when it holds more than ``limit`` words, so its memory is
    bounded whatever the corpus.
    """

    def __init__(self, compute, dtype, limit: int = 400_000):
        self.compute, self.dtype, self.limit = compute, dtype, limit
        self._clear()
        _CACHES.add(self)

    def _clear(self) -> None:
        self.number: dict = {}
        self.flat = np.zeros(1 << 16, self.dtype)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)

    def lookup(self, words: list) -> np.ndarray:
        """The number of each word; new words are computed together."""
        if len(self.number) > self.limit:
            self._clear()
        get = self.number.get
        got = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(got < 0)
        if len(unknown):
            missed = [words[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(missed))
            flat, lengths = self.compute(new)
            self._append(new, np.asarray(flat, self.dtype), np.asarray(lengths, np.int64))
            got[unknown] = np.fromiter(map(get, missed), np.int64, len(missed))
        return got

    def _append(self, new: list, flat: np.ndarray, lengths: np.ndarray) -> None:
        base, n = len(self.number), len(new)
        if base + n > len(self.starts):
            room = max(2 * len(self.starts), base + n)
            self.starts, self.lengths = np.resize(self.starts, room), np.resize(self.lengths, room)
        if self.used + len(flat) > len(self.flat):
            grown = np.zeros(max(2 * len(self.flat), self.used + len(flat)), self.dtype)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[base : base + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[base : base + n] = lengths
        self.used += len(flat)
        self.number.update(zip(new, range(base, base + n), strict=True))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        out = np.empty(int(ends[-1]) if len(ends) else 0, self.flat.dtype)
        for i in range(0, len(numbers), GATHERED):
            some = slice(i, i + GATHERED)
            at = ragged(self.starts[numbers[some]], lengths[some])
            out[ends[i] - lengths[i] :][: len(at)] = self.flat[at]
        return out, lengths


_CACHES: weakref.WeakSet[WordCache] = weakref.WeakSet()
#: Called with a task's own caches; each lets go what other tasks have left, and says whether there was any.
STORES: list[Callable[[tuple[WordCache, ...]], bool]] = []


def claim(*own: WordCache, tidy: bool = True) -> None:
    """Called as a task begins: a Python worker serves task after task, so empty the caches that this one doesn't use and give freed memory back.

    With ``tidy`` False, only where a cache was emptied.
    """
    others = [c for c in _CACHES if all(c is not o for o in own) and c.number]
    for c in others:
        c._clear()
    freed = [let_go(own) for let_go in STORES]
    if not tidy and not others and not any(freed):
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def letting_go(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and at its end nothing is kept: of two functions in one stage each has a worker, and all workers of an executor wait with what they hold, and take turns."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            claim()

    return wrapped


def chained(*runs: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One function that runs each on what the one before gives, in one worker: each Python function of a stage has a worker a core of its own, and workers stay."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in runs:
            batches = one(batches)
        yield from batches

    return letting_go(run)


def union_min(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b the smallest node of each one's component."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition to the smallest node that they reach in each batch: no path is lost, repeats go."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = nodes[union_min(len(nodes), index[: len(a)], index[len(a) :])]
        own = root != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(root[own])], names=["src", "dst"])


def forests(links: DataFrame) -> DataFrame:
    """Links (src, dst) by which the same nodes reach each other, fewer where many are repeated or lead back."""
    return links.mapInArrow(letting_go(forest), "src long, dst long")


def connected_components(links: DataFrame, label: str, *, reduced: bool = False) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches; nodes are longs.

    ``links`` has long columns src and dst; nodes without a link to another
    don't appear. With ``reduced``, links that a Python function made are
    forests already, and no second function follows it. Large-star and small-star steps alternate until nothing
    moves. Every step is an aggregate and an equi-join whose larger side Spark
    can split, so a hub with many neighbours isn't gathered in one task, and
    every round is written to the shared folder.
    """
    edges = links.where("src <> dst").selectExpr("greatest(src, dst) AS src", "least(src, dst) AS dst")
    edges = materialize((edges if reduced else forests(edges)).distinct(), f"{label}-links")
    before = None
    while True:
        edges = _star(edges, label, large=True)
        edges = _star(edges, label, large=False)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.selectExpr("src AS node", "dst AS component")
        before = now


def _star(edges: DataFrame, label: str, large: bool) -> DataFrame:
    """One step, written; what it was made of is deleted."""
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), f"{label}-least")
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    else:
        moved = joined.select(F.col("v").alias("src"), F.col("m").alias("dst")).unionByName(least.select(F.col("u").alias("src"), F.col("m").alias("dst")))
    out = materialize(moved.where("src <> dst").distinct(), f"{label}-{'large' if large else 'small'}")
    discard(edges, least)
    return out
