"""SimHash near-duplicates: fingerprints sharded and searched by vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import bounded_batches, claim, connected_components, forests, steps, union_min
from granary.session import discard, materialize

SHINGLE_STEP = 1 << 15
#: Rows at most of a shard before it is cut into blocks, which only a dense group of that size does.
SHARD_ROWS = 4_000_000
#: Shards at least, and fingerprints that a shard is home to where there would be more in that many.
SHARDS, HOME_ROWS = 64, 1 << 18
#: Fingerprints of which the tree is grown at most, and for each leaf.
SAMPLE, LEAF_SAMPLE = 1 << 17, 128
#: Fingerprints that go down the tree together.
ROUTE_ROWS = 1 << 16
LOCAL_LEAF = 192
QUERY_STEP = 8192


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in over half the hashes of the text's word shingles; no words give 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterable[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    total, n = np.zeros(64, np.int64), 0
    hashed = map(lambda s: xxhash.xxh64_intdigest(s, seed), shingles)  # noqa: C417
    while True:
        h = np.fromiter((x for _, x in zip(range(SHINGLE_STEP), hashed, strict=False)), np.uint64)
        if not len(h):
            break
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
        if len(h) < SHINGLE_STEP:
            break
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed long; null texts count as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for step in steps(batches, "text"):
            fps = np.array([fingerprint(t, width) for t in step.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([step.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def distances(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """A tree over a bounded sample of fingerprints whose leaves number the shards.

    A node holds a vantage point and the median distance to it: inside are
    those no farther, outside the rest. A search of some radius goes down both
    sides only where the triangle inequality lets a match lie on either.
    """

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list[tuple] = []  # (vantage, median, inside, outside), children < 0 are leaves
        self.n_leaves = 0
        self._grow(np.asarray(sample, np.uint64), leaves)

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        if leaves > 1 and len(points) > 2:
            tries = points[:: max(1, len(points) // 8)][:8]
            apart = [distances(points, v) for v in tries]
            best = int(np.argmax([np.var(d.astype(float)) for d in apart]))
            d, median = apart[best], int(np.median(apart[best]))
            inside = d <= median
            if inside.any() and not inside.all():
                at = len(self.nodes)
                self.nodes.append(())
                self.nodes[at] = (tries[best], median, self._grow(points[inside], (leaves + 1) // 2), self._grow(points[~inside], leaves // 2))
                return at
        self.n_leaves += 1
        return -self.n_leaves

    def route(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per leaf: which points must be looked up there, and which of them live there."""
        every = np.arange(len(points))
        stack = [(0 if self.nodes else -1, every, np.ones(len(points), bool))]
        while stack:
            node, which, home = stack.pop()
            if not len(which):
                continue
            if node < 0:
                yield -node - 1, which, home
                continue
            vantage, median, inside, outside = self.nodes[node]
            d = distances(points[which], vantage).astype(np.int64)
            near, far = d - radius <= median, d + radius > median
            stack.append((inside, which[near], (home & (d <= median))[near]))
            stack.append((outside, which[far], (home & (d > median))[far]))


def _joined(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` or more, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def link_shard(points: np.ndarray, home: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """For each point the smallest index that it is linked to, over links between a query point and a home point."""
    n = len(points)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    root, held = np.arange(n), 0

    def fold() -> None:
        nonlocal root, held
        links = [*found, (np.arange(n), root)]
        root = union_min(n, np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links]))
        found.clear()
        held = 0

    stack = [(np.flatnonzero(home), np.flatnonzero(query))]
    while stack:
        own, asked = stack.pop()
        if not len(own) or not len(asked):
            continue
        if len(own) > LOCAL_LEAF:
            vantage = points[own[0]]
            d_own, d_asked = distances(points[own], vantage).astype(np.int64), distances(points[asked], vantage).astype(np.int64)
            median = int(np.median(d_own))
            inside = d_own <= median
            if not inside.all():
                stack.append((own[inside], asked[d_asked - radius <= median]))
                stack.append((own[~inside], asked[d_asked + radius > median]))
                continue
        for i in range(0, len(own), LOCAL_LEAF):
            some = own[i : i + LOCAL_LEAF]
            for j in range(0, len(asked), QUERY_STEP):
                part = asked[j : j + QUERY_STEP]
                a, b = np.nonzero(distances(points[part][:, None], points[some][None, :]) <= radius)
                a, b = part[a], some[b]
                apart = root[a] != root[b]
                if apart.any():
                    found.append((a[apart], b[apart]))
                    held += int(apart.sum())
                    if held > 500_000:
                        fold()
    fold()
    return root


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, shards: int = SHARDS, home_rows: int = HOME_ROWS, least: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; see ``fingerprints`` for the text's part.

    Fingerprints at ``radius`` or fewer differing bits link; component_id is
    the smallest doc_id reached. From ``least`` distinct fingerprints on, all
    are sharded by a vantage-point tree grown on a bounded sample (at most
    SAMPLE of them, by hash order), sent also to every shard that their ball
    touches, and searched there by a local tree. There are ``shards`` leaves, and
    more only where each would be home to over ``home_rows`` fingerprints, so
    that copies at borders don't multiply as the corpus grows. A shard answers
    with one link per fingerprint to its local component, never with pairs.
    Shards over SHARD_ROWS rows, which a dense group makes, are cut into blocks.

    Null and empty texts have fingerprint 0 and link like any other. Rows that
    share a doc_id are one node. A null doc_id takes the component of its
    fingerprint, null if no other row has it. Empty tables give no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    own = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "simhash-fp")
    reps = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    total = reps.count()
    leaves = min(max(shards, -(-total // home_rows)), SAMPLE // 4) if total >= least else 1
    some = [r.fp for r in reps.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, leaves * LEAF_SAMPLE)).collect()] if leaves > 1 else []
    tree = spark.sparkContext.broadcast(VantageTree(np.array(some, np.int64).view(np.uint64), leaves))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches, ROUTE_ROWS):
            points = batch.column(0).to_numpy(zero_copy_only=False)
            for leaf, which, home in tree.value.route(points.view(np.uint64), radius):
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), leaf, np.int32)), batch.column(0).take(at), batch.column(1).take(at), pa.array(home)], names=["leaf", "fp", "rep", "home"])

    routed = materialize(reps.where("rep IS NOT NULL").mapInArrow(route, "leaf int, fp long, rep long, home boolean"), "simhash-routed")
    large = routed.groupBy("leaf").count().where(F.col("count") > SHARD_ROWS).collect()  # at most SAMPLE / 4 leaves
    dealt = routed.select("leaf", F.lit(0).alias("b"), F.lit(0).alias("q"), "fp", "rep", "home", F.lit(True).alias("query"))
    if large:
        blocks = F.create_map(*[F.lit(x) for r in large for x in (r.leaf, -(-r["count"] // SHARD_ROWS))])
        cut = routed.withColumn("s", F.coalesce(F.element_at(blocks, F.col("leaf")), F.lit(1)).cast("int")).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("s")).cast("int"))
        cells = F.expr("array_distinct(concat(transform(sequence(0, s - 1), i -> named_struct('b', i, 'q', own)), transform(sequence(0, s - 1), i -> named_struct('b', own, 'q', i))))")
        cut = cut.withColumn("cell", F.explode(cells))
        dealt = cut.select("leaf", "cell.b", "cell.q", "fp", "rep", (F.col("home") & (F.col("cell.b") == F.col("own"))).alias("home"), (F.col("cell.q") == F.col("own")).alias("query"))

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("rep", kind="stable")
        rep = shard["rep"].to_numpy()
        root = link_shard(shard["fp"].to_numpy().view(np.uint64), shard["home"].to_numpy(), shard["query"].to_numpy(), radius)
        moved = root != np.arange(len(root))
        return pd.DataFrame({"src": rep[moved], "dst": rep[root[moved]]})

    links = dealt.groupBy("leaf", "b", "q").applyInPandas(search, "src long, dst long")
    # A doc_id of several texts joins the groups of all of them.
    several = own.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("doc_id")
    links = links.unionByName(forests(own.join(several, "doc_id").join(reps, "fp").where("doc_id <> rep").selectExpr("doc_id AS src", "rep AS dst")))
    components = connected_components(links, "simhash", reduced=True)
    named = materialize(reps.join(components, reps.rep == components.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id")), "simhash-named")
    discard(reps, routed)
    out = own.join(named, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
