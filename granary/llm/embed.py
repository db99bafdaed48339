"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import connected_components, union_min
from granary.session import discard, materialize

BITS = 64
#: Table t is keyed by the WIDTH bits from 8 t on, around the code's end, whatever the number of vectors: a wider key finds fewer pairs.
TABLES = 8
WIDTH = 8
SAMPLE = 20_000
#: Classes of a bucket that are compared with each other in one place, and pairs of them at a time.
BLOCK = 16_384
PAIRS = 1 << 20
MAX_HAMMING = 20


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by their largest number first, so that squares neither vanish nor overflow."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


class Quantiser:
    """Balanced binary codes: principal directions of a sample, turned so that signs lose least (ITQ)."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, rounds: int = 40, seed: int = 3):
        x = units(sample)
        self.mean = x.mean(axis=0)
        centred = x - self.mean
        _, _, directions = np.linalg.svd(centred.T @ centred)
        directions = directions[: min(bits, x.shape[1])].T
        flat = centred @ directions
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(flat.shape[1], flat.shape[1])))[0]
        for _ in range(rounds):
            signs = np.where(flat @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ flat)
            turn = (u @ v).T
        self.turn = directions @ turn

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        x = units(vectors)
        signs = (x - self.mean) @ self.turn >= 0
        padded = np.zeros((len(x), BITS), bool)
        padded[:, : signs.shape[1]] = signs
        return np.packbits(padded, axis=1, bitorder="little").view("<u8").ravel()


def fit(reps: DataFrame, most: int) -> dict[int, Quantiser]:
    """One quantiser per vector length, on at most ``most`` vectors in all, by hash order."""
    rows = reps.orderBy(F.xxhash64("label", "emb"), "rep").limit(most).select("emb").collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r.emb), []).append(r.emb)
    return {n: Quantiser(np.array(v, np.float64)) for n, v in by_size.items()}


def _signs(vectors: np.ndarray) -> np.ndarray:
    """Codes of a length that the sample doesn't hold: signs of the first numbers."""
    padded = np.zeros((len(vectors), BITS), bool)
    padded[:, : min(BITS, vectors.shape[1])] = vectors[:, :BITS] > 0
    return np.packbits(padded, axis=1, bitorder="little").view("<u8").ravel()


def _pairs(a_code, a_vec, b_code, b_vec, table: int, width: int, threshold: float, most: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs between two blocks of one bucket, each found in the first table where both collide; width 0 compares all."""
    x = a_code[:, None] ^ b_code[None, :]
    i, j = np.nonzero(np.bitwise_count(x) <= most)
    if same:
        ahead = i < j
        i, j = i[ahead], j[ahead]
    x = x[i, j]
    mask = np.uint64((1 << width) - 1)
    for earlier in range(table):
        at = 8 * earlier
        turned = x >> np.uint64(at) | x << np.uint64(64 - at) if at else x
        fresh = turned & mask != 0
        i, j, x = i[fresh], j[fresh], x[fresh]
    keep = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 16):
        part = slice(k, k + (1 << 16))
        keep[part] = np.einsum("nd,nd->n", a_vec[i[part]], b_vec[j[part]]) >= threshold
    return i[keep], j[keep]


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, sample: int = SAMPLE, block: int = BLOCK, max_hamming: int = MAX_HAMMING, width: int | None = None, exact: bool = False) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors of one label link at a cosine, in double precision, of
    ``threshold`` or more. Equal vectors of a label are one class, which goes
    on with a number of its own, its smallest id and its number of rows.
    Classes get a 64-bit code by iterative quantisation (fitted on at most
    ``sample`` classes; all are indexed) and a row in each of 8 tables, by label
    and ``width`` bits of the code (WIDTH by default, of a table of any size, so
    that what is found doesn't hang on it). A bucket's classes are compared block by
    block, so a bucket may hold any number; pairs within ``max_hamming`` bits
    are reranked by the original vectors. A block answers with a count and a
    link to the local component per class, never with pairs.

    A pair that differs in every table's bits, or in more than ``max_hamming``,
    is missed; ``exact`` compares all classes of a label instead, in the same
    blocks, and misses none, at a cost that grows with the square of a label's
    classes.

    Null, empty or zero vectors, those with null or non-finite numbers, and
    rows with a null label or id, link with nothing; their component is their
    own id. Very large and very small numbers are scaled first. Repeated rows,
    and different vectors of one id, are vectors of their own. Empty tables give
    no rows; other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    emb = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), emb.alias("emb"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.size("emb") > 0, F.lit(False))
    fine &= F.coalesce(F.forall("emb", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))), F.lit(False))
    fine &= F.coalesce(F.exists("emb", lambda v: v != 0.0), F.lit(False))
    rows = materialize(rows.withColumn("fine", fine), "embed-rows")
    reps = rows.where("fine").groupBy("label", "emb").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times"))
    reps = materialize(reps.withColumn("node", F.monotonically_increasing_id()), "embed-reps")  # written, so the numbers stay
    models = spark.sparkContext.broadcast(fit(reps, sample))
    wide = 0 if exact else WIDTH if width is None else width
    most = BITS if exact else max_hamming

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = [np.array(v, np.float64) for v in batch.column(1).to_pylist()]
            sizes = np.array([len(v) for v in vec], np.int64)
            codes = np.zeros(len(vec), np.uint64)
            unit: list[bytes] = [b""] * len(vec)
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                own = np.stack([vec[i] for i in at])
                codes[at] = models.value[n].codes(own) if n in models.value else _signs(own)
                for i, u in zip(at.tolist(), units(own), strict=True):
                    unit[i] = u.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes.astype(np.int32)), batch.column(2), batch.column(3), pa.array(codes.view(np.int64)), pa.array(unit, pa.binary())], names=["label", "dim", "node", "times", "code", "unit"])

    coded = materialize(reps.select("label", "emb", "node", "times").mapInArrow(code, "label string, dim int, node long, times long, code long, unit binary"), "embed-codes")
    bits = F.lit((1 << wide) - 1).cast("long")
    turned = lambda t: F.call_function("shiftrightunsigned", F.col("code"), 8 * t).bitwiseOR(F.when(t == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.col("code"), 64 - 8 * t)))
    tables = F.explode(F.transform(F.sequence(F.lit(0), F.lit(0 if exact else TABLES - 1)), lambda t: F.struct(t.alias("t"), turned(t).bitwiseAND(bits).alias("part"))))
    key = ["label", "dim", "t", "part"]
    keyed = coded.withColumn("cell", tables).select("label", "dim", F.col("cell.t").alias("t"), F.col("cell.part").alias("part"), "node", "times", "code", "unit")
    large = materialize(keyed.groupBy(*key).count().where(F.col("count") > 1).select(*key, F.ceil(F.col("count") / block).cast("int").alias("s")), "embed-buckets")
    cut = keyed.join(large, key).withColumn("own", F.pmod(F.xxhash64("node"), F.col("s")).cast("int"))
    cells = F.explode(F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda c: F.struct(F.least(c, F.col("own")).alias("i"), F.greatest(c, F.col("own")).alias("j"))))
    dealt = cut.withColumn("cell", cells).select(*key, F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "own", "node", "times", "code", "unit")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        i, j, table = int(group["i"].iloc[0]), int(group["j"].iloc[0]), int(group["t"].iloc[0])
        first, second = np.flatnonzero(group["own"].to_numpy() == i), np.flatnonzero(group["own"].to_numpy() == j)
        codes = group["code"].to_numpy().view(np.uint64)
        unit = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(len(group), -1)
        times, node = group["times"].to_numpy(), group["node"].to_numpy()
        counts, links = np.zeros(len(group), np.int64), []
        rows = max(1, PAIRS // max(1, len(second)))
        for k in range(0, len(first), rows):
            some = first[k : k + rows]
            others = second[k:] if i == j else second
            a, b = _pairs(codes[some], unit[some], codes[others], unit[others], table, wide, threshold, most, i == j)
            a, b = some[a], others[b]
            np.add.at(counts, a, times[b])
            np.add.at(counts, b, times[a])
            links.append(np.stack([a, b]))
        a, b = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
        root = union_min(len(group), a, b)
        hit = counts > 0
        return pd.DataFrame({"node": node[hit], "n": counts[hit], "root": node[root[hit]]})

    found = materialize(dealt.groupBy(*key, "i", "j").applyInPandas(compare, "node long, n long, root long"), "embed-found")
    components = connected_components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")), "embed")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = reps.join(counts, "node", "left").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named.select("label", "emb", "rep", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component"), "embed-named")
    discard(reps, coded, large, found)
    heads = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    linked = rows.where("fine").join(named.join(heads, "component"), ["label", "emb"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
