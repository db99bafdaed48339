"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import WordCache, bounded_batches, claim, fold_held_out, steps
from granary.llm.labelled import sampled

BITS = 16
DIM = 1 << BITS
#: The first slots are for structure statistics, the rest for hashed words and word shapes.
STATS_SLOTS = 1 << 10
BINS = 24
MAX_ROWS = 6000
_HELD: dict[str, WordCache] = {}

_CLASS = bytes(ord("A") if 0x41 <= b <= 0x5A else ord("0") if 0x30 <= b <= 0x39 else ord("a") if 0x61 <= b <= 0x7A or b >= 0x80 else b for b in range(256))

_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def _slot(data: bytes) -> int:
    return STATS_SLOTS + zlib.crc32(data) % (DIM - STATS_SLOTS)


def _shape(word: bytes) -> bytes:
    """The word with runs of letters, capitals and digits cut to one."""
    return _RUNS.sub(rb"\1", word.translate(_CLASS))


def _word_slots(words: list[bytes]) -> tuple[list[int], list[int]]:
    return [s for w in words for s in (_slot(b"w" + w.lower()), _slot(b"s" + _shape(w)))], [2] * len(words)


def _cache() -> WordCache:
    if "words" not in _HELD:
        _HELD["words"] = WordCache(_word_slots, np.int64, 400_000)
    return _HELD["words"]


def structure(text: bytes, n_words: int, n_unique: int, n_repeats: int) -> list[float]:
    """Statistics in 0..1 or log scale, each of which is then put into one of BINS bins."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, spaces, lines = max(1, len(text)), int(counts[0x20] + counts[9:14].sum()), int(counts[10]) + 1
    upper, lower, digits, high = int(counts[0x41:0x5B].sum()), int(counts[0x61:0x7B].sum()), int(counts[0x30:0x3A].sum()), int(counts[128:].sum())
    marks = len(text) - spaces - upper - lower - digits - high
    letters = max(1, upper + lower + high)
    top_mark = int(max(counts[0x21:0x30].max(), counts[0x3A:0x41].max(), counts[0x5B:0x61].max(), counts[0x7B:0x7F].max()))
    words = max(1, n_words)
    return [
        math.log2(1 + n_words) / 16, math.log2(1 + len(text)) / 20, upper / letters, digits / size, marks / size, high / size, top_mark / words,
        n_unique / words, n_repeats / words, math.log2(1 + n_words / lines) / 12, min(1.0, (size - spaces) / words / 24), counts[0x2E] / words, lines / words,
    ]


#: Of the text; after them come the bins of the stated size, and one slot for rows that state none.
N_STATS = 13


def size_slots(stated: np.ndarray) -> np.ndarray:
    """The metadata feature's slot of each row: the logarithm of the stated number of characters, in bins; NaN is none."""
    known = stated >= 0
    bins = np.clip(np.log2(1 + np.where(known, stated, 0)) / 20 * BINS, 0, BINS - 1).astype(np.int64)
    return N_STATS * BINS + np.where(known, bins, BINS)


def features(texts: list[bytes | None], stated: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, slots and values of the texts' non-zero features, by row; ``stated`` is the metadata's number of characters."""
    cache = _cache()
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        own = t.split() if t else []
        counts[i] = len(own)
        words += own
    numbers = cache.lookup(words)
    slots, _ = cache.gather(numbers)
    row_of_word = np.repeat(np.arange(len(texts)), counts)
    keys, times = np.unique(np.repeat(row_of_word, 2) * DIM + slots, return_counts=True)
    rows, slot = keys >> BITS, keys & (DIM - 1)
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(rows, value * value, len(texts)))
    value = value / np.maximum(norm, 1e-12)[rows]
    same = np.concatenate([[False], (numbers[1:] == numbers[:-1]) & (row_of_word[1:] == row_of_word[:-1])]) if len(numbers) else np.zeros(0, bool)
    repeats = np.bincount(row_of_word[same], minlength=len(texts))
    unique = np.bincount(np.unique(row_of_word * (len(cache.number) + 1) + numbers) // (len(cache.number) + 1), minlength=len(texts))
    stats = np.array([structure(t or b"", int(n), int(u), int(r)) for t, n, u, r in zip(texts, counts, unique, repeats, strict=True)]).reshape(len(texts), N_STATS)
    bins = np.arange(N_STATS) * BINS + np.clip((stats * BINS).astype(np.int64), 0, BINS - 1)
    bins = np.concatenate([bins, size_slots(np.full(len(texts), np.nan) if stated is None else stated)[:, None]], axis=1)
    rows = np.concatenate([rows, np.repeat(np.arange(len(texts)), N_STATS + 1)])
    slot = np.concatenate([slot, bins.ravel()])
    value = np.concatenate([value, np.full(bins.size, 1 / math.sqrt(N_STATS + 1))])
    order = np.argsort(rows, kind="stable")
    return rows[order], slot[order], value[order].astype(np.float32)


class FactorisationMachine:
    """score = sigmoid(w0 + <w, x> + sum over pairs of <v_i, v_j> x_i x_j), the last by (|sum v x|^2 - sum |v x|^2) / 2."""

    def __init__(self, rank: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias, self.w = 0.0, np.zeros(DIM, np.float32)
        self.v = rng.normal(0, 0.05, (DIM, rank)).astype(np.float32)

    def raw(self, rows: np.ndarray, slots: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        vx = self.v[slots] * values[:, None]
        at = np.searchsorted(rows, np.arange(n))
        sums = np.add.reduceat(vx, at, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), at)
        linear = np.add.reduceat(self.w[slots] * values, at)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, texts: list[bytes | None], stated: np.ndarray | None = None) -> np.ndarray:
        rows, slots, values = features(texts, stated)
        z, _ = self.raw(rows, slots, values, len(texts))
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def fit(self, data: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.08, decay: float = 1e-5, seed: int = 11) -> FactorisationMachine:
        """Adagrad on the log loss, over (slots, values) of each row."""
        rng, g_w, g_v, g_b = np.random.default_rng(seed), np.full(DIM, 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32), 1e-6
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        self.bias = math.log(share / (1 - share))
        if len(set(labels.tolist())) < 2:
            return self
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                rows = np.repeat(np.arange(len(some)), [len(data[k][0]) for k in some])
                slots, values = np.concatenate([data[k][0] for k in some]), np.concatenate([data[k][1] for k in some])
                z, sums = self.raw(rows, slots, values, len(some))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]).astype(np.float32) / len(some)
                per = (error[rows] * values)[:, None]
                used, index = np.unique(slots, return_inverse=True)
                d_v = np.zeros((len(used), self.v.shape[1]), np.float32)
                np.add.at(d_v, index, per * (sums[rows] - self.v[slots] * values[:, None]))
                d_w = np.bincount(index, per[:, 0], len(used)).astype(np.float32)
                d_v += decay * self.v[used]
                d_w += decay * self.w[used]
                g_w[used] += d_w**2
                g_v[used] += d_v**2
                g_b += float(error.sum()) ** 2
                self.w[used] -= rate * d_w / np.sqrt(g_w[used])
                self.v[used] -= rate * d_v / np.sqrt(g_v[used])
                self.bias -= rate * float(error.sum()) / math.sqrt(g_b)
        return self


def _size(docs: DataFrame, size_col: str | None) -> Column:
    """The stated size as a double; null where there is no such column or no number in it."""
    return F.col(size_col).cast("string").try_cast("double") if size_col in docs.columns else F.lit(None).cast("double")


def _stated(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64)


def learning_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, size_col: str | None, most: int) -> DataFrame:
    """Features of a bounded sample of labelled documents of the learning folds (at most ``most`` labels)."""
    bounded_batches(docs.sparkSession)
    chosen = sampled(labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")), "doc_id", most)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), _size(docs, size_col).alias("size")).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text", "size")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(_cache())
        for step in steps(batches, "text"):
            rows, slots, values = features(step.column(2).to_pylist(), _stated(step.column(3)))
            at = np.searchsorted(rows, np.arange(step.num_rows + 1))
            cells = [(slots[a:b].astype("<u4").tobytes(), values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([step.column(0), step.column(1), pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary())], names=["doc_id", "label", "slots", "vals"])

    return texts.mapInArrow(run, "doc_id long, label int, slots binary, vals binary")


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", size_col: str | None = "n_chars", most: int = MAX_ROWS) -> FactorisationMachine:
    """Fit on at most ``most`` labelled documents; only their features come to the driver."""
    rows = sorted(learning_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, size_col=size_col, most=most).collect(), key=lambda r: (r.doc_id, bytes(r.slots)))
    data = [(np.frombuffer(r.slots, "<u4").astype(np.int64), np.frombuffer(r.vals, np.float32)) for r in rows]
    return FactorisationMachine().fit(data, np.array([r.label for r in rows], np.float32))


def score_quality(docs: DataFrame, model: FactorisationMachine, *, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars", threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text and the size that its metadata states.

    Null and empty texts are scored by their (empty) structure, and a missing
    or odd stated size has a feature of its own; repeated rows
    give repeated rows; a null id stays null and counts as not held out; empty
    tables give none; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(_cache())
        for step in steps(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([step.column(0), pa.array(shared.value.score(step.column(1).to_pylist(), _stated(step.column(2))), pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), _size(docs, size_col).alias("size")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", fold_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
