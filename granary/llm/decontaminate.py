"""Benchmark decontamination: a broadcast hash set of the test items' word n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.llm.common import bounded_batches, claim, fresh, steps
from granary.session import materialize

#: Bytes 0-9, A-Z as a-z and everything from 80 on are parts of words; the rest separates them.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)
HITS = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(WORD_BYTES).split() if data else []


#: Bytes of items and names to a set at most: a window takes 60 bytes and begins with a word, so a set of 4 MB takes 0.3 GB at worst.
SET_BYTES = 4 << 20


class NgramSet:
    """All windows of the items: by length, sorted hashes with the word numbers to verify a hit by."""

    def __init__(self, items: list[tuple[str, bytes | None]], n: int, seed: int = 42):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        number = self.vocabulary.setdefault
        ids = [np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int32) for _, text in items]
        self.code = np.random.default_rng(seed).integers(1, 2**63, len(self.vocabulary) + 1).astype(np.uint64)
        self.by_length = {}
        for size in sorted({min(n, len(x)) for x in ids if len(x)}):
            some = [(k, np.lib.stride_tricks.sliding_window_view(x, size)) for k, x in enumerate(ids) if min(n, len(x)) == size]
            grams, owner = np.concatenate([g for _, g in some]), np.repeat([k for k, _ in some], [len(g) for _, g in some])
            hashes = self.hashes(grams.T)
            order = np.lexsort((owner, *grams.T, hashes))
            hashes, grams, owner = hashes[order], grams[order], owner[order]
            new = np.concatenate([[True], (grams[1:] != grams[:-1]).any(axis=1)])
            once = new | np.concatenate([[True], owner[1:] != owner[:-1]])
            self.by_length[size] = (hashes[new], grams[new], np.append(np.flatnonzero(new[once]), once.sum()), owner[once])

    def hashes(self, columns: Iterable[np.ndarray]) -> np.ndarray:
        out = None
        with np.errstate(over="ignore"):
            for c in columns:
                out = self.code[c] if out is None else out * BASE + self.code[c]
        return out

    def find(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """Per length: starts of verified hits, the length, the window of each, and the windows' owners (as CSR)."""
        known = ids > 0
        run = np.cumsum(~known)
        for size, (hashes, grams, owner_at, owners) in self.by_length.items():
            if len(ids) < size:
                continue
            ends = run[size - 1 :]
            starts = np.nonzero(known[: len(ids) - size + 1] & (ends == run[: len(ids) - size + 1]))[0]
            if not len(starts):
                continue
            h = self.hashes(ids[starts + k] for k in range(size))
            at = np.searchsorted(hashes, h)
            while len(starts):  # more than one window may share a hash
                keep = at < len(hashes)
                keep[keep] = hashes[at[keep]] == h[keep]
                starts, h, at = starts[keep], h[keep], at[keep]
                if not len(starts):
                    break
                same = (grams[at] == ids[starts[:, None] + np.arange(size)]).all(axis=1)
                if same.any():
                    yield starts[same], size, at[same], (owner_at, owners)
                starts, h, at = starts[~same], h[~same], at[~same] + 1


def _scan(index: NgramSet, want_spans: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.vocabulary.get
        for step in steps(batches, "text"):
            texts = step.column(1).to_pylist()
            words = [words_of(t) for t in texts]
            counts = np.array([len(w) for w in words], np.int64)
            begins = np.cumsum(counts + 1) - counts - 1  # a gap between texts: no window crosses it
            ids = np.zeros(int(counts.sum()) + len(words), np.int32)
            for b, w in zip(begins.tolist(), words, strict=True):
                ids[b : b + len(w)] = np.fromiter(map(get, w, repeat(0)), np.int32, len(w))
            edge = np.zeros(len(ids) + 1, np.int64)
            pairs = []
            for starts, size, which, (owner_at, owners) in index.find(ids):
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + size, -1)
                hit = np.unique(np.searchsorted(begins, starts, side="right") - 1 + len(words) * which)  # text and window
                text_of, window = hit % len(words), hit // len(words)
                n = owner_at[window + 1] - owner_at[window]
                at = np.repeat(owner_at[window] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                pairs.append(np.repeat(text_of, n) * len(index.names) + owners[at])
            covered = np.cumsum(edge[:-1]) > 0
            n_hit = np.add.reduceat(covered, begins) if len(words) else np.zeros(0)
            items: list[set[str]] = [set() for _ in words]
            for p in np.unique(np.concatenate(pairs)) if pairs else ():
                items[p // len(index.names)].add(index.names[p % len(index.names)])
            spans = [[] for _ in words]
            if want_spans and covered.any():
                change = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                for first, last in change.reshape(-1, 2).tolist():
                    t = int(np.searchsorted(begins, first, side="right")) - 1
                    spans[t].append({"first": first - int(begins[t]), "last": last - int(begins[t])})
            yield pa.RecordBatch.from_arrays(
                [step.column(0), pa.array(counts), pa.array(n_hit.astype(np.int64)), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_set_bytes: int = SET_BYTES, spans: bool = False) -> DataFrame:
    """Per document: words, words inside an occurrence of an item's n-gram, and the items hit.

    Items of fewer than ``n`` words, but not none, are one window. Null texts
    have no words; a null item id counts as the empty name, and rows that
    repeat an item id are one item. Repeated documents give repeated rows; empty
    tables give no rows, and an empty benchmark no hits. Other columns are
    ignored. With ``spans``, also the maximal runs of hit words, by word number.

    The items are broadcast as a hash set when their texts hold at most
    ``max_set_bytes``. A larger benchmark is dealt into as many sets of that
    size as it takes, each broadcast in its own pass, and the passes' word runs
    are merged per document: the result is the same.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    items, total = _items(benchmark, item_col, item_text_col)
    if total <= max_set_bytes:
        index = NgramSet([(r.name, bytes(r.text)) for r in _sorted_items(items)], n)
        return _pass(texts, index, spans)
    keyed = materialize(texts.withColumn("key", F.monotonically_increasing_id()), "decontaminate-texts")
    words = _pass(keyed.select(F.col("key").alias("doc_id"), "text"), NgramSet([], n), False).selectExpr("doc_id AS key", "n_words")
    merged = _in_passes(keyed.select("key", "text"), items, n, max_set_bytes, total)
    out = keyed.select("key", "doc_id").join(words, "key").join(merged, "key", "left")
    n_hit = F.expr("aggregate(spans, 0L, (a, x) -> a + x.last - x.first)")
    empty = F.expr("cast(array() as array<struct<first:long,last:long>>)")
    return out.select("doc_id", "n_words", F.coalesce(n_hit, F.lit(0)).alias("n_hit"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"), F.coalesce("spans", empty).alias("spans"))


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[DataFrame, int]:
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"), F.col(item_text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    return items, items.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0


def _pass(texts: DataFrame, index: NgramSet, spans: bool) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        claim()
        yield from _scan(shared.value, spans)(batches)

    return texts.mapInArrow(run, HITS)


def _sorted_items(items: DataFrame):
    return sorted(items.collect(), key=lambda r: (r.name, bytes(r.text)))


def _in_passes(keyed: DataFrame, items: DataFrame, n: int, max_set_bytes: int, total: int) -> DataFrame:
    """(key, items, spans) of the texts (key, text) that any of the sets hits, each set in a pass of its own."""
    n_sets = -(-total // max_set_bytes) * 2
    dealt = materialize(items.withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(n_sets))), "benchmark")
    hits = None
    for part in range(n_sets):
        index = NgramSet([(r.name, bytes(r.text)) for r in _sorted_items(dealt.where(F.col("part") == part))], n)
        found = _pass(keyed.select(F.col("key").alias("doc_id"), "text"), index, True).where("n_hit > 0")
        found = materialize(found.withColumnRenamed("doc_id", "key"), "decontaminate-pass")
        hits = found if hits is None else hits.unionByName(found)
    merged = hits.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("runs"))
    joined = F.expr(
        """aggregate(runs, cast(array() as array<struct<first:long,last:long>>), (a, x) ->
           if(size(a) > 0 and x.first <= element_at(a, -1).last,
              concat(slice(a, 1, size(a) - 1), array(named_struct('first', element_at(a, -1).first, 'last', greatest(element_at(a, -1).last, x.last)))),
              concat(a, array(x))))"""
    )
    return merged.select("key", "items", joined.alias("spans"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", unit: str = "document", max_set_bytes: int = SET_BYTES) -> DataFrame:
    """The documents without contaminated ones, or (unit='span') without the hit runs of words.

    A cleaned text keeps all bytes outside the runs. Texts are judged once, as
    they came, and then cut: with one set in one pass over the rows without a
    join; with a benchmark over ``max_set_bytes`` by the merged hits of all sets.

    Null texts and texts without words are hit by nothing and stay; texts may be
    of any length; repeated rows are judged alike; an empty benchmark leaves all
    rows, empty tables give none; all columns come back, whatever their names.
    """
    if unit not in ("document", "span"):
        raise ValueError("unit is 'document' or 'span'")
    bounded_batches(docs.sparkSession)
    items, total = _items(benchmark, item_col, item_text_col)
    if total <= max_set_bytes:
        return _clean(docs, text_col, unit, NgramSet([(r.name, bytes(r.text)) for r in _sorted_items(items)], n))
    key, runs = fresh(docs, "key"), fresh(docs, "runs")
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "decontaminate-docs")
    merged = _in_passes(keyed.select(F.col(key).alias("key"), F.col(text_col).cast("binary").alias("text")), items, n, max_set_bytes, total)
    joined = keyed.join(merged.select(F.col("key").alias(key), F.col("spans").alias(runs)), key, "left").drop(key)
    if unit == "document":
        return joined.where(F.col(runs).isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
    return _clean(joined.select(*[F.col(f"`{c}`") for c in docs.columns], runs), text_col, unit, None)


def _clean(docs: DataFrame, text_col: str, unit: str, index: NgramSet | None) -> DataFrame:
    """Judge and cut by a set, or cut by the runs in the last column."""
    shared = docs.sparkSession.sparkContext.broadcast(index) if index is not None else None
    place = docs.columns.index(text_col)
    fields = docs.schema.fields if shared else docs.schema.fields[:-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        scan = _scan(shared.value, True) if shared else None
        for batch in steps(batches, text_col):
            raw = batch.column(place).cast(pa.binary())
            if scan:
                numbers = pa.array(np.arange(batch.num_rows))
                hits = [h for got in scan([pa.RecordBatch.from_arrays([numbers, raw], names=["doc_id", "text"])]) for h in got.column(4).to_pylist()]
            else:
                hits = batch.column(len(fields)).to_pylist()
            if unit == "document":
                yield batch.filter(pa.array([not h for h in hits]))
                continue
            texts = [None if t is None else _without(t, h).decode("utf-8", "replace") if h else t.decode("utf-8", "replace") for t, h in zip(raw.to_pylist(), hits, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(fields))], names=[f.name for f in fields])

    return docs.mapInArrow(run, StructType(fields))


def _without(data: bytes, spans: list[dict]) -> bytes:
    """The text without the bytes from the first to the last word of each run."""
    flags = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))).reshape(-1, 2)
    out, at = [], 0
    for s in spans:
        out.append(data[at : edges[s["first"], 0]])
        at = int(edges[s["last"] - 1, 1])
    return b"".join([*out, data[at:]])
