"""Places of texts whose key occurs more than once in a corpus, found without gathering a key's occurrences.

An entry has a key and a content. A step of a task (some MB of texts) sends one
place of each (key, content) it holds, with their number, to be decided on;
its other places of that key and content go on straight away, being known to
repeat. So the task that decides on a key gets at most one entry per step and
content, not one per place, however many places a key has. Entries travel as
one row of packed arrays per step and target partition.

A place that repeats is told with a bit that says whether its key also has
another content, so that what must be compared further can be told from copies.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import bounded_batches, chained, claim, steps
from granary.session import materialize

#: Bytes of text whose keys are gathered before they are sent on.
STEP = 3 << 20
#: Sorts a key's contents apart.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Stands for a null id, before all others.
NO_ID = -(1 << 63)
#: A key counts as hot from this number of places (with contents: of distinct contents) on, or from the share that
#: leaves at most MAX_HOT of them: 32 MB with their numbers, however large the corpus.
HOT_PLACES = 512
MAX_HOT = 1 << 21
#: Places go as 32 bits, of which two are taken for marks.
MAX_TEXT = 1 << 30
FLAGGED = "part int, entries binary, hot_key long, hot_count long"
DEALT = "part int, entries binary"

#: (texts) -> (number of the text, place, key, content) of all entries; content None: all of a key's are the same
Find = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tie, text): rows that share id and text are one document; those that share only the id are ordered by ``tie``."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.hash(text).alias("tie"), text.alias("text"))


def _pack(docs: np.ndarray, ties: np.ndarray, owner: np.ndarray, places: np.ndarray, keys: np.ndarray, counts: np.ndarray, contents: np.ndarray | None) -> bytes:
    """Entries with the documents they name."""
    used, local = np.unique(owner, return_inverse=True)
    head = struct.pack("<III", len(used), len(keys), int(contents is not None))
    last = [] if contents is None else [contents.astype("<u8").tobytes()]
    return b"".join([head, docs[used].astype("<i8").tobytes(), ties[used].astype("<i4").tobytes(), local.astype("<u4").tobytes(), places.astype("<u4").tobytes(), keys.astype("<u8").tobytes(), counts.astype("<u4").tobytes(), *last])


def _unpack(data: bytes) -> list[np.ndarray]:
    n_docs, n, with_content = struct.unpack_from("<III", data)
    at = 12
    out = []
    for kind, size in (("<i8", n_docs), ("<i4", n_docs), ("<u4", n), ("<u4", n), ("<u8", n), ("<u4", n), ("<u8", n * with_content)):
        out.append(np.frombuffer(data, kind, size, at))
        at += np.dtype(kind).itemsize * size
    if not with_content:
        out[6] = np.zeros(n, np.uint64)
    return out


def _send(find: Find, n_parts: int, step_bytes: int, most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for step in steps(batches, "text", step_bytes):
            docs, ties, texts = step.column(0).to_numpy(), step.column(1).to_numpy(), step.column(2).to_pylist()
            if max(map(len, texts)) >= most:
                raise ValueError(f"a text of {most} bytes or more can't be searched for repeats")
            owner, places, keys, contents = find(texts)
            # One sort for both: entries apart by chance only are sent twice, with their numbers.
            order = np.argsort(keys if contents is None else keys * MIX ^ contents, kind="stable")
            owner, places, keys = owner[order], places[order], keys[order]
            contents = None if contents is None else contents[order]
            new = keys[1:] != keys[:-1]
            if contents is not None:
                new |= contents[1:] != contents[:-1]
            begin = np.flatnonzero(np.concatenate([[True], new])) if len(keys) else np.zeros(0, np.int64)
            size = np.diff(np.append(begin, len(keys)))
            rows: list[tuple[int, bytes | None, bytes | None]] = []
            part = (keys[begin] % np.uint64(n_parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[by], np.arange(n_parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                which = by[cuts[p] : cuts[p + 1]]
                at = begin[which]
                rows.append((p, _pack(docs, ties, owner[at], places[at], keys[at], size[which], None if contents is None else contents[at]), None))
            known = np.ones(len(keys), bool)
            known[begin] = False
            known_at = np.flatnonzero(known)
            if len(known_at):
                # Known repeats need no decision; dealt by document over the partitions.
                target = target_of(docs[owner[known_at]], ties[owner[known_at]], n_parts)
                by = np.argsort(target, kind="stable")
                cuts = np.searchsorted(target[by], np.arange(n_parts + 1))
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    at = known_at[by[cuts[p] : cuts[p + 1]]]
                    at = at[np.concatenate([[True], (np.diff(owner[at]) != 0) | (np.diff(places[at]) != 0)])]
                    none = np.zeros(len(at))
                    rows.append((p, None, _pack(docs, ties, owner[at], places[at], none, none, None)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["part", "entries", "known"])

    return run


def _decide(hot_places: int, n_parts: int, with_contents: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        entries, known = [], []
        for batch in batches:
            entries += [_unpack(x) for x in batch.column(1).to_pylist() if x is not None]
            known += [_unpack(x) for x in batch.column(2).to_pylist() if x is not None]
        found = []
        hot_keys, hot_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if entries:
            shift = np.cumsum([0, *(len(e[0]) for e in entries)])
            docs, ties = np.concatenate([e[0] for e in entries]), np.concatenate([e[1] for e in entries])
            owner = np.concatenate([e[2].astype(np.int64) + s for e, s in zip(entries, shift, strict=False)])
            places, keys, counts, contents = (np.concatenate([e[i] for e in entries]) for i in (3, 4, 5, 6))
            order = np.lexsort((contents, keys))
            keys, contents = keys[order], contents[order]
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            total = np.add.reduceat(counts[order].astype(np.int64), begin)
            size = np.diff(np.append(begin, len(keys)))
            mixed = contents[begin] != contents[begin + size - 1]
            if with_contents:
                total_of = np.add.reduceat(np.concatenate([[1], (contents[1:] != contents[:-1]) | (keys[1:] != keys[:-1])]).astype(np.int64), begin)
            else:
                total_of = total
            keep = np.repeat(total > 1, size)
            flagged = order[keep]
            found.append((docs[owner[flagged]], ties[owner[flagged]], places[flagged].astype(np.int64) * 2 + np.repeat(mixed, size)[keep]))
            hot = total_of >= hot_places
            hot_keys, hot_counts = keys[begin][hot], total_of[hot]
        found += [(k[0][k[2]], k[1][k[2]], k[3].astype(np.int64) * 2) for k in known]
        if found:
            docs, ties, places = (np.concatenate([f[i] for f in found]) for i in range(3))
            table = pa.table({"doc": docs.astype(np.int64), "tie": ties.astype(np.int32), "place": places.astype(np.uint32)})
            for part, blob in deal(table, target_of(docs, ties, n_parts), n_parts):
                yield _flag_batch([part], [blob], [None], [None])
        if len(hot_keys):
            n = len(hot_keys)
            yield _flag_batch([None] * n, [None] * n, hot_keys.view(np.int64), hot_counts)

    return run


def _flag_batch(parts, blobs, keys, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["part", "entries", "hot_key", "hot_count"])


def target_of(docs: np.ndarray, ties: np.ndarray, n_parts: int) -> np.ndarray:
    return ((docs.astype(np.int64) * 31 + ties) % n_parts).astype(np.int64)


def deal(table: pa.Table, part: np.ndarray, n_parts: int) -> Iterator[tuple[int, bytes]]:
    """The rows of each target partition as one compressed Arrow stream."""
    by = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[by], np.arange(n_parts + 1))
    dealt = table.take(pa.array(by))
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(dealt.slice(cuts[p], cuts[p + 1] - cuts[p]).combine_chunks())
        yield p, sink.getvalue().to_pybytes()


def undeal(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    """All rows that were dealt to this partition."""
    tables = [pa.ipc.open_stream(x).read_all() for batch in batches for x in batch.column("entries").to_pylist()]
    return pa.concat_tables(tables).combine_chunks() if tables else None


def by_document(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows sorted by document, and where each document's begin and end."""
    table = table.take(pa.array(np.lexsort((table["tie"].to_numpy(), table["doc"].to_numpy()))))
    doc, tie = table["doc"].to_numpy(), table["tie"].to_numpy()
    begin = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]))
    return table, begin, np.append(begin[1:], len(doc))


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = undeal(batches)
    if table is None:
        return
    table, begin, end = by_document(table)
    place = table["place"].to_numpy()
    blobs = [np.unique(place[a:b]).astype("<u4").tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays([table["doc"].combine_chunks().take(pa.array(begin)), table["tie"].combine_chunks().take(pa.array(begin)), pa.array(blobs, pa.binary())], names=["doc", "tie", "places"])


def find_repeats(texts: DataFrame, find: Find, label: str, *, with_contents: bool, n_parts: int, hot_places: int = HOT_PLACES, step_bytes: int = STEP, most: int = MAX_TEXT, code: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> tuple[DataFrame, np.ndarray, np.ndarray, DataFrame]:
    """Per document of ``texts`` (doc, tie, text) the places whose keys repeat; the hot keys, sorted, and their numbers; and the table to discard once the places have been read.

    ``places`` are u4: twice the place, and one more if its key has other contents.

    Hot keys are those of ``hot_places`` places or more (``with_contents``: of
    distinct contents), of which at most MAX_HOT are named: the bar rises with
    the corpus, so what is broadcast doesn't. With ``code``, places are those of
    what it makes of the texts' rows, in the same worker.
    """
    send = _send(find, n_parts, step_bytes, most)
    sent = texts.mapInArrow(chained(code, send) if code else send, "part int, entries binary, known binary")
    found = materialize(sent.repartitionById(n_parts, F.col("part")).mapInArrow(_decide(hot_places, n_parts, with_contents), FLAGGED), f"{label}-flagged")
    hot = found.where("hot_key IS NOT NULL").groupBy("hot_key").agg(F.sum("hot_count").alias("n"))
    total = hot.agg(F.sum("n")).first()[0] or 0
    named = sorted((r.hot_key & (1 << 64) - 1, r.n) for r in hot.where(F.col("n") >= max(hot_places, total // MAX_HOT)).collect())
    merged = found.where("part IS NOT NULL").select("part", "entries").repartitionById(n_parts, F.col("part")).mapInArrow(_places, "doc long, tie int, places binary")
    return merged, np.array([k for k, _ in named], np.uint64), np.array([n for _, n in named], np.int64), found


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges, as sorted ranges that don't touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    begin = np.flatnonzero(new)
    return starts[begin], ends[np.append(begin[1:], len(starts)) - 1]


def deal_spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray, n_parts: int) -> Iterator[pa.RecordBatch]:
    """Ranges on their way to the partition of their document (DEALT)."""
    table = pa.table({"doc": doc.astype(np.int64), "tie": tie.astype(np.int32), "start": start.astype(np.uint32), "end": end.astype(np.uint32)})
    rows = list(deal(table, target_of(table["doc"].to_numpy(), table["tie"].to_numpy(), n_parts), n_parts))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "entries"])


def _merge_documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = undeal(batches)
    if table is None:
        return
    table, begin, stop = by_document(table)
    start, end = table["start"].to_numpy().astype(np.int64), table["end"].to_numpy().astype(np.int64)
    blobs = [np.stack(merge_spans(start[a:b], end[a:b]), axis=1).astype("<u4").tobytes() for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays([table["doc"].combine_chunks().take(pa.array(begin)), table["tie"].combine_chunks().take(pa.array(begin)), pa.array(blobs, pa.binary())], names=["doc", "tie", "spans"])


def spans_by_document(dealt: DataFrame, n_parts: int) -> DataFrame:
    """(doc, tie, spans): merged ranges of each document, packed as pairs of u4, from dealt ranges."""
    return dealt.repartitionById(n_parts, F.col("part")).mapInArrow(_merge_documents, "doc long, tie int, spans binary")


def unpack_spans(blob: bytes | None) -> list[list[int]]:
    return np.frombuffer(blob or b"", "<u4").reshape(-1, 2).tolist()
