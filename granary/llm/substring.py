"""Substring dedup: paragraphs that near-repeat, by MinHash banding, exact Jaccard and components.

A paragraph is a line of a text, and each sentence of a line, also the only one:
so passages are also found inside longer paragraphs. All hashing of words,
five-word shingles and minima is done on whole arrays of a step's texts.

A passage need not begin and end where a line or sentence does: runs of 50
words or more that stood earlier word by word are found from word to word by
op10's suffix sorting, over texts in which each word is two bytes of its hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import suffix
from granary.llm.common import STORES, claim, connected_components, fresh, letting_go, partitions_of, ragged, steps
from granary.llm.decontaminate import WORD_BYTES
from granary.llm.repeats import DEALT, NO_ID, STEP, deal, deal_spans, find_repeats, keyed, merge_spans, spans_by_document, target_of, undeal, unpack_spans
from granary.session import discard, materialize

WORDS = 5
SIMILAR = 0.8
#: (bands, rows to a band) of lines and sentences. Texts that aren't copies share hardly a shingle, so one row a band
#: gives few false meetings, and 0.8-similar paragraphs meet in 0.998 and 0.992 of cases.
BANDS = {0: (4, 1), 1: (3, 1)}
MOST = max(b for b, _ in BANDS.values())
#: For corpora in which shorter lines are phrases that clean texts share too: the least words of a run that goes.
PASSAGE_WORDS = 15
#: Contents of a band's key that are compared with each other in one place.
BLOCK = 4096
#: Contents of a bucket up to which it is compared together with others, and shingles of such buckets at a time: at most FEW / 2 times as many pairs.
FEW, ENTRIES = 32, 1 << 17
#: Words of a run that goes wherever it begins and ends, if all of it stood earlier.
RUN_WORDS = 50
CODE_BYTES = 2
#: Bytes from which on a text is an error: places go as 32 bits, of which four are taken for kind, band and marks.
MOST_TEXT = 1 << 28
CHUNK = 1 << 20
LINE, SENTENCE = 0, 1
U = np.uint64
STOPS, SPACES = bytes(b in b".!?" for b in range(256)), np.isin(np.arange(256), list(b" \t\n\r"))


def _mix(x: np.ndarray) -> np.ndarray:
    out = x >> U(30)
    out ^= x
    out *= U(0xBF58476D1CE4E5B9)
    out ^= out >> U(27)
    out *= U(0x94D049BB133111EB)
    out ^= out >> U(31)
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_FACTOR = 0x5851F42D4C957F2D


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2^64."""
    size = 1 << max(CHUNK.bit_length(), (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = tuple(np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(f), U)]), dtype=U) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))
    return _POWERS[size]


def _let_go(own: tuple) -> bool:
    there = bool(_POWERS)
    _POWERS.clear()
    return there


STORES.append(_let_go)


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined by line ends, where each begins, and the first byte, end and hash of every word."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    plain = np.frombuffer(raw.tobytes().translate(WORD_BYTES), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    inside = np.zeros(len(plain) + 2, bool)
    np.not_equal(plain, 0x20, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    power, inverse = _powers(len(raw) + 1)
    value = plain.astype(U)
    value += U(1)
    value *= power[: len(plain)]
    sums = np.zeros(len(plain) + 1, U)
    np.cumsum(value, out=sums[1:])
    return raw, begin, first, last, _mix((sums[last] - sums[first]) * inverse[first])


class Paragraphs:
    """The paragraphs of some texts that have at least WORDS words: text, kind, byte range, content id (two hashes), keys and shingles."""

    def __init__(self, texts: list[bytes]):
        with np.errstate(over="ignore"):
            self._read(texts)

    def _read(self, texts: list[bytes]) -> None:
        raw, begin, first, last, word = _words(texts)
        newline = np.flatnonzero(raw == 0x0A)
        stop = np.flatnonzero(np.frombuffer(raw.tobytes().translate(STOPS), bool))
        stop = stop[SPACES[raw[stop + 1]]]  # the last byte is a line end

        def passed(places: np.ndarray) -> np.ndarray:
            """How many of the places lie before each word."""
            return np.cumsum(np.bincount(np.searchsorted(first, places), minlength=len(first) + 1))[: len(first)]

        line = passed(newline)
        sentence = line + passed(stop)
        shingle = np.zeros(max(0, len(word) - WORDS + 1), U)
        for k in range(WORDS):
            shingle = shingle * U(_FACTOR) + word[k : len(word) - WORDS + 1 + k]
        shingle = _mix(shingle)
        parts = []
        mixed: dict[int, np.ndarray] = {}
        for kind, number in ((LINE, line), (SENTENCE, sentence)):
            if not len(word):
                continue
            head = np.flatnonzero(_new(number))
            count = np.diff(np.append(head, len(word)))
            placed = (np.arange(len(word)) - np.repeat(head, count)).astype(U)
            placed *= U(0x9E3779B97F4A7C15)
            placed += word
            placed += U(kind + 1)
            content = _mix(np.add.reduceat(_mix(placed), head) + count.astype(U))
            check = _mix(np.add.reduceat(_mix(placed ^ U(0xD1342543DE82EF95)), head) ^ count.astype(U))
            keep = count >= WORDS
            head, count, content, check = head[keep], count[keep], content[keep], check[keep]
            if not len(head):
                continue
            n_shingles = count - WORDS + 1
            cuts = np.stack([head, head + n_shingles], axis=1).ravel()
            bands, rows = BANDS[kind]
            keys = []
            for b in range(bands):
                key = np.full(len(head), U(kind * 64 + b + 1), U)
                for r in range(rows):
                    seed = 0xA24BAED4963EE407 * (b * rows + r + 1) % (1 << 64)
                    if seed not in mixed:
                        mixed[seed] = np.append(_mix(shingle ^ U(seed)), U(0))  # a last paragraph's shingles end before it
                    key = _mix(key * U(_FACTOR) + np.minimum.reduceat(mixed[seed], cuts)[::2])
                keys.append(key)
            text = np.searchsorted(begin, first[head], side="right") - 1
            parts.append((text, np.full(len(head), kind), first[head] - begin[text], last[head + count - 1] - begin[text], content, np.stack(keys + [keys[0]] * (MOST - bands), axis=1), head, n_shingles, check))
        self.shingle = shingle
        columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros((0, MOST) if i == 5 else 0, U if i in (4, 5, 8) else np.int64) for i in range(9)]
        self.text, self.kind, self.start, self.end, self.content, self.keys, self._head, self._n, self.check = columns
        self.place = self.start * 2 + self.kind

    def __len__(self) -> int:
        return len(self.text)

    def shingles(self, some: np.ndarray) -> pa.Array:
        """The hashes of the distinct shingles of each of some paragraphs, sorted."""
        n = self._n[some]
        flat, owner = self.shingle[ragged(self._head[some], n)], np.repeat(np.arange(len(some)), n)
        flat = flat[np.lexsort((flat, owner))]
        new = _new(owner, flat)
        offsets = 8 * np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(some)))])
        return pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat[new], "<u8"))])


def _new(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before."""
    return np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]) if len(columns[0]) else np.zeros(0, bool)


def _first_equal(*columns: np.ndarray) -> np.ndarray:
    """The first row that equals each one."""
    order = np.lexsort(columns)
    new = _new(*(c[order] for c in columns))
    out = np.empty(len(order), np.int64)
    out[order] = order[new][np.cumsum(new) - 1]
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known ones, that are in order."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, Paragraphs]]:
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        yield i, Paragraphs(texts[i:j])
        i = j


def find_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place (with the band in its two lowest bits), key and content of every band of every paragraph."""
    text, place, key, content = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)], [np.zeros(0, U)]
    for shift, p in _groups(texts):
        for kind, (bands, _) in BANDS.items():
            some = np.flatnonzero(p.kind == kind)
            for b in range(bands):
                text.append(p.text[some] + shift)
                place.append(p.place[some] * 4 + b)
                key.append(p.keys[some, b])
                content.append(p.content[some])
    return np.concatenate(text), np.concatenate(place), np.concatenate(key), np.concatenate(content)


BUCKET = [("key", pa.uint64()), ("content", pa.uint64()), ("check", pa.uint64()), ("shingles", pa.binary()), ("doc", pa.int64()), ("tie", pa.int32()), ("start", pa.uint32()), ("end", pa.uint32())]
#: Rows of ``kind``: 0 a paragraph in a bucket, 1 the first place of a content in a step, 2 a range that goes already.
MEMBER, FIRST, GONE = 0, 1, 2


def buckets_of(key: int, content: int, blocks: int) -> list[int]:
    """Where a content meets the others of its band's key: in one place, or in one for each two blocks of a hot key's contents."""
    if blocks < 2:
        return [key]
    own = content % blocks
    cells = ((min(own, other), max(own, other)) for other in range(blocks) if other != own)
    return [int.from_bytes(hashlib.blake2b(b"%d %d %d" % (key, i, j), digest_size=8).digest(), "little") for i, j in cells]


def _collide(n_parts: int, hot):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        blocks = dict(zip(*(x.tolist() for x in hot.value), strict=True))
        for step in steps(batches, "text", STEP):
            docs, ties, texts, blobs = step.column(0).to_numpy(), step.column(1).to_numpy(), step.column(2).to_pylist(), step.column(3).to_pylist()
            by = np.lexsort((ties, docs))
            docs, ties, texts = docs[by], ties[by], [texts[i] for i in by]
            told = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(blobs[i], "<u4").astype(np.int64) + (k << 34) for k, i in enumerate(by.tolist())]])
            wanted, mixed = told >> 3, told[told & 1 == 1] >> 1
            places, members, shingles = [], [], []
            for shift, p in _groups(texts):
                name = p.place + (p.text + shift << 31)
                at = np.flatnonzero(_among(name, wanted))
                places.append((p.text[at] + shift, p.start[at], p.end[at], p.content[at], p.check[at]))
                # Only in buckets that hold another content is there anything to compare.
                compared = np.stack([_among(name[at] * 4 + b, mixed) for b in range(MOST)], axis=1)
                row, band = np.nonzero(compared)
                if not len(row):
                    continue
                row = at[row]
                row, band = (x[_first_equal(p.check[row], p.content[row], p.keys[row, band]) == np.arange(len(row))] for x in (row, band))
                first = _first_equal(p.check[row], p.content[row])
                heads, number = np.unique(first, return_inverse=True)
                members.append((p.keys[row, band], p.content[row], p.check[row], number + sum(map(len, shingles))))
                shingles.append(p.shingles(row[heads]))
            text, start, end, content, check = (np.concatenate(c) for c in zip(*places, strict=True))
            doc, tie, first = docs[text], ties[text], _first_equal(check, content)
            head = first == np.arange(len(first))
            gone = ~head & ((doc != doc[first]) | (tie != tie[first]) | (start != start[first]) | (end != end[first]))  # else the same document in two rows
            rows = [(content[head] % U(n_parts), FIRST, 0, content[head], check[head], None, doc[head], tie[head], start[head], end[head])]
            rows.append((target_of(doc[gone], tie[gone], n_parts), GONE, 0, 0, 0, None, doc[gone], tie[gone], start[gone], end[gone]))
            if members:
                key, content, check, number = (np.concatenate(c) for c in zip(*members, strict=True))
                some = np.flatnonzero(_first_equal(check, content, key) == np.arange(len(key)))
                key, content, check, number = key[some], content[some], check[some], number[some]
                if blocks:
                    buckets = [buckets_of(k, c, blocks.get(k, 1)) for k, c in zip(key.tolist(), content.tolist(), strict=True)]
                    some = np.repeat(np.arange(len(key)), list(map(len, buckets)))
                    key, content, check, number = np.fromiter((b for own in buckets for b in own), U, len(some)), content[some], check[some], number[some]
                rows.append((key % U(n_parts), MEMBER, key, content, check, pa.concat_arrays(shingles).take(pa.array(number)), 0, 0, 0, 0))
            part = np.concatenate([r[0].astype(np.int64) for r in rows])
            if not len(part):
                continue
            columns = [[pa.nulls(len(r[0]), t) if c is None else c if isinstance(c, pa.Array) else pa.array(np.broadcast_to(np.asarray(c), len(r[0])).astype(t.to_pandas_dtype()), t) for r in rows for c in [r[i]]] for i, t in enumerate((pa.int8(), *[t for _, t in BUCKET]), 1)]
            table = pa.table([pa.concat_arrays(c) for c in columns], names=["kind", *[n for n, _ in BUCKET]])
            for q, blob in deal(table, part, n_parts):
                yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32()), pa.array([blob], pa.binary())], names=["part", "entries"])

    return run


def link_sets(sets: list[np.ndarray], similar: float) -> list[tuple[int, int]]:
    """Links that join all sets which pairs of Jaccard similarity ``similar`` or more join.

    Sets outside one component, ``largest``, are compared with all by an
    inverted index, so no link from or to any of them is missed; links within
    that component can't join anything more. When another component takes its
    place, the sets that were skipped in the old one are looked at again.
    """
    n = len(sets)
    root, members = list(range(n)), [1] * n

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            members[min(a, b)] += members[max(a, b)]
            links.append((i, j))

    sizes = np.array([len(s) for s in sets])
    if n <= 4:
        python = [set(s.tolist()) for s in sets]
        for i in range(n):
            for j in range(i + 1, n):
                both = len(python[i] & python[j])
                if both >= similar * (len(python[i]) + len(python[j]) - both):
                    join(i, j)
        return links
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, token = np.unique(flat, return_inverse=True)
    order = np.argsort(token, kind="stable")
    owners = owner[order]
    begin = np.searchsorted(token[order], np.arange(int(token.max()) + 2))
    at = np.cumsum(sizes) - sizes
    todo = list(range(n - 1, -1, -1))
    middle = int(np.median(sizes))
    todo.sort(key=lambda i: abs(int(sizes[i]) - middle), reverse=True)
    largest, skipped = -1, []
    while todo:
        i = todo.pop()
        if largest >= 0 and find(i) == find(largest):
            skipped.append(i)
            continue
        mine = token[at[i] : at[i] + sizes[i]]
        spans = begin[mine + 1] - begin[mine]
        hits = owners[np.repeat(begin[mine] - (np.cumsum(spans) - spans), spans) + np.arange(int(spans.sum()))]
        both = np.bincount(hits, minlength=n)
        for j in np.flatnonzero(both >= similar * (sizes + sizes[i] - both)).tolist():
            join(i, j)
        if largest < 0:
            largest = i
        elif members[find(i)] > 2 * members[find(largest)]:
            largest = i
            todo += skipped
            skipped = []
    return links


def link_buckets(flat: np.ndarray, sizes: np.ndarray, bucket: np.ndarray, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets of a bucket, side by side, whose Jaccard similarity is ``similar`` or more.

    ``flat`` has the sets one after another. An inverted index brings together
    those that share anything; ENTRIES entries of whole buckets are taken at a time.
    """
    ends = np.cumsum(sizes)
    last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) if len(bucket) else np.zeros(0, np.int64)
    found = [(np.zeros(0, np.int64),) * 2]
    begin = 0
    while begin < len(sizes):
        base = ends[begin] - sizes[begin]
        to = np.searchsorted(ends[last], base + ENTRIES, side="right") - 1
        stop = last[max(to, np.searchsorted(last, begin))] + 1
        own = sizes[begin:stop]
        owner = np.repeat(np.arange(stop - begin), own)
        shared, group = flat[base : ends[stop - 1]], bucket[begin:stop][owner]
        order = np.lexsort((shared, group))  # equal ones in the order of their sets
        owner, new = owner[order], np.flatnonzero(_new(group[order], shared[order]))
        size = np.diff(np.append(new, len(order)))
        after = np.repeat(new + size, size) - np.arange(len(order)) - 1  # an entry's equals behind it
        pair = np.repeat(owner, after) * (stop - begin) + owner[ragged(np.arange(1, len(order) + 1), after)]
        pair, both = np.unique(pair, return_counts=True)
        i, j = pair // (stop - begin), pair % (stop - begin)
        enough = both >= similar * (own[i] + own[j] - both)
        found.append((i[enough] + begin, j[enough] + begin))
        begin = stop
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _judge(n_parts: int, similar: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        table = undeal(batches)
        if table is None:
            return
        kind = table["kind"].to_numpy()
        members = table.filter(pa.array(kind == MEMBER))
        key, content, check = (members[n].to_numpy() for n in ("key", "content", "check"))
        order = np.lexsort((check, content, key))
        links: list[np.ndarray] = []
        if len(order):
            order = order[_new(key[order], content[order], check[order])]
            begin = np.flatnonzero(_new(key[order]))
            size = np.diff(np.append(begin, len(order)))
            named = np.stack([content, check], axis=1)
            few = order[np.repeat((size > 1) & (size <= FEW), size)]
            sets = members["shingles"].take(pa.array(few))
            i, j = link_buckets(np.frombuffer(b"".join(sets.to_pylist()), "<u8"), pc.binary_length(sets).to_numpy().astype(np.int64) >> 3, key[few], similar)
            links.append(np.concatenate([named[few[i]], named[few[j]]], axis=1))
            for a, n in zip(begin[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
                own = order[a : a + n]
                sets = [np.frombuffer(x, "<u8") for x in members["shingles"].take(pa.array(own)).to_pylist()]
                i, j = np.array(link_sets(sets, similar), np.int64).reshape(-1, 2).T
                links.append(np.concatenate([named[own[i]], named[own[j]]], axis=1))
        pairs = np.concatenate([np.zeros((0, 4), U), *links])
        pairs = pairs[_first_equal(*pairs.T) == np.arange(len(pairs))].view(np.int64)
        if len(pairs):
            yield _found(len(pairs), **{n: pa.array(np.ascontiguousarray(pairs[:, i])) for i, n in enumerate(("content", "check", "other", "other_check"))})
        firsts = table.filter(pa.array(kind == FIRST))
        if firsts.num_rows:
            columns = [*(firsts[n].to_numpy().view(np.int64) for n in ("content", "check")), *(firsts[n].to_numpy().astype(np.int64) for n in ("doc", "tie", "start", "end"))]
            yield _found(firsts.num_rows, **{n: pa.array(c, pa.int32() if n == "tie" else pa.int64()) for n, c in zip(("content", "check", "doc", "tie", "start", "end"), columns, strict=True)})
        gone = table.filter(pa.array(kind == GONE))
        if gone.num_rows:
            for batch in deal_spans(*(gone[n].to_numpy().astype(np.int64) for n in ("doc", "tie", "start", "end")), n_parts):
                yield _found(batch.num_rows, part=batch.column(0), entries=batch.column(1))

    return run


FOUND = "content long, check long, other long, other_check long, doc long, tie int, start long, end long, part int, entries binary"
_FOUND_TYPES = {"content": pa.int64(), "check": pa.int64(), "other": pa.int64(), "other_check": pa.int64(), "doc": pa.int64(), "tie": pa.int32(), "start": pa.int64(), "end": pa.int64(), "part": pa.int32(), "entries": pa.binary()}


def _found(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, t)) for name, t in _FOUND_TYPES.items()], names=list(_FOUND_TYPES))


def repeated_paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, block: int = BLOCK, **limits) -> DataFrame:
    """(doc, tie, spans): the byte ranges of paragraphs that are not the first of their component.

    Paragraphs of the same words are one content, known by 128 bits of hashes;
    contents link where bands collide and the Jaccard similarity of their
    five-word shingles is ``similar`` or more. What stays is each component's
    first place by id and position. A step of a task sends each content on
    once, however often it holds it, so a passage in a third of all documents
    isn't gathered anywhere; a band's key of over ``block`` contents is compared
    in as many places as it has pairs of blocks, so none is held whole.
    """
    n_parts = partitions_of(docs)
    texts = keyed(docs, id_col, text_col)
    flagged, keys, counts, scratch = find_repeats(texts, find_keys, "paragraph", with_contents=True, n_parts=n_parts, hot_places=block + 1, most=MOST_TEXT, **limits)
    hot = docs.sparkSession.sparkContext.broadcast((keys, -(-counts // block)))
    rows = texts.join(flagged.hint("shuffle_merge"), ["doc", "tie"]).select("doc", "tie", "text", "places").mapInArrow(letting_go(_collide(n_parts, hot)), DEALT)
    found = materialize(rows.repartitionById(n_parts, F.col("part")).mapInArrow(letting_go(_judge(n_parts, similar)), FOUND), "paragraph-found")
    discard(scratch)
    # Contents that link get a number of their own, as a component's node is one long.
    links = found.where("other IS NOT NULL").select("content", "check", "other", "other_check")
    ends = links.select("content", "check").unionByName(links.selectExpr("other AS content", "other_check AS check")).distinct()
    numbers = materialize(ends.withColumn("node", F.monotonically_increasing_id()), "paragraph-nodes")
    others = numbers.selectExpr("content AS other", "check AS other_check", "node AS dst")
    components = connected_components(links.join(numbers, ["content", "check"]).join(others, ["other", "other_check"]).selectExpr("node AS src", "dst"), "paragraph")
    linked = numbers.join(components, "node", "left").select("content", "check", F.coalesce("component", "node").alias("component"))
    firsts = found.where("doc IS NOT NULL").select("content", "check", F.struct("doc", "tie", "start", "end").alias("own"))
    heads = firsts.groupBy("content", "check").agg(F.min("own").alias("own"))
    grouped = materialize(heads.join(linked, ["content", "check"], "left"), "paragraph-contents")
    keepers = materialize(grouped.where("component IS NOT NULL").groupBy("component").agg(F.min("own").alias("keeper")), "paragraph-keepers")
    kept = grouped.join(keepers, "component", "left").select("content", "check", F.coalesce("keeper", "own").alias("keeper"))
    kept = materialize(kept, "paragraph-kept")
    gone = firsts.join(kept, ["content", "check"]).where("own <> keeper").select("own.doc", "own.tie", "own.start", "own.end")

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from deal_spans(*(np.concatenate([b.column(i).to_numpy() for b in held]).astype(np.int64) for i in range(4)), n_parts)

    spans = gone.mapInArrow(send, DEALT).unionByName(found.where("part IS NOT NULL").select("part", "entries"))
    spans = materialize(spans, "paragraph-spans")
    discard(found, numbers, grouped, keepers, kept)
    return spans_by_document(spans, n_parts)


def _runs(text: bytes, spans: list[list[int]], min_words: int) -> list[tuple[int, int]]:
    """Spans joined over gaps too short to be paragraphs; those of fewer words than ``min_words`` stay in the text."""
    out: list[list[int]] = []
    for a, b in spans:
        if out and len(text[out[-1][1] : a].translate(WORD_BYTES).split()) < WORDS and text.count(b"\n", out[-1][1], a) < 2:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    runs = []
    for a, b in out:
        if len(text[a:b].translate(WORD_BYTES).split()) < min_words:
            continue
        while b < len(text) and text[b] in b".!?,;:\"')":
            b += 1
        while b < len(text) and text[b] in b" \t\r\n":
            b += 1
        runs.append((a, b))
    return runs


def _coded(step: pa.RecordBatch) -> pa.RecordBatch:
    """Texts as CODE_BYTES bytes of each word's hash."""
    texts = step.column(2).to_pylist()
    with np.errstate(over="ignore"):
        _, begin, first, _, word = _words(texts)
    codes = (word >> U(64 - 8 * CODE_BYTES)).astype("<u2")
    cuts = np.append(np.searchsorted(first, begin), len(first)).tolist()
    return pa.RecordBatch.from_arrays([step.column(0), step.column(1), pa.array([codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["doc", "tie", "text"])


def _code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim()
    yield from map(_coded, steps(batches, "text", CHUNK))


def repeated_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tie, spans): ranges of the coded text that windows of RUN_WORDS words which also start earlier cover."""
    return suffix.spans_of(keyed(docs, id_col, text_col), RUN_WORDS * CODE_BYTES, code=_code)


def _with_runs(text: bytes, spans: list[list[int]], runs: list[list[int]]) -> list[list[int]]:
    """The spans and those of whole words of the coded ranges that hold RUN_WORDS words or more."""
    whole = [(-(-a // CODE_BYTES), b // CODE_BYTES) for a, b in runs]
    whole = [(i, j) for i, j in whole if j - i >= RUN_WORDS]
    if not whole:
        return spans
    plain = np.frombuffer(text.translate(WORD_BYTES), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], plain != 0x20, [False]]).astype(np.int8)))
    every = np.array([*spans, *([edges[2 * i], edges[2 * j - 1]] for i, j in whole)], np.int64)
    return np.stack(merge_spans(every[:, 0], every[:, 1]), axis=1).tolist()


def remove_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """As ``remove_paragraphs``, and also runs of RUN_WORDS words or more that stood earlier, wherever they begin and end."""
    return remove_paragraphs(docs, id_col=id_col, text_col=text_col, runs=repeated_runs(docs, id_col=id_col, text_col=text_col), **options)


def remove_paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, min_words: int = WORDS, runs: DataFrame | None = None, **limits) -> DataFrame:
    """All columns of ``docs`` with repeated passages cut out of the text, and n_removed (bytes) and n_spans.

    Paragraphs have WORDS words, a shingle's, or more; all that aren't the first
    of their component go. With a larger ``min_words`` only runs of neighbouring
    repeated paragraphs go that hold so many words in all.

    A text without a repeat, or null, comes back as it is. Rows that repeat id
    and text are one document and are cut alike; rows of one id with different
    texts are ordered by a hash of the text; null ids come first. Texts may be
    of any length below MOST_TEXT, from which on the query fails. Empty tables give
    no rows. Columns named n_removed or n_spans in the input are replaced; all
    others come back, whatever their names. Ranges of ``runs`` (see
    ``repeated_runs``) are cut too.
    """
    spans = repeated_paragraphs(docs, id_col=id_col, text_col=text_col, similar=similar, **limits)
    runs = runs if runs is not None else spans.where("1 = 0")
    spans = spans.join(runs.withColumnRenamed("spans", "runs").hint("shuffle_merge"), ["doc", "tie"], "full")
    docs = docs.drop("n_removed", "n_spans")
    own = {name: fresh(docs, name) for name in ("doc", "tie", "spans", "runs")}
    spans = spans.select(*[F.col(name).alias(alias) for name, alias in own.items()])
    doc = F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID))
    tie = F.hash(F.coalesce(docs[text_col].cast("binary"), F.lit(b"")))
    joined = docs.join(spans.hint("shuffle_merge"), (doc == spans[own["doc"]]) & (tie == spans[own["tie"]]), "left").drop(own["doc"], own["tie"])
    names = joined.columns
    place, spans_at, runs_at = names.index(text_col), names.index(own["spans"]), names.index(own["runs"])
    rest = [f for f in joined.schema.fields if f.name not in (own["spans"], own["runs"])]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", n_removed long, n_spans long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text_col):
            texts, removed, counts = [], [], []
            for text, blob, coded in zip(step.column(place).cast(pa.binary()).to_pylist(), step.column(spans_at).to_pylist(), step.column(runs_at).to_pylist(), strict=True):
                cuts = _runs(text, _with_runs(text, unpack_spans(blob), unpack_spans(coded)), min_words) if text is not None else []
                kept, at = [], 0
                for a, b in cuts:
                    kept.append(text[at:a])
                    at = b
                whole = None if text is None else b"".join([*kept, text[at:]])
                texts.append(None if whole is None else whole.decode("utf-8", "replace"))
                removed.append(0 if text is None else len(text) - len(whole))
                counts.append(len(cuts))
            columns = [pa.array(texts, pa.string()) if i == place else step.column(i) for i in range(len(names)) if i not in (spans_at, runs_at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64()), pa.array(counts, pa.int64())], names=[f.name for f in rest] + ["n_removed", "n_spans"])

    return joined.mapInArrow(letting_go(run), schema)
