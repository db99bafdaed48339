"""Suffix-array dedup: bytes covered by a 100-byte string that also starts earlier in the corpus.

No string of the wanted length escapes a winnowed anchor: of its 69 windows of
32 bytes, the one with the least hash (the last of several) is kept, which
depends on nothing but the string. Equal strings so have equal anchors at the
same place, and only texts around anchors that repeat are looked at. Those are
sorted as suffixes, rightward from the anchor and leftward, by deep-shallow
sorting; neighbours' common lengths then tell which strings are equal. Every
removal comes from such an order, also that of whole contexts that are equal:
hashes only choose what is sorted together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import claim, letting_go, partitions_of, ragged, steps
from granary.llm.repeats import DEALT, NO_ID, STEP, deal, deal_spans, find_repeats, keyed, merge_spans, spans_by_document, target_of, undeal, unpack_spans
from granary.session import discard, materialize

LENGTH = 100
GRAM = 32
CHUNK = 1 << 20
SHALLOW = 64
POSITION = np.uint64((1 << 24) - 1)
#: Strings around hot anchors that are sorted at a time.
STRINGS = 1 << 17


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    step, factor = 1, 0x100000001B3D4F5
    with np.errstate(over="ignore"):
        while step < GRAM:
            h = h[:-step] * np.uint64(factor) + h[step:]
            step, factor = step * 2, factor * factor % (1 << 64) | 1
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def _chosen(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of ``length`` bytes the place of its anchor; and the hashes by place."""
    h = _gram_hashes(data)
    v = (h & ~POSITION) | (POSITION - np.arange(len(h), dtype=np.uint64))  # of equal ones the last is least
    width, have = length - GRAM + 1, 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    if have < width:
        v = np.minimum(v[: len(v) - (width - have)], v[width - have :])
    return (POSITION - (v & POSITION)).astype(np.int64), h


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place, hash, and first and last start that chose it, of all anchors of all texts."""
    out: list[tuple] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        if size > 2 * CHUNK:  # one long text, in overlapping parts
            data = np.frombuffer(texts[i], np.uint8)
            for at in range(0, max(1, size - length + 1), CHUNK):
                part = data[at : at + CHUNK + length - 1]
                out.append(_some([part], length, i, at))
        else:
            out.append(_some([np.frombuffer(t, np.uint8) for t in texts[i:j]], length, i, 0))
        i = j
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    return tuple(np.concatenate([o[k] for o in out]) for k in range(5))


def _some(parts: list[np.ndarray], length: int, number: int, at: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.concatenate(parts)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    begin = np.cumsum(sizes) - sizes
    place, h = _chosen(data, length)
    n_starts = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(parts)), n_starts)
    start = np.arange(int(n_starts.sum())) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts) + begin[text]
    chosen = place[start]
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])])) if len(start) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(start)) - 1 if len(new) else new
    own = begin[text[new]]
    return text[new] + number, chosen[new] - own + at, h[chosen[new]], start[new] - own + at, start[last] - own + at


def _find(length: int):
    def find(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, None]:
        text, place, h, _, _ = anchors(texts, length)
        return text, place, h, None

    return find


class BlindTrie:
    """Orders strings with long common prefixes: branches hold a depth and one byte per child, and no text.

    To insert, walk down by the bytes at the branches' depths to some leaf,
    compare with that one string, and branch where they first differ.
    """

    def __init__(self, strings: dict[int, bytes]):
        self.strings = strings
        self.root: list | int | None = None  # a leaf is a string's number; a branch is [depth, {byte: child}]
        self.same: dict[int, list[int]] = {}

    def insert(self, number: int) -> None:
        s = self.strings[number]
        if self.root is None:
            self.root = number
            return
        path, node = [], self.root
        while isinstance(node, list):
            path.append(node)
            child = node[1].get(s[node[0]] if node[0] < len(s) else -1)
            if child is None:
                child = next(iter(node[1].values()))
            node = child
        other = self.strings[node]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            self.same.setdefault(node, []).append(number)
            return
        at = 0
        while at < len(path) and path[at][0] < depth:
            at += 1
        mine = s[depth] if depth < len(s) else -1
        if at < len(path) and path[at][0] == depth:
            path[at][1][mine] = number
            return
        below = path[at] if at < len(path) else node
        branch = [depth, {other[depth] if depth < len(other) else -1: below, mine: number}]
        if at == 0:
            self.root = branch
        else:
            up = path[at - 1]
            up[1][s[up[0]] if up[0] < len(s) else -1] = branch

    def order(self) -> list[int]:
        out, stack = [], [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node)
                out += self.same.get(node, [])
        return out


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def multikey_quicksort(words: np.ndarray, sizes: np.ndarray, group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings in order down to ``shallow`` bytes: their numbers, where each one's part of equal strings begins, and how far it is compared.

    A part is split around the middle string's next eight bytes into those
    below, equal and above; the equal ones go on with the eight bytes after.
    All parts take their steps together. ``group`` has the parts to begin with:
    the strings of a group, side by side, are ordered among themselves only.
    """
    n = len(sizes)
    order, depth = np.arange(n), np.zeros(n, np.int64)
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    start = np.repeat(start, np.diff(np.append(start, n)))
    deepest = min(shallow, 8 * words.shape[1])
    while True:
        at = np.flatnonzero(_shared(start) & (depth < deepest))
        if not len(at):
            return order, start, depth
        some, d = order[at], depth[at]
        begin = np.flatnonzero(np.concatenate([[True], start[at][1:] != start[at][:-1]]))
        size = np.diff(np.append(begin, len(at)))
        part = np.repeat(np.arange(len(begin)), size)
        key, left = words[some, d >> 3], np.clip(sizes[some] - d, 0, 8)
        middle = begin + (size >> 1)
        pivot, pivot_left = key[middle][part], left[middle][part]
        same_key = key == pivot
        below = (key < pivot) | (same_key & (left < pivot_left))
        equal = same_key & (left == pivot_left)
        above = ~(below | equal)
        ranks = []
        for side in (below, equal, above):
            count = np.cumsum(side)
            ranks.append(count - 1 - np.concatenate([[0], count])[begin][part])
        n_below, n_equal = np.add.reduceat(below, begin, dtype=np.int64)[part], np.add.reduceat(equal, begin, dtype=np.int64)[part]
        shift = np.where(below, 0, np.where(equal, n_below, n_below + n_equal))
        first = at[begin][part]
        to = first + shift + np.where(below, ranks[0], np.where(equal, ranks[1], ranks[2]))
        order[to], start[to] = some, first + shift
        depth[to] = np.where(equal, np.where(left < 8, 1 << 40, d + 8), d)  # strings that end here are equal to their ends


def sort_suffixes(grid: np.ndarray, sizes: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings (rows of ``grid``, zeros after each one's size) by group, and each one's common prefix with the one before it.

    Multikey quicksort goes ``shallow`` bytes deep; parts still together then
    are ordered by blind tries. A group's first string has no prefix.
    """
    n, width = grid.shape
    order, start, depth = multikey_quicksort(grid.view(">u8").astype(np.uint64), sizes, group, shallow)
    edges = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1], [True]])) if n else np.zeros(1, np.int64)
    deep = (np.diff(edges) > 1) & (depth[edges[:-1]] < 1 << 40) if n else np.zeros(0, bool)
    for a, b in zip(edges[:-1][deep].tolist(), edges[1:][deep].tolist(), strict=True):
        trie = BlindTrie({i: grid[i, : sizes[i]].tobytes() for i in order[a:b].tolist()})
        for i in order[a:b].tolist():
            trie.insert(i)
        order[a:b] = trie.order()
    lcp = np.zeros(n, np.int64)
    for i in range(1, n, 1 << 15):
        j = min(n, i + (1 << 15))
        now, before = order[i:j], order[i - 1 : j - 1]
        differ = grid[now] != grid[before]
        lcp[i:j] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), width), np.minimum(sizes[now], sizes[before]))
    if n:
        lcp[1:][group[order[1:]] != group[order[:-1]]] = 0
    return order, lcp


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of the strings, and each one's common prefix with the one before it."""
    raw = np.frombuffer(b"".join(strings) or b"\0", np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    return sort_suffixes(strings_of(raw, np.cumsum(sizes) - sizes, sizes), sizes, np.zeros(len(sizes), np.int64), shallow)


def strings_of(raw: np.ndarray, at: np.ndarray, sizes: np.ndarray, back: bool = False) -> np.ndarray:
    """Rows of bytes: those from each place on, or (``back``) those before it, last first; zeros after each one's size."""
    width = -(-max(int(sizes.max()) if len(sizes) else 1, 1) // 8) * 8
    steps_ = np.arange(width)
    place = at[:, None] - 1 - steps_ if back else at[:, None] + steps_
    out = raw[np.clip(place, 0, len(raw) - 1)]
    out[steps_ >= sizes[:, None]] = 0
    return out


def same_strings(grid: np.ndarray, sizes: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """A number for each string that equal ones of a group, and no others, share: by the sorted order."""
    order, lcp = sort_suffixes(grid, sizes, group, shallow)
    before, now = order[:-1], order[1:]
    new = (group[now] != group[before]) | (sizes[now] != sizes[before]) | (lcp[1:] < sizes[now])
    out = np.empty(len(order), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(new)])[: len(order)]
    return out


def same_contexts(raw: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each context, ``left`` bytes before a place and ``right`` from it on, the first of its group that equals it."""
    if not len(place):
        return np.zeros(0, np.int64)
    rightward = same_strings(strings_of(raw, place, right), right, group)
    leftward = same_strings(strings_of(raw, place, left, back=True), left, group, 40)
    _, first, inverse = np.unique(rightward * len(place) + leftward, return_index=True, return_inverse=True)
    return first[inverse]


def _shared(group: np.ndarray) -> np.ndarray:
    if not len(group):
        return np.zeros(0, bool)
    same = group[1:] == group[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def _window_hashes(raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place on; it deals strings out and decides nothing."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        x = raw.astype(np.uint64) + np.uint64(1)
        factor = np.uint64(0x5851F42D4C957F2D)
        # Doubling: w[i] covers 2^k bytes from i on; the binary digits of the length put them together.
        width, power, done = 1, factor, 0
        while True:
            if length & width:
                h = h * power + x[np.minimum(at + done, len(x) - 1)]
                done += width
            if width * 2 > length:
                break
            x = x[:-width] * power + x[width:]
            width, power = width * 2, power * power
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


ROWS = [("key", pa.uint64()), ("context", pa.binary()), ("left", pa.int16()), ("doc", pa.int64()), ("tie", pa.int32()), ("place", pa.uint32()), ("stop", pa.uint32())]
#: What ``left`` says of rows that are no context: one string, and a range that goes.
STRING, GONE = -1, -2


def _first_strings(raw: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For strings at ascending places: the place of the first that equals each, and their hashes. STRINGS of them are sorted at a time."""
    h = _window_hashes(raw, at, length)
    by = np.argsort(h, kind="stable")
    first = at.copy()
    carried, i = by[:0], 0
    while i < len(by):
        some = np.concatenate([carried, by[i : i + STRINGS]])
        i += STRINGS
        _, group = np.unique(h[some], return_inverse=True)
        sizes = np.full(len(some), length, np.int64)
        number = same_strings(strings_of(raw, at[some], sizes), sizes, group)
        _, head, inverse = np.unique(number, return_index=True, return_inverse=True)
        first[some] = first[some[head]][inverse]
        carried = some[head][h[some[head]] == h[some[-1]]]  # the rest of these strings may follow
    return first, h


def _contexts(length: int, hot, n_parts: int):
    """Rows for the repeats of some documents: each context once per step, hot anchors by single strings, and ranges that go already."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for step in steps(batches, "text", STEP):
            docs, ties, texts = step.column(0).to_numpy(), step.column(1).to_numpy(), step.column(2).to_pylist()
            by = np.lexsort((ties, docs))  # documents in order, so the first of equal strings is the earliest
            blobs = step.column(3).to_pylist()
            docs, ties, texts = docs[by], ties[by], [texts[i] for i in by]
            raw = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
            origin = np.cumsum([0, *map(len, texts)])
            text, place, h, first, last = anchors(texts, length)
            wanted = np.concatenate([np.zeros(0, np.int64), *[(np.frombuffer(blobs[i], "<u4").astype(np.int64) >> 1) + (k << 33) for k, i in enumerate(by.tolist())]])
            keep = np.flatnonzero(np.isin(place + (text << 33), wanted))
            text, place, h, first, last = (x[keep] for x in (text, place, h, first, last))
            doc, tie = docs[text], ties[text]
            _, key = np.unique(h, return_inverse=True)
            order = np.argsort(key, kind="stable")  # a key's contexts side by side, each in the corpus' order
            head = np.empty(len(order), np.int64)
            head[order] = order[same_contexts(raw, (origin[text] + place)[order], (place - first)[order], (last + length - place)[order], key[order])]
            other = (doc != doc[head]) | (tie != tie[head]) | (place != place[head])  # else the same document in two rows
            gone = [(doc[other], tie[other], first[other], last[other] + length)]
            reps = np.flatnonzero(head == np.arange(len(head)))
            is_hot = np.isin(h[reps], hot.value)
            burst, calm = reps[is_hot], reps[~is_hot]
            contexts = [texts[k][a:b] for k, a, b in zip(text[calm].tolist(), first[calm].tolist(), (last[calm] + length).tolist(), strict=True)]
            parts = [(h[calm] % np.uint64(n_parts), h[calm], contexts, place[calm] - first[calm], doc[calm], tie[calm], place[calm], np.zeros(len(calm), np.int64))]
            if len(burst):
                at = np.sort(ragged((origin[text] + first)[burst], (last - first + 1)[burst]))
                earliest, window = _first_strings(raw, at, length)
                of, of_first = np.searchsorted(origin, at, side="right") - 1, np.searchsorted(origin, earliest, side="right") - 1
                s, s_first = at - origin[of], earliest - origin[of_first]
                again = (docs[of] != docs[of_first]) | (ties[of] != ties[of_first]) | (s != s_first)
                gone.append((docs[of][again], ties[of][again], s[again], s[again] + length))
                own = np.flatnonzero(at == earliest)
                strings = [texts[k][a : a + length] for k, a in zip(of[own].tolist(), s[own].tolist(), strict=True)]
                parts.append((window[own] % np.uint64(n_parts), window[own], strings, np.full(len(own), STRING), docs[of[own]], ties[of[own]], s[own], np.zeros(len(own), np.int64)))
            ranges = _merged(*(np.concatenate([g[i] for g in gone]) for i in range(4)))
            n = len(ranges[0])
            parts.append((target_of(ranges[0], ranges[1], n_parts), np.zeros(n, np.uint64), [None] * n, np.full(n, GONE), *ranges))
            part = np.concatenate([p[0].astype(np.int64) for p in parts])
            if len(part):
                columns = [sum((p[i] for p in parts), []) if i == 2 else np.concatenate([p[i] for p in parts]) for i in range(1, 8)]
                table = pa.table([pa.array(c, t) if isinstance(c, list) else pa.array(c.astype(t.to_pandas_dtype())) for c, (_, t) in zip(columns, ROWS, strict=True)], names=[n for n, _ in ROWS])
                for q, blob in deal(table, part, n_parts):
                    yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32()), pa.array([blob], pa.binary())], names=["part", "entries"])

    return run


def _merged(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The union of ranges of each document."""
    if not len(doc):
        return doc, tie, start, end
    _, number = np.unique(np.stack([doc, tie.astype(np.int64)], axis=1), axis=0, return_inverse=True)
    number = number.ravel()
    shift = number.astype(np.int64) << 31  # places are below 2^30
    _, example = np.unique(number, return_index=True)
    a, b = merge_spans(start + shift, end + shift)
    of = example[a >> 31]
    low = (1 << 31) - 1
    return doc[of], tie[of], a & low, b & low


def _covered(contexts: list[bytes], left: np.ndarray, rank: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(context, least, greatest): strings that start so many bytes before the anchor and have an earlier equal.

    ``rank`` orders the contexts' occurrences in the corpus.
    """
    n = len(contexts)
    right_order, right_lcp = deep_shallow([c[k:] for c, k in zip(contexts, left.tolist(), strict=True)])
    left_order, left_lcp = deep_shallow([c[:k][::-1] for c, k in zip(contexts, left.tolist(), strict=True)], 40)
    fewest = np.array([length - (len(c) - k) for c, k in zip(contexts, left.tolist(), strict=True)], np.int64)
    # Only those whose neighbours in both orders agree for long enough in all can have an equal.
    best_right, best_left = _best(right_order, right_lcp), _best(left_order, left_lcp)
    able = best_right + best_left >= length
    by_rank = np.argsort(rank, kind="stable")
    open_at: dict[int, tuple[int, int]] = {}
    out = []
    for back in range(length - GRAM + 1):
        some = by_rank[(able & (fewest <= back) & (back <= left) & (best_left >= back) & (best_right >= length - back))[by_rank]]
        covered: set[int] = set()
        if len(some) > 1:
            right, leftward = np.empty(n, np.int64), np.empty(n, np.int64)
            right[right_order] = np.cumsum(right_lcp < length - back)
            leftward[left_order] = np.cumsum(left_lcp < back)
            _, first, inverse = np.unique(right[some] * (n + 1) + leftward[some], return_index=True, return_inverse=True)
            covered = set(some[first[inverse] != np.arange(len(some))].tolist())
        for i in [i for i in open_at if i not in covered]:
            out.append((i, *open_at.pop(i)))
        for i in covered:
            open_at[i] = (open_at[i][0], back) if i in open_at else (back, back)
    return out + [(i, a, b) for i, (a, b) in open_at.items()]


def _best(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    return out


def _judge(length: int, n_parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        table = undeal(batches)
        if table is None:
            return
        key, left, doc, tie, place, stop = (table[n].to_numpy().astype(np.uint64 if n == "key" else np.int64) for n in ("key", "left", "doc", "tie", "place", "stop"))
        spans = [(doc[left == GONE], tie[left == GONE], place[left == GONE], stop[left == GONE])]
        order = np.lexsort((place, tie, doc, key))
        for strings in (True, False):
            at = order[left[order] == STRING] if strings else order[left[order] >= 0]
            at = at[_shared(key[at])]
            if not len(at):
                continue
            contexts = table["context"].take(pa.array(at)).combine_chunks()
            contexts = contexts.chunk(0) if isinstance(contexts, pa.ChunkedArray) else contexts
            offsets = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset : contexts.offset + len(at) + 1].astype(np.int64)
            raw = np.frombuffer(contexts.buffers()[2], np.uint8)
            before = np.zeros(len(at), np.int64) if strings else left[at]
            head = same_contexts(raw, offsets[:-1] + before, before, np.diff(offsets) - before, key[at])
            first = at[head]
            other = (doc[at] != doc[first]) | (tie[at] != tie[first]) | (place[at] != place[first])
            begin = place[at] - before
            spans.append((doc[at][other], tie[at][other], begin[other], (begin + np.diff(offsets))[other]))
            some = np.flatnonzero(head == np.arange(len(at)))  # a class of equal contexts goes on by its first
            some = some[_shared(key[at[some]])]
            if strings or not len(some):
                continue
            own = at[some]
            rank = np.empty(len(some), np.int64)
            rank[np.lexsort((place[own], tie[own], doc[own]))] = np.arange(len(some))
            found = _covered([raw[a:b].tobytes() for a, b in zip(offsets[some].tolist(), offsets[some + 1].tolist(), strict=True)], left[own], rank, length)
            if found:
                i, least, greatest = (np.array(c, np.int64) for c in zip(*found, strict=True))
                k = own[i]
                spans.append((doc[k], tie[k], place[k] - greatest, place[k] - least + length))
        yield from deal_spans(*(np.concatenate([s[k] for s in spans]) for k in range(4)), n_parts)

    return run


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **limits) -> DataFrame:
    """(doc, tie, spans): the ranges of bytes that ``length``-byte strings which also start earlier cover.

    Null ids count as the least id. What is sent of a repeat is its context
    (under 2 * length bytes), once per step of a task; around hot anchors it is
    each string, once per step and dealt by its hash, so that no anchor's
    contexts meet in one task.
    """
    if not GRAM < length <= 4 * GRAM:
        raise ValueError(f"length is from {GRAM + 1} to {4 * GRAM}")
    return spans_of(keyed(docs, id_col, text_col), length, **limits)


def spans_of(texts: DataFrame, length: int, *, code: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, **limits) -> DataFrame:
    """The same for rows that are (doc, tie, text) already; with ``code``, for what it makes of them."""
    n_parts = partitions_of(texts)
    flagged, keys, _, scratch = find_repeats(texts, _find(length), "suffix", with_contents=False, n_parts=n_parts, code=code, **limits)
    hot = texts.sparkSession.sparkContext.broadcast(keys)
    coded = texts.mapInArrow(letting_go(code), texts.schema) if code else texts
    rows = coded.join(flagged.hint("shuffle_merge"), ["doc", "tie"]).select("doc", "tie", "text", "places").mapInArrow(letting_go(_contexts(length, hot, n_parts)), DEALT)
    spans = rows.repartitionById(n_parts, F.col("part")).mapInArrow(letting_go(_judge(length, n_parts)), DEALT)
    spans = materialize(spans, "suffix-spans")
    discard(scratch)
    return spans_by_document(spans, n_parts)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False, **limits) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and with ``with_text`` the bytes that stay.

    Strings are judged on the input: a byte goes if it lies in a string of
    ``length`` bytes that also starts at a smaller doc_id, or earlier in the
    same document; overlaps count. Null texts are empty. Rows that repeat both
    id and text are one document and give equal rows; rows of one id with
    different texts are ordered by a hash of the text; null ids come first.
    Empty tables give no rows; other columns are ignored.
    """
    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, length=length, **limits)
    texts = keyed(docs, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            rows = []
            for doc, text, blobs in zip(step.column(0).to_pylist(), step.column(1).to_pylist(), step.column(2).to_pylist(), strict=True):
                ranges = unpack_spans(blobs)
                kept, at = [], 0
                for a, b in ranges:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                rows.append((None if doc == NO_ID else doc, len(text), len(text) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays[: 6 if with_text else 5], names=names[: 6 if with_text else 5])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return texts.join(spans.hint("shuffle_merge"), ["doc", "tie"], "left").select("doc", "text", "spans").mapInArrow(run, schema)
