"""Token files: ids coded by an adaptive context-mixing range coder, in blocks that stand alone.

A block holds a run of ids in ``lanes`` equal parts that are coded in step,
each by its own range coder, all with one model that starts empty in every
block. Three predictions share the range of an id that follows the ids b and a
(a the nearer):

    w2        order 2: the id that last followed b and a;
    w1 P1     order 1: the ids that followed a so far, by how often each did;
    w0 P0     order 0: all ids, by how often each came so far.

The weights add up to the whole and are learned: w2 by how often b and a were
seen and the last follower was right, w1 by how many of a's followers were new
ones and whether a is frequent. An id is coded in the part where it has most
room. The model is brought up to date when the block has doubled, on both
sides alike, so a whole round of ids is looked up at once. All arithmetic is in
whole numbers, or in quotients of doubles that are exact, so any machine decodes
what another has coded. A header has counts and checksums of payload and ids.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.common import claim, partitions_of, steps
from granary.llm.tokens import tokenizer
from granary.session import materialize, scratch_path

MAGIC = b"GTB1"
HEADER = struct.Struct("<4sIIIII")  # magic, ids, lanes, alphabet, checksum of the payload, checksum of the ids
BLOCK_IDS = 1 << 20
#: Bytes of text tokenized at a time.
TEXT_STEP = 18 << 20
#: Words that a worker keeps.
WORDS = 1_300_000
MAX_LANES = 4096
LANE_IDS = 64
#: Bits of a step's whole range, of which the lower ones are for a prediction's parts and the others for weights.
TOTAL_BITS, PART_BITS = 32, 20
PART, WEIGHT = 1 << PART_BITS, 1 << TOTAL_BITS - PART_BITS
#: The largest w2, and the largest share of the rest that w1 takes, which leave every id some room.
MOST_W2, MOST_W1 = WEIGHT - 64, WEIGHT - 64
#: A smaller w2 isn't worth its room.
LEAST_W2 = WEIGHT // 10
HASH_BITS = 16
#: Slots of P1 for each id that followed, at least, and bits of them at most.
FINE, MOST_FINE = 3, 19
#: Of the ids that order 1 and 0 coded, each so-many-th is learned from.
LEARN = 4
#: How much more an id that was seen counts than one that wasn't.
SEEN = 24
U = np.uint64
_16, _48, _T = U(16), U(48), U(TOTAL_BITS)
_BOTTOM, _LOW32, _LOW48 = U(1 << 32), U((1 << 32) - 1), U((1 << 48) - 1)


class CorruptBlock(ValueError):
    """A block's bytes don't agree with its checksums."""


def lanes_of(n: int) -> tuple[int, int]:
    """Lanes and steps for n ids."""
    lanes = min(MAX_LANES, max(1, n // LANE_IDS))
    return lanes, -(-n // lanes)


def rounds_of(length: int) -> list[int]:
    """The steps at which the model is brought up to date, from 0 to ``length``."""
    out = [0]
    while out[-1] < length:
        out.append(min(length, max(1, 2 * out[-1])))
    return out


def _divided(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """part // whole for whole numbers below 2^40 and 2^21: at such sizes the quotient of doubles is never rounded up to the next."""
    return np.floor(part / whole.astype(np.float64)).astype(np.int64)


class _Model:
    """What a block's coder and decoder both know of the ids before a round. Pairs are ``before * alphabet + id``."""

    def __init__(self, alphabet: int):
        if alphabet > PART >> 1:
            raise ValueError(f"ids must be below {PART >> 1}")
        self.alphabet = alphabet  # also stands for no id before
        self.counts = np.ones(alphabet, np.int64)
        self.times, self.kinds = np.zeros(alphabet + 1, np.int64), np.zeros(alphabet + 1, np.int64)
        self.bin_w1, self.w1 = np.full(64, WEIGHT // 2), np.zeros(alphabet + 1, np.int64)
        self.successor, self.seen, self.right = (np.zeros(1 << HASH_BITS, np.int32) for _ in range(3))
        self.context, self.bin_w2 = np.zeros(1 << HASH_BITS, np.uint8), np.zeros(64, np.int64)
        self.tried, self.hit = np.full(64, 4), np.full(64, 1)
        self._spread()

    def _spread(self) -> None:
        sums = np.concatenate([[0], np.cumsum(self.counts)])
        self.order0 = sums * (PART - self.alphabet) // sums[-1] + np.arange(self.alphabet + 1)

    def slots(self, before2: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where order 2 keeps what followed two ids."""
        h = before2.astype(np.uint32) * np.uint32(0x9E3779B1) + before.astype(np.uint32) * np.uint32(0x85EBCA6B)
        return ((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - HASH_BITS)).astype(np.int64)

    def fineness(self) -> np.ndarray:
        """Bits of P1's slots after each id."""
        return np.minimum(np.frexp(self.kinds.astype(float))[1] + FINE, MOST_FINE)

    def order1(self, own: np.ndarray, times: np.ndarray, head: np.ndarray, fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P1's first slot and number of slots for each pair, by what stood before (``own``), how often it was seen, and where a's pairs begin."""
        there = times > 0
        sums, ranks = np.concatenate([[0], np.cumsum(times)]), np.concatenate([[0], np.cumsum(there)])
        first = head[own]
        below, rank = sums[:-1] - sums[first], ranks[:-1] - ranks[first]
        room, whole = (1 << fine[own]) - self.kinds[own], np.maximum(self.times[own], 1)
        low = _divided(below * room, whole) + rank
        return low, np.where(there, _divided((below + times) * room, whole) + rank + 1 - low, 0)

    def weights(self, before: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w2 = self.bin_w2.take(self.context.take(slot))
        return w2, (WEIGHT - w2) * self.w1.take(before) >> TOTAL_BITS - PART_BITS

    def update(self, before: np.ndarray, slot: np.ndarray, ids: np.ndarray, fresh: np.ndarray, order: np.ndarray) -> None:
        """Learn a round: the ids with what stood before them, the new pairs, and the order by which each id was coded."""
        some = np.flatnonzero(order < 2)[::LEARN]
        a = before[some]
        known = self.times[a] > 0
        bins = self._bins(a)[known]
        gained, tried = np.bincount(bins[order[some][known] == 1], minlength=64), np.bincount(bins, minlength=64)
        self.bin_w1 = np.minimum((gained * WEIGHT + 20 * self.bin_w1) // (tried + 20), MOST_W1)
        hit = self.successor[slot] == ids
        context = self.context[slot]
        self.tried += np.bincount(context, minlength=64)
        self.hit += np.bincount(context[hit], minlength=64)
        self.counts += SEEN * np.bincount(ids, minlength=self.alphabet)
        self._spread()
        self.times += np.bincount(before, minlength=self.alphabet + 1)
        self.kinds += np.bincount(fresh // self.alphabet, minlength=self.alphabet + 1)
        self.w1 = np.where(self.times > 0, self.bin_w1[self._bins(slice(None))], 0)
        self.right += np.bincount(slot[hit], minlength=len(self.right)).astype(np.int32)
        self.seen += np.bincount(slot, minlength=len(self.seen)).astype(np.int32)
        self.successor[slot] = ids  # of several the last
        self.context[:] = np.minimum(self.seen, 7) * 8 + np.minimum(self.right, 7)
        of_bin = np.minimum(self.hit * WEIGHT // (self.tried + 1), MOST_W2)
        self.bin_w2 = np.where((of_bin < LEAST_W2) | (np.arange(64) < 8), 0, of_bin)

    def _bins(self, a: np.ndarray | slice) -> np.ndarray:
        """Contexts of w1: how much of a's followers were no new ones, and whether a is frequent."""
        times = self.times[a]
        return times * 32 // (times + self.kinds[a] + 1) + 32 * (times > 64)


def _grow(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which lanes must move 16 bits out; where a small range straddles a border it is cut at the border."""
    settled = (low ^ (low + size)) >> _48 == 0
    small = size < _BOTTOM
    cut = small & ~settled
    if cut.any():
        size[cut] = (U(0) - low[cut]) & _LOW32
        settled |= cut
    return np.flatnonzero(settled)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, each key's number among them, and which keys are the first of their kind."""
    n = len(keys)
    bits = max(1, (n - 1).bit_length())
    both = np.sort(keys << bits | np.arange(n))
    key, place = both >> bits, both & ((1 << bits) - 1)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    number, first = np.empty(n, np.int64), np.zeros(n, bool)
    number[place] = np.cumsum(new) - 1
    first[place[new]] = True
    return key[new], number, first


def encode_block(ids: np.ndarray, alphabet: int) -> bytes:
    """A block of ids, each below ``alphabet``."""
    ids = np.ascontiguousarray(ids, np.int32)
    n = len(ids)
    check = zlib.crc32(ids.astype("<u4").tobytes())
    if not n:
        return HEADER.pack(MAGIC, 0, 0, alphabet, 0, check)
    lanes, length = lanes_of(n)
    padded = np.zeros(lanes * length, np.int64)
    padded[:n] = ids
    by_step = padded.reshape(lanes, length).T
    active = -(-(n - np.arange(length)) // length)  # lanes that have a step's id: the first ones
    begin = np.concatenate([[0], np.cumsum(active)])
    x = np.concatenate([by_step[t, :a] for t, a in enumerate(active.tolist())])
    before, before2 = np.full(n, alphabet, np.int64), np.full(n, alphabet, np.int64)
    for t in range(1, length):
        at, was = slice(begin[t], begin[t + 1]), slice(begin[t - 1], begin[t - 1] + active[t])
        before[at], before2[at] = x[was], before[was]
    model = _Model(alphabet)
    pairs, number, first = _numbered(before * alphabet + x)
    own, head = pairs // alphabet, np.searchsorted(pairs, np.arange(alphabet + 1) * alphabet)  # a's first pair
    slots = model.slots(before2, before)
    times, low1, n1 = (np.zeros(len(pairs), np.int64) for _ in range(3))
    low, size = np.zeros(lanes, U), np.full(lanes, U((1 << 64) - 1))
    out, used = np.zeros((lanes, 2 * length + 8), np.uint16), np.zeros(lanes, np.int64)
    rounds = rounds_of(length)
    with np.errstate(over="ignore"):
        for s, e in zip(rounds, rounds[1:], strict=False):
            now = slice(begin[s], begin[e])
            a, c, of, slot = before[now], x[now], number[now], slots[now]
            fine = model.fineness()
            seen = np.flatnonzero(times)
            low1[seen], n1[seen] = model.order1(own[seen], times[seen], np.searchsorted(seen, head), fine)
            w2, w1 = model.weights(a, slot)
            w0, low0 = WEIGHT - w2 - w1, model.order0[c]
            shift = PART_BITS - fine[a]
            width2 = np.where(model.successor[slot] == c, w2, 0) << PART_BITS
            width1, width0 = w1 * n1[of] << shift, w0 * (model.order0[c + 1] - low0)
            order = np.where(width1 > width0, 1, 0)
            starts, widths = np.where(order == 1, (w2 << PART_BITS) + (w1 * low1[of] << shift), (w2 + w1 << PART_BITS) + w0 * low0), np.maximum(width1, width0)
            second = width2 > widths
            starts[second], widths[second], order[second] = 0, width2[second], 2
            starts, widths = starts.view(U), widths.view(U)
            for t in range(s, e):
                some = slice(begin[t] - begin[s], begin[t + 1] - begin[s])
                lo, sz = low[: active[t]], size[: active[t]]
                unit = sz >> _T
                lo += unit * starts[some]
                np.multiply(unit, widths[some], out=sz)
                move = _grow(lo, sz)
                while len(move):
                    here = lo[move]
                    out[move, used[move]] = (here >> _48).astype(np.uint16)
                    used[move] += 1
                    here, there = here << _16, sz[move] << _16
                    again = _grow(here, there)
                    lo[move], sz[move] = here, there
                    move = move[again]
                if int(used.max()) + 8 > out.shape[1]:
                    out = np.concatenate([out, np.zeros((lanes, length + 8), np.uint16)], axis=1)
            if e < length:  # nothing is coded by what the last round would teach
                model.update(a, slot, c, pairs[of[first[now]]], order)
                times += np.bincount(of, minlength=len(times))
        # The shortest end: the words after it count as 0.
        one = (low + _LOW48 >> _48) << _48
        final = np.where(one - low < size, one, (low + _LOW32 >> U(32)) << U(32))
    every = np.arange(lanes)
    out[every, used], out[every, used + 1] = (final >> _48).astype(np.uint16), (final >> U(32)).astype(np.uint16)
    used += np.where(final & _LOW48, 2, 1)
    words = out[np.arange(out.shape[1]) < used[:, None]]
    payload = used.astype(_used_kind(length)).tobytes() + words.astype("<u2").tobytes()
    return HEADER.pack(MAGIC, n, lanes, alphabet, zlib.crc32(payload), check) + payload


def _used_kind(length: int) -> str:
    """A step moves two words out at most in the long run, as no id has less than 2^-32 of the range."""
    return "<u2" if 2 * length + 8 < 1 << 16 else "<u4"


def _merge(pairs: np.ndarray, times: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs and how often each was seen, with those of a round; and the pairs that are new."""
    more, counts = np.unique(more, return_counts=True)
    at = np.searchsorted(pairs, more)
    known = np.zeros(len(more), bool)
    inside = at < len(pairs)
    known[inside] = pairs[at[inside]] == more[inside]
    times[at[known]] += counts[known]
    return np.insert(pairs, at[~known], more[~known]), np.insert(times, at[~known], counts[~known]), more[~known]


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; CorruptBlock if a checksum differs."""
    if len(block) < HEADER.size:
        raise CorruptBlock("block is too short")
    magic, n, lanes, alphabet, payload_check, ids_check = HEADER.unpack_from(block)
    payload = block[HEADER.size :]
    if magic != MAGIC or (n and (lanes, zlib.crc32(payload)) != (lanes_of(n)[0], payload_check)):
        raise CorruptBlock("payload doesn't match its checksum")
    if not n:
        return np.zeros(0, np.uint32)
    length = lanes_of(n)[1]
    kind = _used_kind(length)
    used = np.frombuffer(payload, kind, lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(payload, "<u2", offset=int(kind[-1]) * lanes), np.zeros(8, "<u2")]).astype(U)
    at = np.cumsum(used) - used
    ends = at + used
    code = np.zeros(lanes, U)
    for _ in range(4):
        code = code << _16 | np.where(at < ends, words[np.minimum(at, len(words) - 1)], U(0))
        at = at + 1
    model = _Model(alphabet)
    low, size = np.zeros(lanes, U), np.full(lanes, U((1 << 64) - 1))
    last, last2 = np.full(lanes, alphabet, np.int64), np.full(lanes, alphabet, np.int64)
    by_step = np.zeros((length, lanes), np.int32)
    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    rounds = rounds_of(length)
    with np.errstate(over="ignore"):
        for s, e in zip(rounds, rounds[1:], strict=False):
            own = pairs // alphabet
            symbol = pairs - own * alphabet
            fine = model.fineness()
            low1, n1 = model.order1(own, times, np.searchsorted(pairs, np.arange(alphabet + 1) * alphabet), fine)
            table = np.append(np.repeat(np.arange(len(pairs), dtype=np.int32), n1), len(pairs)).astype(np.int32)  # the pair of each slot
            entries = np.append(symbol << 2 * PART_BITS | low1 << PART_BITS | n1, 0)
            room = np.where(model.times > 0, 1 << fine, 0)
            begins = np.cumsum(room) - room << 5 | PART_BITS - fine
            owner = np.repeat(np.arange(alphabet, dtype=np.int32), np.diff(model.order0))
            kept = []
            for t in range(s, e):
                a = -(-(n - t) // length)
                before = last[:a]
                slot = model.slots(last2[:a], before)
                w2, w1 = model.weights(before, slot)
                lo, sz, cd = low[:a], size[:a], code[:a]
                unit = sz >> _T
                value = ((cd - lo) // unit).view(np.int64)
                base = w2 << PART_BITS
                inside = value - base
                # Order 1 first, as if it had coded all; then those that it hasn't.
                own_begin = begins.take(before)
                shift = own_begin & 31
                within = (np.maximum(inside, 0) >> shift) + 0.5
                within /= np.maximum(w1, 1)
                pair = entries.take(table.take(np.minimum((own_begin >> 5) + within.astype(np.int64), len(table) - 1)))
                c, shift = pair >> 2 * PART_BITS, w1 << shift
                start, width = base + (pair >> PART_BITS & PART - 1) * shift, (pair & PART - 1) * shift
                order = np.ones(a, np.int8)
                some = np.flatnonzero(inside < 0)
                if len(some):
                    c[some], start[some], width[some], order[some] = model.successor[slot[some]], 0, base[some], 2
                some = np.flatnonzero(inside >= w1 << PART_BITS)
                if len(some):
                    w = WEIGHT - w2[some] - w1[some]
                    skip = w1[some] << PART_BITS
                    x = owner.take(np.minimum(((inside[some] - skip + 0.5) / w).astype(np.int64), PART - 1))
                    low0 = model.order0[x]
                    c[some], start[some], width[some], order[some] = x, base[some] + skip + w * low0, w * (model.order0[x + 1] - low0), 0
                lo += unit * start.view(U)
                np.multiply(unit, width.view(U), out=sz)
                move = _grow(lo, sz)
                while len(move):
                    here, there = lo[move] << _16, sz[move] << _16
                    place = at[move]
                    cd[move] = cd[move] << _16 | np.where(place < ends[move], words[np.minimum(place, len(words) - 1)], U(0))
                    at[move] += 1
                    again = _grow(here, there)
                    lo[move], sz[move] = here, there
                    move = move[again]
                by_step[t, :a] = c
                if e < length:
                    kept.append((before.copy(), slot, c, order))
                last2[:a], last[:a] = before, c
            if not kept:
                break
            before, slot, c, order = (np.concatenate(k) for k in zip(*kept, strict=True))
            pairs, times, fresh = _merge(pairs, times, before * alphabet + c)
            model.update(before, slot, c, fresh, order)
    ids = by_step.T.reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != ids_check:
        raise CorruptBlock("ids don't match their checksum")
    return ids


def crc32_join(first: int, second: int, second_bytes: int) -> int:
    """The checksum of two byte strings one after another, from those of each."""
    # Feeding zero bytes is linear over bits, so it is a 32 x 32 bit matrix, raised to the length by squaring.
    rows = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit

    def times(m: list[int], v: int) -> int:
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v >>= 1
            i += 1
        return out

    bits = 8 * second_bytes
    while bits:
        if bits & 1:
            first = times(rows, first)
        rows = [times(rows, r) for r in rows]
        bits >>= 1
    return first ^ second


BLOCKS = "file int, block int, first long, n_ids long, docs binary, payload binary"


def _index(rows: list[tuple]) -> bytes:
    """The documents of a block: id (or none), ordinal in the file, place of the piece, ids here, ids of the whole."""
    valid = np.array([r[0] is not None for r in rows], np.uint8)
    table = np.array([(r[0] if r[0] is not None else 0, *r[1:]) for r in rows], "<i8").reshape(len(rows), 5)
    return struct.pack("<I", len(rows)) + zlib.compress(valid.tobytes() + table.T.tobytes(), 1)


def _unindex(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    (n,) = struct.unpack_from("<I", data)
    raw = zlib.decompress(data[4:])
    return np.frombuffer(raw, np.uint8, n).astype(bool), np.frombuffer(raw, "<i8", offset=n).reshape(5, n)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, alphabet: int = 49_408, spaced: bool = False) -> None:
    """Write the ids of all texts, each ended by ``end_id``, in ascending id order over the files below ``path``.

    Files are ranges of ids, their borders quantiles of the id column; an id (or
    no id) of many rows is dealt over several by a hash of its texts. They are
    Parquet files with a row per block (BLOCKS): Spark's commit keeps a lost or
    repeated task from leaving half a file, and any store that Spark writes will
    do. A block ends with a document, but for one longer than BLOCK_IDS, which
    goes over several. Null ids come first; rows with one id in the order of
    that hash; null texts are empty.
    """
    spark = docs.sparkSession
    n_files = partitions_of(docs)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    quantiles = F.percentile_approx("doc_id", [i / n_files for i in range(1, n_files)] or [0.5], 50 * n_files)
    cuts, none = texts.select(quantiles, F.avg(F.col("doc_id").isNull().cast("double"))).first()
    borders = Counter(c for c in (cuts if n_files > 1 else None) or [] if c is not None)
    bucket, n_buckets = _bucket(sorted(borders.items()), max(1, round((none or 0) * n_files)))
    dealt = texts.repartitionById(n_buckets, bucket).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_path, spaced, limit=WORDS)
        claim(coder.cache, tidy=False)
        place = TaskContext.get().partitionId()
        rows: list[tuple] = []
        held: list[np.ndarray] = []
        size = first = block = ordinal = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, first, block
            ids = np.concatenate(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([place], pa.int32()), pa.array([block], pa.int32()), pa.array([first]), pa.array([size]), pa.array([_index(rows)], pa.binary()), pa.array([encode_block(ids, alphabet)], pa.binary())],
                names=["file", "block", "first", "n_ids", "docs", "payload"],
            )
            first, block, size = first + size, block + 1, 0
            rows.clear()
            held.clear()
            return out

        for step in steps(batches, "text", TEXT_STEP):
            ids, lengths = coder.encode(step.column(1))
            at = 0
            for doc, n in zip(step.column(0).to_pylist(), lengths.tolist(), strict=True):
                own = np.empty(n + 1, np.int32)
                own[:n], own[n] = ids[at : at + n], end_id
                at += n
                for s in range(0, n + 1, BLOCK_IDS):
                    piece = own[s : s + BLOCK_IDS]
                    if size and size + len(piece) > BLOCK_IDS:
                        yield flush()
                    rows.append((doc, ordinal, s, len(piece), n + 1))
                    held.append(piece)
                    size += len(piece)
                ordinal += 1
        if size:
            yield flush()

    dealt.mapInArrow(run, BLOCKS).write.parquet(path)


def _bucket(borders: list[tuple[int, int]], for_none: int) -> tuple[Column, int]:
    """The file of a row, as an expression, and the number of files.

    ``borders`` has (id, how many quantiles it is). Rows up to a border are a
    file; a border of several quantiles has as many files of its own, by ranges
    of the hash; ``for_none`` files hold the rows without an id.
    """
    starts, single = [], []
    at = for_none
    for border, times in borders:
        starts.append((border, at))
        single.append(times)
        at += 1 if times == 1 else 1 + times

    def within(n: int) -> Column:
        """The range of the hash, whose order is that of the rows, among n."""
        return F.least(F.floor((F.xxhash64("text") / float(1 << 63) + 1) / 2 * n).cast("int"), F.lit(n - 1)) if n > 1 else F.lit(0)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(starts[lo][1] if lo < len(starts) else at)
        mid = (lo + hi) // 2
        border, here = starts[mid]
        own = search(lo, mid)
        if single[mid] > 1:
            own = F.when(F.col("doc_id") == border, F.lit(here + 1) + within(single[mid])).otherwise(own)
        return F.when(F.col("doc_id") <= border, own).otherwise(search(mid + 1, hi))

    number = F.when(F.col("doc_id").isNull(), within(for_none)).otherwise(search(0, len(starts)))
    return number.cast("int"), at + 1


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files' blocks alone."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(6)]
                ids = decode_block(row[5]).tobytes()
                valid, (doc, ordinal, place, here, whole) = _unindex(row[4])
                ends = np.cumsum(here)
                crc = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), here.tolist(), strict=True)]
                n = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row[0], np.int32)), pa.array(ordinal), pa.array(doc, mask=~valid), pa.array(row[2] + ends - here - place), pa.array(place), pa.array(here), pa.array(whole), pa.array(np.array(crc, np.int64))],
                    names=["file", "ordinal", "doc_id", "begin", "place", "here", "whole", "crc"],
                )

    found = materialize(blocks.mapInArrow(run, "file int, ordinal long, doc_id long, begin long, place long, here long, whole long, crc long"), "token-pieces")  # read more than once, decoded once
    whole = found.where("here = whole").select("file", "doc_id", "begin", F.col("whole").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    # Only documents longer than a block have parts, so few rows are grouped.
    parts = found.where("here < whole").groupBy("file", "ordinal").applyInPandas(_join, "file int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    sizes = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))  # a row per file
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    out = whole.unionByName(parts).join(F.broadcast(before), "file")
    return out.select("doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def _join(parts: pd.DataFrame) -> pd.DataFrame:
    """One document of the parts that it has in several blocks."""
    parts = parts.sort_values("place")
    crc = 0
    for more, n in zip(parts["crc"].tolist(), parts["here"].tolist(), strict=True):
        crc = crc32_join(crc, more, 4 * n)
    head = parts.iloc[:1]
    return pd.DataFrame({"file": head["file"], "doc_id": head["doc_id"], "begin": head["begin"], "n_tokens": head["whole"], "ids_crc32": crc})


def roundtrip(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write token files to the shared folder and digest what is read back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_path, **options)
    return read_token_files(spark, path)
