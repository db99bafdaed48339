"""Packing: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import bounded_batches, claim, letting_go, steps
from granary.llm.tokens import WORDS, tokenizer

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, n_loss long"
#: Bytes of text tokenized at a time.
TEXT_STEP = 6 << 20
NAMES = [c.split()[0] for c in PIECES.split(", ")]


def loss_of(item: tuple) -> int:
    """Loss-bearing tokens of a piece: those from its place in the example on."""
    return len(item[2]) - min(len(item[2]), max(0, item[4]))


class Packer:
    """Fills sequences one at a time from a pool of examples.

    An example has a demand vector: tokens, one segment, loss-bearing tokens.
    The next one placed is that whose demands, as shares of the limits, have
    the largest dot product with the room left in the open sequence. Where none
    fits whole, an example may be cut to fill the rest (``cut``). A sequence
    that would end short is cut into power-of-two ones, which need no padding.
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, pool: int, min_piece: int, base: int, emit):
        self.limits = (max_tokens, max_segments, max_loss)
        self.min_piece, self.emit, self.next_id = min_piece, emit, base
        self.tokens, self.loss = np.zeros(pool), np.zeros(pool)  # a segment each; a free slot demands no tokens
        self.free = list(range(pool))
        self.items: list = [None] * pool
        self.held = 0

    def add(self, item: tuple) -> None:
        """item: (doc_id, start, ids, doc_tokens, loss-bearing ids from this index of ids on)."""
        if not self.free:
            self._fill()
        self._put(item)

    def finish(self) -> None:
        while self.held:
            self._fill()

    def _take(self, slot: int) -> tuple:
        item, self.items[slot] = self.items[slot], None
        self.tokens[slot] = self.loss[slot] = 0
        self.free.append(slot)
        self.held -= 1
        return item

    def best(self, room: tuple[float, float, float]) -> int:
        """The slot whose demand fits the room and has the largest dot product with it, the first of several; -1 if none fits."""
        tokens, segments, loss = room
        if segments < 1 or tokens < 1:
            return -1
        max_tokens, max_segments, max_loss = self.limits
        score = self.tokens * (tokens / max_tokens**2) + self.loss * (loss / max_loss**2)
        score += segments / max_segments**2
        score[(self.tokens > tokens) | (self.loss > loss) | (self.tokens == 0)] = -1.0
        slot = int(score.argmax())
        return slot if score[slot] >= 0 else -1

    def _fill(self) -> None:
        room, chosen = self.limits, []
        while (slot := self.best(room)) >= 0:
            room = room[0] - self.tokens[slot], room[1] - 1, room[2] - self.loss[slot]
            chosen.append(self._take(slot))
        while self.held and room[0] >= self.min_piece and room[1] >= 1 and room[2] >= 1:
            doc, start, ids, total, loss_from = self._take(int(self.tokens.argmax()))
            n = int(min(room[0], len(ids), max(0, loss_from) + room[2]))
            chosen.append((doc, start, ids[:n], total, loss_from))
            room = room[0] - n, room[1] - 1, room[2] - loss_of(chosen[-1])
            if n < len(ids):
                self._put((doc, start + n, ids[n:], total, loss_from - n))
        self._write(chosen)

    def _put(self, item: tuple) -> None:
        slot = self.free.pop()
        self.items[slot], self.held = item, self.held + 1
        self.tokens[slot], self.loss[slot] = len(item[2]), loss_of(item)

    def _write(self, chosen: list) -> None:
        total = sum(len(x[2]) for x in chosen)
        cap = self.limits[0]
        if total & (total - 1) == 0 or cap - total < max(self.min_piece, cap // 64):
            parts = [total]
        else:
            parts = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        queue = list(reversed(chosen))
        for size in parts:
            offset = 0
            while offset < size:
                doc, start, ids, doc_tokens, loss_from = queue.pop()
                n = min(len(ids), size - offset)
                self.emit((doc, start, n, zlib.crc32(ids[:n].tobytes()), doc_tokens, self.next_id, offset, n - min(n, max(0, loss_from))))
                if n < len(ids):
                    queue.append((doc, start + n, ids[n:], doc_tokens, loss_from - n))
                offset += n
            self.next_id += 1


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, end_id: int = 0, max_tokens: int = 1024, max_segments: int = 64, max_loss: int | None = None, pool: int = 1024, min_piece: int = 4, cache_words: int = WORDS, step_bytes: int = TEXT_STEP, keep: bool = True) -> DataFrame:
    """Pack examples into sequences of at most ``max_tokens`` tokens, ``max_segments`` pieces and ``max_loss`` loss-bearing tokens.

    An example is the ids of its text and ``end_id``; with ``prompt_col`` the
    prompt's ids come first and bear no loss. Longer ones come in blocks of
    ``max_tokens``, which go through the same choice as all others. Each task packs what it reads, so
    nothing is shuffled and a lost task is redone alone; sequence ids are made
    of the partition's number and a count. One row per piece; see PIECES.

    ``cache_words``, ``step_bytes`` and ``keep`` trade a worker's memory for time; results don't depend on
    them. Unless ``keep``, a worker lets its tokenizer and words go at the end of a task.

    Null texts count as empty and still have their end id. Repeated rows are
    packed once each. A null id stays null. Empty tables give no rows. Other
    columns are ignored, whatever their names. Texts are never cut short: each
    id lies in exactly one piece, also of texts longer than a sequence.
    """
    most_loss = max_tokens if max_loss is None else max_loss
    if min(max_tokens, max_segments, most_loss, pool, min_piece) < 1:
        raise ValueError("limits are whole numbers from 1")
    if min_piece > max_tokens:
        raise ValueError("min_piece is at most max_tokens")
    bounded_batches(docs.sparkSession)
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    columns += [F.col(prompt_col).cast("string").alias("prompt")] if prompt_col else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path, spaced=True, limit=cache_words)
        claim(encoder.cache)
        out: list[tuple] = []
        packer = Packer(max_tokens, max_segments, most_loss, pool, min_piece, TaskContext.get().partitionId() << 40, out.append)
        for step in steps(batches, "text", step_bytes):
            ids, lengths = encoder.encode(step.column(1))
            before, before_lengths = encoder.encode(step.column(2)) if prompt_col else (ids[:0], np.zeros(step.num_rows, np.int64))
            at = at_before = 0
            for doc, n, m in zip(step.column(0).to_pylist(), lengths.tolist(), before_lengths.tolist(), strict=True):
                own = np.empty(m + n + 1, "<u4")
                own[:m], own[m : m + n], own[m + n] = before[at_before : at_before + m], ids[at : at + n], end_id
                at, at_before = at + n, at_before + m
                total = len(own)
                cut = total - total % max_tokens if most_loss >= max_tokens else 0
                for s in range(0, cut, max_tokens):
                    packer.add((doc, s, own[s : s + max_tokens], total, m - s))
                if cut < total:
                    packer.add((doc, cut, own[cut:], total, m - cut))
            if len(out) >= 20_000:
                yield _batch(out)
                out.clear()
        packer.finish()
        if out:
            yield _batch(out)

    return docs.select(*columns).mapInArrow(run if keep else letting_go(run), PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=NAMES)
