"""Token counts: greedy longest-match pieces of every word, counted by a linear automaton."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import WordCache, bounded_batches, claim, steps

_HELD: dict[str, PieceCounter] = {}


def byte_of_symbol() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    out = {chr(b): b for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in shown):
        out[chr(256 + k)] = b
    return out


def vocabulary(path: str) -> list[bytes]:
    """Pieces as bytes, of a byte-level vocabulary file; all single bytes are among them."""
    with open(path, encoding="utf-8") as f:
        words = json.load(f)["model"]["vocab"]
    table = byte_of_symbol()
    return [bytes(table[c] for c in w) for w in words if all(c in table for c in w)]


class PieceCounter:
    """A trie of the vocabulary with failure links.

    At a node, when the next byte has no child, greedy matching is sure of some
    pieces: ``popped`` says how many, ``fail`` where matching goes on. Both are
    set breadth first from the parent's, so a word is counted in time linear in
    its bytes and no piece is ever built.
    """

    def __init__(self, pieces: Iterable[bytes]):
        child: dict[int, int] = {}
        whole, parent, symbol = [False], [0], [0]
        for piece in sorted(set(pieces) | {bytes([b]) for b in range(256)}):
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in child:
                    child[key] = len(whole)
                    whole.append(False)
                    parent.append(node)
                    symbol.append(b)
                node = child[key]
            whole[node] = bool(piece) or whole[node]
        n = len(whole)
        depth = [0] * n
        for v in range(1, n):  # a parent has a smaller number than its children
            depth[v] = depth[parent[v]] + 1
        fail, popped, rest = [0] * n, [0] * n, [0] * n
        for v in sorted(range(1, n), key=depth.__getitem__):
            if whole[v]:
                popped[v], fail[v] = 1, 0
            else:
                u, b = parent[v], symbol[v]
                count, z = popped[u], fail[u]
                while (z << 8 | b) not in child:
                    count += popped[z]
                    z = fail[z]
                popped[v], fail[v] = count, child[z << 8 | b]
            rest[v] = popped[v] + rest[fail[v]]
        self.child, self.fail, self.popped, self.rest = child, fail, popped, rest
        self.cache = WordCache(lambda words: ([self.count(w) for w in words], [1] * len(words)), np.int64, 500_000)

    def count(self, word: bytes) -> int:
        """Pieces of the word with a space before it."""
        child, fail, popped = self.child, self.fail, self.popped
        node, n = child[0x20], 0
        for b in word:
            key = node << 8 | b
            while key not in child:
                n += popped[node]
                node = fail[node]
                key = node << 8 | b
            node = child[key]
        return n + self.rest[node]


def _counter(path: str) -> PieceCounter:
    if path not in _HELD:
        _HELD[path] = PieceCounter(vocabulary(path))
    return _HELD[path]


def count_tokens(docs: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens): words between ASCII white space, and their greedy longest-match pieces.

    Null and empty texts count 0. Each input row gives one row, repeated ones
    too; a null id stays null; empty tables give none; other columns are
    ignored. Words are counted once per worker and kept in a bounded cache.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _counter(vocabulary_path).cache
        claim(cache)
        for step in steps(batches, "text"):
            words: list[bytes] = []
            counts = []
            for text in step.column(1).to_pylist():
                own = text.split() if text else []
                counts.append(len(own))
                words += own
            sums = np.concatenate([[0], np.cumsum(cache.gather(cache.lookup(words))[0])])
            ends = np.cumsum(np.array(counts, np.int64))
            yield pa.RecordBatch.from_arrays([step.column(0), pa.array(counts, pa.int64()), pa.array(sums[ends] - sums[ends - counts])], names=["doc_id", "n_words", "n_tokens"])

    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
