"""Text as codes of frequent byte strings, in 8 or 12 bits, of a column or of its dictionary.

A table holds symbols of 1 to LONGEST bytes. A text is cut from left to right
into the longest symbols that match. With 8 bits, codes 0 to 254 are symbols and
255 says that the next byte stands for itself; with 12 bits, codes 0 to 255 are
the bytes themselves and the others symbols, two codes to three bytes. Spark has
no expression for a greedy cut, so coding runs in Arrow batches; the table is
found by an aggregate over all n-grams.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.encodings import dict_decode, dict_encode

LONGEST = 8
ESCAPE = 255
SIZES = {8: 255, 12: 4096 - 256}


def train_symbols(df: DataFrame, val: str = "val", bits: int = 8) -> list[bytes]:
    """The strings of up to LONGEST bytes that would save most: by occurrences times the bytes that a code spares. At most 3840 of them."""
    data = F.encode(F.col(val), "UTF-8")
    at = F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1)))
    grams = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), lambda n: F.substring(data, i, n))))
    # Shorter ones at the end come more than once; a text's own set of them is enough to rank by.
    counted = df.where(F.col(val).isNotNull()).select(F.explode(grams).alias("symbol")).where(F.octet_length("symbol") > 0).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    spared = F.col("n") * (F.octet_length("symbol") * (2 if bits == 8 else 1) - 1)
    top = counted.orderBy(spared.desc(), F.hex("symbol")).limit(SIZES[bits]).collect()
    return sorted(bytes(r.symbol) for r in top)


def _coder(symbols: list[bytes], bits: int) -> Callable[[bytes], bytes]:
    base = 0 if bits == 8 else 256
    code = {s: base + i for i, s in enumerate(symbols)}
    longest = re.compile(b"|".join([*(re.escape(s) for s in sorted(symbols, key=len, reverse=True)), b"."]), re.DOTALL)
    if bits == 8:
        return lambda data: b"".join(bytes([code[s]]) if s in code else bytes([ESCAPE]) + s for s in longest.findall(data))
    return lambda data: _pack([code.get(s, s[0]) for s in longest.findall(data)])


def _pack(codes: list[int]) -> bytes:
    """Two 12-bit codes to three bytes; of an odd number the last takes two."""
    pairs = np.array([*codes, 0][: len(codes) + len(codes) % 2], np.uint32).reshape(-1, 2)
    whole = pairs[:, 0] << 12 | pairs[:, 1]
    data = np.stack([whole >> 16, whole >> 8 & 255, whole & 255], axis=1).astype(np.uint8).tobytes()
    return data[: (len(codes) * 12 + 7) // 8]


def _unpack(data: bytes) -> list[int]:
    n = len(data) * 8 // 12
    raw = np.frombuffer(data + b"\0" * (-len(data) % 3), np.uint8).astype(np.uint32).reshape(-1, 3)
    whole = raw[:, 0] << 16 | raw[:, 1] << 8 | raw[:, 2]
    return np.stack([whole >> 12, whole & 4095], axis=1).ravel()[:n].tolist()


def _decoder(symbols: list[bytes], bits: int) -> Callable[[bytes], bytes]:
    if bits == 12:
        table = [bytes([b]) for b in range(256)] + symbols
        return lambda data: b"".join(table[c] for c in _unpack(data))
    one = re.compile(rb"\xff(.)|(.)", re.DOTALL)
    return lambda data: one.sub(lambda m: m[1] if m[1] is not None else symbols[m[2][0]], data)


def _over(df: DataFrame, column: str, out: str, kind: str, change: Callable[[bytes], bytes]) -> DataFrame:
    """All other columns, and ``column`` changed into ``out``; NULL stays."""
    rest = [c for c in df.columns if c != column]
    ordered = df.select(*rest, F.col(column).cast("binary").alias(out))
    text = kind == "string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if x is None else change(x) for x in batch.column(len(rest)).to_pylist()]
            changed = pa.array(values, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], changed.cast(pa.string()) if text else changed], names=[*rest, out])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields[:-1]), f"`{out}` {kind}"])
    return ordered.mapInArrow(run, fields)


def symbol_encode(df: DataFrame, symbols: list[bytes], val: str = "val", bits: int = 8) -> DataFrame:
    """``val`` as packed codes, in the column ``packed``."""
    coder = _coder(symbols, bits)
    return _over(df, val, "packed", "binary", coder)


def symbol_decode(df: DataFrame, symbols: list[bytes], val: str = "val", bits: int = 8) -> DataFrame:
    return _over(df, "packed", val, "string", _decoder(symbols, bits))


def symbol_dict_encode(df: DataFrame, symbols: list[bytes], pos: str = "pos", val: str = "val", bits: int = 8) -> tuple[DataFrame, DataFrame]:
    """The distinct values as packed codes, once each, and the number of each position's value."""
    keys, codes = dict_encode(df, pos, val)
    return symbol_encode(keys, symbols, val, bits), codes


def symbol_dict_decode(keys: DataFrame, codes: DataFrame, symbols: list[bytes], pos: str = "pos", val: str = "val", bits: int = 8) -> DataFrame:
    return dict_decode(symbol_decode(keys, symbols, val, bits), codes, pos, val)
