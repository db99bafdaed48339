"""Type policy: what a column becomes in storage, and how types of several files widen to one."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGNED_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
UNSIGNED_BITS = {"utinyint": 8, "usmallint": 16, "uint": 32, "ubigint": 64}


class PromotionError(TypeError):
    """Two files hold a column in types that no storage type can hold together."""


def promote(left: str, right: str) -> str:
    """The narrowest logical type that holds both, by name (``tinyint`` .. ``ubigint``, ``float``, ...).

    Equal types stay; integers of one signedness take the wider; a signed and
    an unsigned take the smallest signed type with room for the unsigned's
    values; float and double give double. Anything else is an error, as is
    ``ubigint`` with any signed type.
    """
    if left == right:
        return left
    pair = {left, right}
    if pair <= SIGNED_BITS.keys():
        return max(pair, key=SIGNED_BITS.__getitem__)
    if pair <= UNSIGNED_BITS.keys():
        return max(pair, key=UNSIGNED_BITS.__getitem__)
    if pair == {"float", "double"}:
        return "double"
    signed, unsigned = pair & SIGNED_BITS.keys(), pair & UNSIGNED_BITS.keys()
    if signed and unsigned:
        need = max(SIGNED_BITS[signed.pop()], UNSIGNED_BITS[unsigned.pop()] + 1)
        for name, bits in SIGNED_BITS.items():
            if bits >= need:
                return name
    raise PromotionError(f"cannot hold {left} and {right} in one column")


def logical_name(kind: pa.DataType) -> str:
    """The logical type name of an Arrow type, as read from a file's footer."""
    fixed = {
        pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint",
        pa.uint8(): "utinyint", pa.uint16(): "usmallint", pa.uint32(): "uint", pa.uint64(): "ubigint",
        pa.float32(): "float", pa.float64(): "double", pa.bool_(): "boolean", pa.string(): "string",
        pa.large_string(): "string", pa.binary(): "binary", pa.large_binary(): "binary", pa.date32(): "date",
    }
    if kind in fixed:
        return fixed[kind]
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return f"array<{storage_name(logical_name(kind.value_type))}>"
    if pa.types.is_map(kind):
        return f"map<{storage_name(logical_name(kind.key_type))},{storage_name(logical_name(kind.item_type))}>"
    if pa.types.is_struct(kind):
        inner = ",".join(f"`{f.name}`:{storage_name(logical_name(f.type))}" for f in kind)
        return f"struct<{inner}>"
    raise PromotionError(f"no storage type for {kind}")


def storage_name(logical: str) -> str:
    """The Spark type that holds a logical type: unsigned ones take the next wider signed type."""
    return {"utinyint": "smallint", "usmallint": "int", "uint": "bigint", "ubigint": "decimal(20,0)"}.get(logical, logical)


def reject_nulls(df: DataFrame) -> DataFrame:
    """Fail the job at the first NULL, for sinks that promise there are none."""
    checked = {
        f.name: F.when(F.col(f"`{f.name}`").isNull(), F.raise_error(F.lit(f"NULL in column {f.name}")).cast(f.dataType)).otherwise(F.col(f"`{f.name}`"))
        for f in df.schema.fields
    }
    return df.withColumns(checked)
