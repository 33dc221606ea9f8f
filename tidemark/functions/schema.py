"""Schema descriptors and the schema fingerprint.

The fingerprint is SHA-256 over the sorted ``column:type`` pairs joined by
a vertical bar, with SQL type names.  It is computed from the DataFrame's
actual schema, so a changed source changes the fingerprint.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import types as T

# SQL type names used in the fingerprint text.
_TYPE_NAMES = {
    T.LongType: "bigint",
    T.IntegerType: "integer",
    T.ShortType: "smallint",
    T.ByteType: "smallint",
    T.DoubleType: "double precision",
    T.FloatType: "real",
    T.StringType: "text",
    T.TimestampType: "timestamptz",
    T.TimestampNTZType: "timestamp",
    T.DateType: "date",
    T.BooleanType: "boolean",
    T.BinaryType: "bytea",
}


def type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return f"numeric({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return type_name(dt.elementType) + "[]"
    for cls, name in _TYPE_NAMES.items():
        if isinstance(dt, cls):
            return name
    return dt.simpleString()


def schema_pairs(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, type_name(f.dataType)) for f in schema.fields]


def fingerprint_pairs(pairs: list[tuple[str, str]]) -> str:
    payload = "|".join(f"{c}:{t}" for c, t in sorted(pairs))
    return hashlib.sha256(payload.encode()).hexdigest()


def fingerprint(schema: T.StructType) -> str:
    """Fingerprint of a DataFrame schema (metadata only, no job)."""
    return fingerprint_pairs(schema_pairs(schema))
