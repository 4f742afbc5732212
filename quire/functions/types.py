"""Schemas from short texts, without the session that parsing DDL needs."""

from __future__ import annotations

from pyspark.sql import types as T

_SIMPLE = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}


def struct(text: str) -> T.StructType:
    """``"a int, b string"`` as a struct of nullable fields of simple types."""
    out = T.StructType()
    for field in text.split(","):
        name, kind = field.split()
        out = out.add(name, _SIMPLE[kind])
    return out


LONG = T.LongType()
STRING = T.StringType()
STRINGS = T.ArrayType(T.StringType())
