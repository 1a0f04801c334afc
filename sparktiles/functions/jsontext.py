"""JSON text of Arrow columns, with the number and null rules of the GeoJSON export (SNK-1, SNK-2)."""

from __future__ import annotations

import math
from decimal import Decimal
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import types as T


def number(value: float) -> str:
    """15 significant digits, or 17 where 15 do not read back as the same double; not finite: null."""
    if not math.isfinite(value):
        return "null"
    text = "%.15g" % value
    return text if float(text) == value else "%.17g" % value


def coordinate(value: float, precision: int) -> str:
    """Fixed decimals without trailing zeros; negative precision keeps every digit."""
    if precision < 0 or not math.isfinite(value):
        return number(value)
    text = "%.*f" % (precision, value)
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return "0" if text == "-0" else text


def text_of(value: object) -> str:
    """One nested value. Nulls inside lists and objects stay, unlike null properties."""
    if value is None:
        return "null"
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, str):
        return encode_basestring(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return number(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{encode_basestring(k)}:{text_of(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(text_of, value)) + "]"
    if isinstance(value, Decimal):
        return format(value, "f")
    raise TypeError(f"no JSON text for {type(value).__name__}")


def _plain(value: object, t: pa.DataType) -> object:
    """Maps arrive as lists of pairs; make them objects with text keys."""
    if value is None:
        return None
    if pa.types.is_map(t):
        return {_key(k): _plain(v, t.item_type) for k, v in value}
    if pa.types.is_struct(t):
        return {f.name: _plain(value[f.name], f.type) for f in t}
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return [_plain(v, t.value_type) for v in value]
    return value


def _key(k: object) -> str:
    return k if isinstance(k, str) else text_of(k)


def render(arr: pa.Array, verbatim: bool = False) -> list[str | None]:
    """JSON text per row; a null row is None, so that the caller can leave it out."""
    t = arr.type
    values = arr.to_pylist()
    if verbatim:
        return values
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return [None if v is None else encode_basestring(v) for v in values]
    if pa.types.is_floating(t):
        return [None if v is None else number(v) for v in values]
    if pa.types.is_nested(t):
        return [None if v is None else text_of(_plain(v, t)) for v in values]
    return [None if v is None else text_of(v) for v in values]


def texted(t: T.DataType) -> T.DataType:
    """The type with every leaf that JSON has no form for replaced by string."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(texted(t.elementType), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(texted(t.keyType), texted(t.valueType), t.valueContainsNull)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, texted(f.dataType), f.nullable) for f in t.fields])
    if isinstance(t, (T.NumericType, T.BooleanType, T.StringType)):
        return t
    return T.StringType()


def jsonable(c: Column, t: T.DataType) -> Column:
    """Cast done in the JVM, so that dates, timestamps and the like print as Spark prints them."""
    new = texted(t)
    return c if new == t else c.cast(new)
