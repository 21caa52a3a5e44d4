"""Value comparison: null equals the empty string, everything else compares by type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(c: Column, kind: T.DataType) -> Column:
    """A form in which two values are equal exactly when they count as unchanged."""
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return F.coalesce(c, F.lit(""))
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def differs(source: Column, target: Column, source_kind: T.DataType, target_kind: T.DataType) -> Column:
    if source_kind != target_kind:
        if isinstance(source_kind, T.NumericType) and isinstance(target_kind, T.NumericType):
            return ~source.eqNullSafe(target)
        source, target = source.cast("string"), target.cast("string")
        source_kind = T.StringType()
    return ~canonical(source, source_kind).eqNullSafe(canonical(target, source_kind))


def value_text(c: Column, kind: T.DataType) -> Column:
    """Text of a value for reports; nested values as JSON."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def change_list(fields: Sequence[tuple[str, Column, Column, T.DataType, T.DataType]]) -> Column:
    """Array of (field, source_value, target_value) for the fields that differ."""
    return F.array_compact(F.array(*[
        F.when(differs(s, t, sk, tk),
               F.struct(F.lit(name).alias("field"), value_text(s, sk).alias("source_value"),
                        value_text(t, tk).alias("target_value")))
        for name, s, t, sk, tk in fields]))


def comparable(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Canonical form of ``cols`` under their own names."""
    return [canonical(F.col(c), df.schema[c].dataType).alias(c) for c in cols]


def _leaf(c: Column, kind: T.DataType) -> Column:
    """Text or bytes of a single value, different for values that differ."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0).cast(kind)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # text without its zone would make two instants one when clocks change
    return c if isinstance(kind, T.BinaryType) else c.cast("string")


def _nested(c: Column, kind: T.DataType) -> Column:
    """Text of a value inside another one: nulls, lengths and borders of parts are kept, texts by their bytes."""
    if isinstance(kind, T.StructType):
        parts = [_nested(c.getField(f.name), f.dataType) for f in kind.fields]
        text = F.concat(F.lit("("), *parts, F.lit(")"))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _nested(x, kind.elementType)), ""), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entry = T.StructType().add("key", kind.keyType).add("value", kind.valueType)
        text = F.concat(F.lit("{"), F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda x: _nested(x, entry))), ""), F.lit("}"))
    else:
        text = F.concat(F.hex(_leaf(c, kind).cast("binary")), F.lit(","))
    return F.coalesce(text, F.lit("-"))


def exact_bytes(c: Column, kind: T.DataType) -> Column:
    """Bytes of a value, led by their number; two values have the same bytes exactly when they count as unchanged.

    Texts count by their bytes, valid or not; null is the empty text, and apart from every value of another type.
    """
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        data = F.coalesce(c, F.lit("")).cast("binary")
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        data = _nested(c, kind).cast("binary")
    else:
        data = _leaf(c, kind).cast("binary")
    size = F.coalesce(F.octet_length(data).cast("string"), F.lit("-"))
    return F.concat(F.concat(size, F.lit(":")).cast("binary"), F.coalesce(data, F.lit("").cast("binary")))


def fingerprint_label(df: DataFrame, cols: Sequence[str]) -> Column:
    """Hash of the field names and values, in name order; equal exactly where the values are, whatever their types."""
    parts = [x for c in sorted(cols) for x in (exact_bytes(F.lit(c), T.StringType()), exact_bytes(F.col(c), df.schema[c].dataType))]
    return F.sha2(F.concat(*parts) if parts else F.lit("").cast("binary"), 256)
