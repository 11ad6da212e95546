"""Schema enforcement and evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(Exception):
    """A batch does not fit the table it is meant for."""


def schema_diff(found: T.StructType, wanted: T.StructType) -> list[str]:
    """What separates two schemas, as readable lines; order and nullability do not count."""
    have, want = {f.name: f.dataType for f in found}, {f.name: f.dataType for f in wanted}
    lines = [f"extra column {n} {t.simpleString()}" for n, t in have.items() if n not in want]
    lines += [f"missing column {n} {t.simpleString()}" for n, t in want.items() if n not in have]
    for n, t in have.items():
        if n in want and t.simpleString() != want[n].simpleString():
            lines.append(f"column {n} is {t.simpleString()}, table has {want[n].simpleString()}")
    return lines


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The batch in the table's column order, or an error before anything is written."""
    lines = schema_diff(df.schema, schema)
    if lines:
        raise SchemaMismatch("; ".join(lines))
    return df.select(*schema.names)


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_types(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType))
    if old.simpleString() != new.simpleString():
        raise SchemaMismatch(f"{old.simpleString()} and {new.simpleString()} do not merge")
    return old


def merge_types(old: T.StructType, new: T.StructType) -> T.StructType:
    """All fields of both, old ones first, nested structs merged as well."""
    by_name = {f.name: f for f in new}
    out = [
        T.StructField(f.name, merged_type(f.dataType, by_name[f.name].dataType) if f.name in by_name else f.dataType)
        for f in old
    ]
    known = {f.name for f in old}
    out += [T.StructField(f.name, f.dataType) for f in new if f.name not in known]
    return T.StructType(out)


def _fit(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StructType):
        fields = {f.name: f.dataType for f in have}
        parts = [
            (_fit(col[f.name], fields[f.name], f.dataType) if f.name in fields else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(want.elementType, T.StructType):
        return F.transform(col, lambda e: _fit(e, have.elementType, want.elementType))
    return col.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the given schema: missing columns and nested fields become NULL."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (_fit(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def merge_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows under the merged schema."""
    schema = merge_types(old.schema, new.schema)
    return conform(old, schema).union(conform(new, schema))


def overwrite_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Only the columns and nested fields of the new schema; the rest is dropped."""
    return conform(df, schema)
