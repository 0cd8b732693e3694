"""Brings rows into the shape of a target schema, by field name at every level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.functions.nested import column


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, in its order and with its types.

    Structs are matched by field name, not by position; fields outside the schema are dropped,
    and a missing one is an error. Columns that already fit are passed through untouched.
    """
    return df.select(*conformed_columns(df, schema))


def conformed_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns that :func:`conform` selects, for use in other expressions on ``df``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"column {field.name} is missing")
        value = _fit(column(field.name), have[field.name], field.dataType, field.name)
        columns.append(value.alias(field.name))
    return columns


def _fit(value: Column, have: T.DataType, want: T.DataType, path: str) -> Column:
    # simpleString leaves nullability out, which a cast could not change anyway.
    if have.simpleString() == want.simpleString():
        return value
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(
            value, lambda item: _fit(item, have.elementType, want.elementType, f"{path}[]")
        )
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = []
        for field in want.fields:
            if field.name not in have.names:
                raise ValueError(f"field {path}.{field.name} is missing")
            fitted = _fit(
                value.getField(field.name),
                have[field.name].dataType,
                field.dataType,
                f"{path}.{field.name}",
            )
            fields.append(fitted.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast(want)
