"""Audit SQL text of change events, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.images import image_map


def literal(text: Column, dtype: T.DataType) -> Column:
    """SQL literal of a field's text, null where the field is null.

    Numbers and booleans stand as they are, times are wrapped, all else is quoted with inner
    quotes doubled.
    """
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return text
    quoted = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit("to_timestamp("), quoted, F.lit(")"))
    if isinstance(dtype, T.DateType):
        return F.concat(F.lit("date "), quoted)
    return quoted


def _literals(image: Column, schema: T.StructType) -> dict[str, Column]:
    fields = image_map(image)
    return {f.name: literal(fields.getItem(f.name), f.dataType) for f in schema}


def insert_text(table: str, after: Column, schema: T.StructType) -> Column:
    """Insert naming only the columns that have a value."""
    values = _literals(after, schema)
    names = [F.when(v.isNotNull(), F.lit(n)) for n, v in values.items()]
    return F.concat(
        F.lit(f"insert into {table} ("), F.concat_ws(", ", *names),
        F.lit(") values ("), F.concat_ws(", ", *values.values()), F.lit(")"),
    )


def insert_text_with_nulls(table: str, after: Column, schema: T.StructType) -> Column:
    """Insert of all columns in table order, nulls spelled out."""
    values = [F.coalesce(v, F.lit("null")) for v in _literals(after, schema).values()]
    return F.concat(
        F.lit(f"insert into {table} values ("), F.concat_ws(", ", *values), F.lit(")")
    )


def _where(key: Column, schema: T.StructType, keys: Sequence[str]) -> Column:
    values = _literals(key, schema)
    return F.concat_ws(" and ", *[F.concat(F.lit(f"{k}="), values[k]) for k in keys])


def update_text(
    table: str, after: Column, key: Column, schema: T.StructType, keys: Sequence[str]
) -> Column:
    """Update of the non-null, non-key columns of the row with this key."""
    values = _literals(after, schema)
    sets = [F.concat(F.lit(f"{n}="), v) for n, v in values.items() if n not in keys]
    return F.concat(
        F.lit(f"update {table} set "), F.concat_ws(", ", *sets),
        F.lit(" where "), _where(key, schema, keys),
    )


def delete_text(table: str, key: Column, schema: T.StructType, keys: Sequence[str]) -> Column:
    return F.concat(F.lit(f"delete from {table} where "), _where(key, schema, keys))
