"""Reading row images: JSON text to string maps and to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def image_map(image: Column) -> Column:
    """JSON object as a string map. Numbers keep their text, so 19-digit ids stay exact and an
    int stays an int."""
    return F.from_json(image, TEXT_MAP)


def json_text(*columns: Column | str) -> Column:
    """JSON of a row with its nulls kept; the default would make null look like absent."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def to_typed(text: Column, dtype: T.DataType) -> Column:
    """Typed value of one image field; text that does not fit becomes null."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.try_to_timestamp(text).cast(dtype)
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return F.from_json(text, dtype)
    return text.try_cast(dtype)


def typed_fields(fields: Column, schema: T.StructType) -> list[Column]:
    """String map projected to the columns of a target schema."""
    return [to_typed(fields.getItem(f.name), f.dataType).alias(f.name) for f in schema]


def typed_image(image: Column, schema: T.StructType) -> list[Column]:
    """Image projected to the columns of a target schema."""
    return typed_fields(image_map(image), schema)


def field_state(image: Column, name: str) -> Column:
    """Whether an image holds a value for a field, holds null, or does not name it."""
    fields = image_map(image)
    return (
        F.when(~F.coalesce(F.map_contains_key(fields, F.lit(name)), F.lit(False)), "absent")
        .when(fields.getItem(name).isNull(), "null")
        .otherwise("value")
    )
