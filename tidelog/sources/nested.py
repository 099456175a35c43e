"""Tables with nested column families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build_families(
    df: DataFrame, rowkey: str, families: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Flat columns grouped into families: {family: {qualifier: source column}}."""
    rows = [
        F.struct(*[F.col(src).alias(q) for q, src in cols.items()]).alias(family)
        for family, cols in families.items()
    ]
    return df.select(F.col(rowkey).alias("rowkey"), *rows)


def scan_families(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row key with whole families or single qualifiers, as `family` or `family.qualifier`."""
    return df.select("rowkey", *[F.col(c) for c in columns])
