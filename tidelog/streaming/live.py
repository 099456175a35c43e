"""Continuous counts, metrics and windows, as streaming aggregates upserted into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def running_count(stream: DataFrame, name: str = "cnt") -> DataFrame:
    """Count of all rows so far. Tasks count their own rows first."""
    return stream.groupBy(F.lit("all").alias("dimension")).agg(F.count("*").alias(name))


def change_delta(value: str, before: str, op: str = "op") -> Column:
    """What one event adds to a sum over the current rows: its value less the one it replaces."""
    new = F.when(F.col(op) == "d", F.lit(0.0)).otherwise(F.coalesce(F.col(value), F.lit(0.0)))
    return new - F.coalesce(F.col(before), F.lit(0.0))


def running_metric(
    changes: DataFrame, dimension: str | Column, delta: Column, name: str = "metric"
) -> DataFrame:
    """Sum over the current rows of a changing table, per dimension, without holding the rows:
    sums of deltas are right whatever order the events come in."""
    dim = F.lit(dimension) if isinstance(dimension, str) else dimension
    return changes.groupBy(dim.alias("dimension")).agg(F.sum(delta).alias(name))


def retracted(
    images: DataFrame, groups: dict[str, Column], value: Column, where: Column | None = None
) -> DataFrame:
    """What changed rows (`old` and `new`, see KeyedTable.images) add to `cnt` and `total` of each
    group: the new row counts where it satisfies the condition, less the old one where it did."""
    def side(name: str, sign: int) -> DataFrame:
        rows = images.where(F.col(name).isNotNull()).select(f"{name}.*")
        rows = rows if where is None else rows.where(where)
        return rows.select(*(c.alias(n) for n, c in groups.items()), F.lit(sign).cast("long").alias("cnt"),
                           (sign * F.coalesce(value, F.lit(0.0))).alias("total"))

    return side("old", -1).unionByName(side("new", 1)).groupBy(*groups).agg(
        F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))


def tumbling(
    df: DataFrame, time: str, size: str, keys: Sequence[str], *aggregates: Column
) -> DataFrame:
    """Aggregates per key and window of an event-time column; the same for batch and stream."""
    grouped = df.groupBy(F.window(F.col(time), size).alias("__w"), *keys).agg(*aggregates)
    rest = [c for c in grouped.columns if c != "__w"]
    return grouped.select(
        F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *rest
    )


def processing_time_sum(
    stream: DataFrame, size: str, keys: Sequence[str], value: Column, name: str = "total"
) -> DataFrame:
    """Sum per key and window of the time a record is processed. Nothing can be late, so a
    window's state is dropped as soon as the clock passes it."""
    timed = stream.withColumn("pt", F.current_timestamp()).withWatermark("pt", "0 seconds")
    return tumbling(timed, "pt", size, keys, F.sum(value).alias(name))
