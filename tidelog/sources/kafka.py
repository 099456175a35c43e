"""Frames shaped like Kafka records: key, value, topic, partition, offset, timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.changes import latest_per_key


def decode_csv(records: DataFrame, schema: str, time_column: str = "ts") -> DataFrame:
    """CSV payload as columns, plus the record's own timestamp."""
    row = F.from_csv(F.col("value").cast("string"), schema)
    return records.select(row.alias("r"), F.col("timestamp").alias(time_column)).select(
        "r.*", time_column
    )


def upsert_state(records: DataFrame) -> DataFrame:
    """Latest record per key; a null value deletes the key.

    A key's records are in one partition and its offsets are their order; a producer's timestamp
    may be older than the one before it.
    """
    latest = latest_per_key(records, ["key"], ["partition", "offset"])
    return latest.where("value is not null")
