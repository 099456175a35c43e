"""Text sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_lines(
    spark: SparkSession, paths: Sequence[str] = (), default: Sequence[str] = ()
) -> DataFrame:
    """Lines of all inputs together, or of the default when no input is named."""
    if paths:
        return spark.read.text(list(paths))
    return spark.createDataFrame([(line,) for line in default], "value string")


def stream_lines(
    spark: SparkSession,
    path: str | None = None,
    host: str | None = None,
    port: int | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Lines arriving in a folder, or from a socket where host and port are given."""
    if path is None:
        return (
            spark.readStream.format("socket").option("host", host).option("port", port).load()
        )
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)
