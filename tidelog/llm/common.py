"""Helpers shared by the operators: whole texts as bytes, scratch tables, hashing in numpy."""

from __future__ import annotations

import ctypes
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import session

# Bytes that end a word of the `[^\x20\x09-\x0D]+` kind are what bytes.split() splits on.
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
LOWERED = bytes.maketrans(UPPER, LOWER)
# Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lowering A-Z: digits, a-z and all of UTF-8
# above ASCII. Every other byte becomes a space, so that split() gives the words.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


# Stages that run one after the other in the same workers send whole texts to Python in batches of
# about these bytes.
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession, batch_bytes: int | None = None) -> SparkSession:
    """Session settings, and Python workers of a local session that find this package; on a
    cluster it is shipped with --py-files."""
    if batch_bytes:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [root, environment.get("PYTHONPATH")]))
    return session.configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str | Column) -> Column:
    """The UTF-8 bytes of a text; a null text has none."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, so a lost executor costs
    no more than a read."""
    spark = df.sparkSession
    path = session.scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and the offsets of its rows."""
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system; a worker lives on through all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def lean(run):
    """A function for mapInArrow that gives its memory back when a task ends."""

    def to_the_end(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return to_the_end


MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
SCRAMBLE = np.uint64(0xD6E8FEB86659FD93)
SHIFT = np.uint64(32)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit rank for each pair of ranks."""
    x = left * MULTIPLY
    x += right
    x ^= x >> SHIFT
    x *= SCRAMBLE
    x ^= x >> SHIFT
    return x


def batch(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[k] if isinstance(columns[k], pa.Array) else pa.array(columns[k], t)
         for k, t in types.items()], names=list(types))
