"""Commit directories: one parquet folder per commit, complete once its job has marked it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUCCESS = "_SUCCESS"
_ID = re.compile(r"[0-9A-Za-z_-]+")


class OfBatch(str):
    """The commit id of a micro-batch. Only such an id may come twice: the batch runs again."""


def commit_id(batch_id: int) -> str:
    """Sortable commit of a micro-batch: a replayed batch gets the commit it had before."""
    return OfBatch(f"{batch_id:017d}")


def query_of(batch: DataFrame) -> str:
    """The streaming query a micro-batch belongs to; its checkpoint keeps it over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def clock_commit() -> str:
    """Sortable commit of a batch job."""
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")[:17]


def following(last: str) -> str:
    """An id that sorts after `last`."""
    if not last:
        return commit_id(0)
    return f"{int(last) + 1:0{len(last)}d}" if last.isdigit() and set(last) != {"9"} else f"{last}-1"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _glob(spark: SparkSession, pattern: str) -> list:
    fs, p = _path(spark, pattern)
    found = fs.globStatus(p)
    return [s.getPath() for s in found] if found is not None else []


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of its own."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, but for hidden ones."""
    return sorted(p.getName() for p in _glob(spark, f"{path}/*") if p.getName()[0] not in "._")


def is_complete(spark: SparkSession, root: str, commit: str, label: str = "commit_time") -> bool:
    return exists(spark, f"{root}/{label}={commit}/{SUCCESS}")


def complete(spark: SparkSession, root: str, label: str = "commit_time") -> list[str]:
    """Ids of the complete commits under `root`, oldest first."""
    marks = _glob(spark, f"{root}/{label}=*/{SUCCESS}")
    return sorted(m.getParent().getName().split("=", 1)[1] for m in marks)


def children(spark: SparkSession, root: str, column: str) -> list[tuple[str, str]]:
    """(commit, value) for the values of a partition column in each commit, oldest first."""
    found = _glob(spark, f"{root}/commit_time=*/{column}=*")
    return sorted(
        (p.getParent().getName().split("=", 1)[1], p.getName().split("=", 1)[1]) for p in found
    )


def write(
    df: DataFrame,
    root: str,
    commit: str,
    partition_by: Sequence[str] = (),
    label: str = "commit_time",
) -> bool:
    """Write one commit. A complete one is left as it is and an unfinished one written anew, so
    a replayed batch neither doubles rows nor changes files a reader may have seen."""
    if not _ID.fullmatch(commit):
        raise ValueError(f"commit id {commit!r} must be letters, digits, '-' or '_'")
    if is_complete(df.sparkSession, root, commit, label):
        return False
    # Of this commit all partitions are written, whatever the session overwrites by default.
    writer = df.drop(label).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{label}={commit}")
    return True


def write_history(
    df: DataFrame, root: str, commit: str = "commit_time", partition_by: Sequence[str] = ()
) -> None:
    """Write many commits, named by a column, in one job.

    Rebalancing by the commit gives each commit a few files of even size and splits a commit
    that holds much of the data. Commits become visible together, once the job is done.
    """
    spark = df.sparkSession
    own = [r[0] for r in df.select(commit).distinct().collect()]  # names of commits: few
    (
        df.withColumnRenamed(commit, "commit_time")
        .hint("rebalance", "commit_time", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("commit_time", *partition_by)
        .parquet(root)
    )
    for name in sorted(own):
        fs, mark = _path(spark, f"{root}/commit_time={name}/{SUCCESS}")
        if not fs.exists(mark):
            fs.create(mark, True).close()


def read(
    spark: SparkSession,
    root: str,
    commits: Sequence[str],
    schema: T.StructType,
    label: str = "commit_time",
) -> DataFrame:
    """Rows of the given commits; only their directories are listed and read.

    The schema is always given: partition values are then text as written, where inference
    would turn `09` into 9.
    """
    with_commit = T.StructType([f for f in schema if f.name != label]).add(label, "string")
    if not commits:
        return spark.createDataFrame([], with_commit)
    paths = [f"{root}/{label}={c}" for c in commits]
    return (
        spark.read.schema(with_commit)
        .option("basePath", root)
        .parquet(*paths)
        .select(*with_commit.names)
    )


def size(spark: SparkSession, root: str, commits: Sequence[str], label: str = "commit_time") -> int:
    """Bytes of the files of some commits."""
    fs, _ = _path(spark, root)
    paths = [_path(spark, f"{root}/{label}={c}")[1] for c in commits]
    return sum(fs.getContentSummary(p).getLength() for p in paths)


def listing(spark: SparkSession, ids: Sequence[tuple[str, str]]) -> DataFrame:
    """Timeline as rows, newest first. One row per commit, so it is small."""
    rows = spark.createDataFrame(list(ids), "commit_time string, kind string")
    return rows.orderBy(F.desc("commit_time"), "kind")
