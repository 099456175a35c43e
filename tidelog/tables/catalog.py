"""Catalog jobs over `spark.sql`: create, copy, rebuild, register, write partitions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.clock import now
from tidelog.session import scratch


def new_database(spark: SparkSession, label: str) -> str:
    """A database of its own in the shared folder."""
    name = f"tide_{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark, label)}'")
    return name


def create_as(
    spark: SparkSession, table: str, df: DataFrame, partition_by: Sequence[str] = ()
) -> None:
    """CTAS, with the partition columns moved last as parquet tables have them."""
    view = f"ctas_{uuid.uuid4().hex}"
    rest = [c for c in df.columns if c not in partition_by]
    df.select(*rest, *partition_by).createOrReplaceTempView(view)
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    try:
        spark.sql(f"CREATE TABLE {table} USING parquet {parts} AS SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def rebuild_like(
    spark: SparkSession, table: str, source: str, added: Mapping[str, str] | None = None
) -> None:
    """Drop a table and create it anew with the columns of another, and some more."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} LIKE {source} USING parquet")
    if added:
        columns = ", ".join(f"{name} {dtype}" for name, dtype in added.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def overwrite_with_load_time(
    spark: SparkSession, source: str, target: str, clock: str | None = None,
    column: str = "etl_time",
) -> None:
    """Replace a table by the rows of another plus the time of the load. A table cannot be
    overwritten while it is read, so reloading one into itself goes through a written copy."""
    rows = spark.table(source)
    if source == target:
        staged = scratch(spark, "staged")
        rows.drop(column).write.parquet(staged)
        rows = spark.read.schema(rows.drop(column).schema).parquet(staged)
    rows.withColumn(column, now(clock)).select(*spark.table(target).columns).write.insertInto(
        target, overwrite=True
    )


def register_files(
    spark: SparkSession, table: str, path: str, schema: T.StructType,
    partition_by: Sequence[str] = (),
) -> None:
    """A table over files that exist. Partition columns get the types of the schema, so `09`
    stays text."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def insert_partitions(
    spark: SparkSession, table: str, df: DataFrame, partition: Mapping[str, str | None]
) -> None:
    """INSERT INTO ... PARTITION: a value names a static partition, None a dynamic one."""
    view = f"rows_{uuid.uuid4().hex}"
    dynamic = [c for c, v in partition.items() if v is None]
    rest = [c for c in spark.table(table).columns if c not in partition]
    rows = df.select(*rest, *dynamic)
    if dynamic:
        # A few even files per partition instead of one per task and partition.
        rows = rows.hint("rebalance", *dynamic)
    rows.createOrReplaceTempView(view)
    spec = ", ".join(c if v is None else f"{c}='{v}'" for c, v in partition.items())
    try:
        spark.sql(f"INSERT INTO {table} PARTITION ({spec}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def with_computed(df: DataFrame, computed: Mapping[str, Column]) -> DataFrame:
    """Columns computed on read, where parquet tables have no generated columns."""
    return df.withColumns(dict(computed))


def probe_schema(df: DataFrame) -> DataFrame:
    """Column positions, names and types; nothing is read for it."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "pos int, name string, type string")


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*[F.col(c) for c in order]).limit(n)
