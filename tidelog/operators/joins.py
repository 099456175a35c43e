"""Joins whose sides change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.ordered import asof_left_join
from tidelog.schemas import TableSpec
from tidelog.tables import commits
from tidelog.tables.keyed import KeyedTable


def left_join_cast(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> DataFrame:
    """Left join of a text key with a key of another type, compared as text.

    Catalyst picks the strategy from the sizes; a key that dominates the left side is split by
    the adaptive skew join.
    """
    return left.join(
        right, F.col(left_key) == F.col(right_key).cast("string"), "left"
    )


class ChangelogLeftJoin:
    """Left join of two changing tables, kept up to date.

    Three keyed tables: the two sides and the result. A batch of changes recomputes just the
    left keys it touches, directly or through a changed right row, so a right row that comes
    late, changes or goes revises the results made without it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        left: tuple[T.StructType, TableSpec],
        right: tuple[T.StructType, TableSpec],
        foreign_key: str,
        right_columns: Sequence[str],
    ):
        self.spark = spark
        self.foreign_key = foreign_key
        self.right_columns = list(right_columns)
        left_schema, left_spec = left
        right_schema, right_spec = right
        (self.right_key,) = right_spec.keys
        self.keys = list(left_spec.keys)
        self.left = KeyedTable.create(spark, f"{root}/left", left_schema, left_spec)
        self.right = KeyedTable.create(spark, f"{root}/right", right_schema, right_spec)
        fields = [f for f in left_schema if f.name not in left_spec.order_by]
        result = T.StructType([*fields, *[right_schema[c] for c in self.right_columns]])
        self.result = KeyedTable.create(
            spark, f"{root}/result", result, TableSpec(left_spec.keys)
        )
        # Foreign key and left key alone: finding the left rows a right row concerns reads
        # this narrow table, not the wide rows. Rows of a former foreign key stay in it; they
        # only cause a left key to be recomputed once more.
        unique = (foreign_key, *[k for k in self.keys if k != foreign_key])
        narrow = T.StructType([left_schema[c] for c in unique])
        self.links = KeyedTable.create(spark, f"{root}/links", narrow, TableSpec(unique))

    def apply(self, left_changes: DataFrame, right_changes: DataFrame, commit: str) -> None:
        """Fold one batch of both feeds in and revise the result. May be run again."""
        commit = commits.OfBatch(commit)
        self.left.upsert(left_changes, commit)
        self.right.upsert(right_changes, commit)
        linked = left_changes.where(F.col(self.foreign_key).isNotNull())
        self.links.upsert(linked.select(*self.links.columns).distinct(), commit)
        if commits.is_complete(self.spark, self.result.log, commit):
            return
        changed = right_changes.select(
            F.col(self.right_key).cast("string").alias("__fk")
        ).distinct()
        links = self.links.as_of(commit)
        through = links.join(
            changed, links[self.foreign_key].cast("string") == F.col("__fk"), "left_semi"
        ).select(*self.keys)
        touched = left_changes.select(*self.keys).unionByName(through).distinct()
        # Semi joins first: touched keys and the foreign keys they need are few, so they are
        # sent to the tables instead of shuffling the tables to them.
        live = (
            self.left.as_of(commit)
            .join(touched, self.keys, "left_semi")
            .withColumn("__live", F.lit(True))
        )
        # A touched key without a left row is gone from the result too.
        current = touched.join(live, self.keys, "left").withColumn(
            "__rk", F.col(self.foreign_key).cast("string")
        )
        current.persist()
        try:
            needed = current.select("__rk").where("__rk is not null").distinct()
            rights = (
                self.right.as_of(commit)
                .select(
                    F.col(self.right_key).cast("string").alias("__rk"),
                    F.struct(*self.right_columns).alias("__r"),
                )
                .join(needed, ["__rk"], "left_semi")
            )
            # A foreign key shared by much of the batch is split by the adaptive skew join.
            joined = current.join(rights, ["__rk"], "left")
            plain = [c for c in self.result.columns if c not in self.right_columns]
            rows = joined.select(
                *plain, *[F.col("__r").getField(c).alias(c) for c in self.right_columns],
                F.when(F.col("__live"), "u").otherwise("d").alias("op"),
            )
            self.result.upsert(rows, commit)
        finally:
            current.unpersist()

    def compact(self) -> None:
        """Fold the logs of all four tables, so that later batches rank only newer changes."""
        for t in (self.left, self.right, self.links, self.result):
            t.compact()

    def current(self) -> DataFrame:
        return self.result.snapshot().drop("commit_time")


def temporal_lookup(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    valid_from: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Facts with the dimension version valid when they happened; a key with a very long
    history is spread over time slices."""
    return asof_left_join(facts, versions, on, at, valid_from, columns, tie, slices)


def stream_lookup(
    stream: DataFrame, dimension: DataFrame, condition: Column | str
) -> DataFrame:
    """Streaming facts left-joined with a dimension as it is when each batch runs."""
    return stream.join(dimension, condition, "left")
