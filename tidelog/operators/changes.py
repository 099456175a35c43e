"""Folding change events into the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.schemas import KNOWN_OPS


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest in `order`.

    Spark turns `row_number() = 1` into a group limit that runs before the exchange too, so a
    map task ships at most one row per key however often the key occurs.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def current_state(
    feed: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """Rows that exist after all events, routed on `op` and never on empty images."""
    if not feed.isStreaming:
        return latest_per_key(feed, keys, order).where(F.col(op) != "d")
    rest = [c for c in feed.columns if c not in keys]
    folded = feed.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    )
    # A streaming aggregate is upserted downstream, so a deleted key must stay visible as a
    # deleted row.
    return folded.select(*keys, "__row.*").select(*feed.columns)


def partial_state(
    feed: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    op: str = "op",
) -> DataFrame:
    """Latest state where a null column of an event keeps the older value.

    A delete forgets the values before it. Each column is one `max_by` over the events that
    say something about it (a value, or a delete), so everything combines before the shuffle.
    """
    folded = fold_partial(feed, keys, order, columns, op)
    return folded.where(F.col(op) != "d").select(*keys, *columns)


def fold_partial(
    feed: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    op: str = "op",
) -> DataFrame:
    """The same with deleted keys kept, and with the last `op` and order of each key."""
    deleted = F.col(op) == "d"
    rank = F.struct(*order)

    def last_value(c: str) -> Column:
        speaks = F.col(c).isNotNull() | deleted
        value = F.when(~deleted, F.struct(F.col(c).alias("v")))
        return F.max_by(value, F.when(speaks, rank)).getField("v").alias(c)

    return (
        feed.groupBy(*keys)
        .agg(
            F.max_by(op, rank).alias(op), F.max(rank).alias("__rank"),
            *[last_value(c) for c in columns],
        )
        .select(*keys, *columns, op, "__rank.*")
    )


def known_ops(feed: DataFrame, op: str = "op") -> DataFrame:
    return feed.where(F.col(op).isin(*KNOWN_OPS))


def unknown_ops(feed: DataFrame, op: str = "op") -> DataFrame:
    """Events that cannot be applied, kept aside instead of dropped."""
    return feed.where(F.col(op).isNull() | ~F.col(op).isin(*KNOWN_OPS))


def reason_not_applied(keys: Sequence[str], op: str = "op") -> Column:
    """Why a typed change cannot be applied: its op is unknown, or it names no row. Else null."""
    unnamed = F.lit(False)
    for k in keys:
        unnamed = unnamed | F.col(k).isNull()
    known = F.coalesce(F.col(op).isin(*KNOWN_OPS), F.lit(False))
    return F.when(~known, "op").when(unnamed, "key")


def route(op: str = "op") -> Column:
    """What an event does to its target: insert, update, delete, or unknown."""
    c = F.col(op)
    return (
        F.when(c.isin("c", "r"), "insert")
        .when(c == "u", "update")
        .when(c == "d", "delete")
        .otherwise("unknown")
    )
