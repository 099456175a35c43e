"""Ordered computations that never put a whole table, or a whole key, into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import shared_dir


def _offsets(totals: DataFrame, part: str, total: str) -> DataFrame:
    """Sum of `total` over the earlier parts. One row per partition, so it is small."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(before), F.lit(0)).alias("__off"))


def _sorted_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-sorted rows with their partition and place in it, fixed by a checkpoint."""
    shared_dir(df.sparkSession)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (
        df.orderBy(*order)
        .select("*", F.spark_partition_id().alias("__part"), place.alias("__place"))
        .checkpoint()
    )


def with_position(df: DataFrame, order: Sequence[Column], out: str = "pos") -> DataFrame:
    """1-based place of every row in the global order: per-partition place plus the sizes of
    the partitions before. `order` must be total for a repeatable result."""
    parts = _sorted_parts(df, order)
    offsets = _offsets(parts.groupBy("__part").agg(F.count("*").alias("__n")), "__part", "__n")
    return (
        parts.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__off") + F.col("__place") + 1)
        .select(*df.columns, out)
    )


def position_in_group(
    df: DataFrame, group: str, order: Sequence[Column], out: str = "pos"
) -> DataFrame:
    """1-based place of every row in the sorted rows of its group.

    Rows are range-sorted by (group, order), so a dominant group is sorted by several tasks;
    each adds what the tasks before it hold of the same group.
    """
    parts = _sorted_parts(df, [F.col(group), *order])
    counts = parts.groupBy(group, "__part").agg(
        F.count("*").alias("__n"), F.min("__place").alias("__first")
    )
    # One row per group and partition holding it: about partitions + groups rows.
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        F.col(group).alias("__g"),
        F.col("__part").alias("__p"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__off"),
    )
    same = (F.col("__p") == F.col("__part")) & F.col("__g").eqNullSafe(F.col(group))
    return (
        parts.join(offsets, same)
        .withColumn(out, F.col("__place") + F.col("__off") + 1)
        .select(*df.columns, out)
    )


def running_sum(df: DataFrame, order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Running total of `value` in the global order, as partition sums plus a sum within."""
    parts = _sorted_parts(df, order)
    offsets = _offsets(
        parts.groupBy("__part").agg(F.sum(value).alias("__s")), "__part", "__s"
    )
    within = Window.partitionBy("__part").orderBy("__place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        parts.withColumn("__w", F.sum(value).over(within))
        .join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__off") + F.coalesce(F.col("__w"), F.lit(0)))
        .select(*df.columns, out)
    )


def _number(c: Column, dtype: str) -> Column:
    """A double that falls into the same order, up to rounding: good for cutting slices."""
    if dtype == "date" or dtype.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if dtype in ("string", "binary", "boolean") or "<" in dtype:
        raise ValueError(f"cannot order by a column of type {dtype}")
    return c.cast("double")


def _common(left: str, right: str) -> str:
    """A type in which values of both types compare exactly."""
    whole = ("tinyint", "smallint", "int", "bigint")
    if left == right:
        return left
    if left in whole and right in whole:
        return "bigint"
    days = [t == "date" or t.startswith("timestamp") for t in (left, right)]
    if all(days):
        return "timestamp"
    if any(days):
        raise ValueError(f"cannot compare {left} with {right}")
    floating = {"float", "double"} & {left, right}
    return "double" if floating else "decimal(38,10)"


def _bounds(df: DataFrame, order: str, slices: int | None) -> list[float]:
    """Approximate quantiles of the order column: each slice holds about 1/n of all rows."""
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n < 2:
        return []
    at = df.select(_number(F.col(order), df.schema[order].dataType.simpleString()).alias("x"))
    found = at.approxQuantile("x", [i / n for i in range(1, n)], 1 / (4 * n))
    return sorted(set(found))


def _slice(x: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """Number of bounds <= x, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(x < F.lit(bounds[mid]), _slice(x, bounds[:mid], first)).otherwise(
        _slice(x, bounds[mid + 1:], first + mid + 1)
    )


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    slices: int | None = None,
) -> DataFrame:
    """Add, as `columns[name]`, the value `name` had in the key's event before.

    The first order column is cut into slices, so a hot key is spread over all of them; the
    last event of each key and slice is carried into the key's next slice.
    """
    lead = order[0]
    cut = _slice(
        _number(F.col(lead), df.schema[lead].dataType.simpleString()),
        _bounds(df, lead, slices),
    )
    held = F.struct(*[F.col(c) for c in columns])
    rows = df.select("*", cut.alias("__slice"), held.alias("__held"), F.lit(1).alias("__real"))
    last = rows.groupBy(*keys, "__slice").agg(
        F.max_by("__held", F.struct(*order)).alias("__held")
    )
    # At most one row per key and slice goes through this window.
    nxt = F.lead("__slice").over(Window.partitionBy(*keys).orderBy("__slice"))
    carry = (
        last.withColumn("__slice", nxt)
        .where("__slice is not null")
        .withColumn("__real", F.lit(0))
    )
    w = Window.partitionBy(*keys, "__slice").orderBy("__real", *order)
    return (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumn("__prev", F.lag("__held").over(w))
        .where("__real = 1")
        .select(
            *df.columns,
            *[F.col("__prev").getField(c).alias(name) for c, name in columns.items()],
        )
    )


def asof_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    at: str,
    valid_from: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Left rows with `columns` of the right version valid at `at`: the last one of the same
    key whose `valid_from` <= `at`; nulls if there is none yet.

    A null key, a null `at` and a null `valid_from` match nothing. Times are compared in their own
    type; the slices, cut at doubles, only spread the work.

    Time is cut into slices as in `previous`, and the version open at the end of a slice is
    carried into every later slice in which the key has rows.
    """
    ldtype = left.schema[at].dataType.simpleString()
    rdtype = right.schema[valid_from].dataType.simpleString()
    exact = _common(ldtype, rdtype)
    lx = _number(F.col(at).cast(exact), exact)
    rx = _number(F.col(valid_from).cast(exact), exact)
    for c in (*on, valid_from):
        right = right.where(F.col(c).isNotNull())
    spread = left.select(lx.alias("x")).unionByName(right.select(rx.alias("x")))
    bounds = _bounds(spread, "x", slices)

    held = F.struct(*[F.col(c) for c in columns])
    lrows = left.select(
        "*",
        _slice(lx, bounds).alias("__slice"),
        F.col(at).cast(exact).alias("__x"),
        F.lit(2).alias("__kind"),
    )
    rrows = right.select(
        *on,
        _slice(rx, bounds).alias("__slice"),
        F.col(valid_from).cast(exact).alias("__x"),
        F.lit(1).alias("__kind"),
        held.alias("__held"),
        F.struct(*(tie or on)).alias("__tie"),
    )
    last = rrows.groupBy(*on, "__slice").agg(
        F.max_by("__held", F.struct("__x", "__tie")).alias("__held")
    )
    # The slices a key has left rows in and those it has versions in: at most two rows per key
    # and slice go through this window.
    wanted = lrows.select(*on, "__slice").distinct().withColumn("__want", F.lit(1))
    earlier = Window.partitionBy(*on).orderBy("__slice").rangeBetween(
        Window.unboundedPreceding, -1
    )
    carry = (
        last.unionByName(wanted, allowMissingColumns=True)
        .withColumn("__held", F.last("__held", ignorenulls=True).over(earlier))
        .where("__want = 1 and __held is not null")
        .select(*on, "__slice", "__held", F.lit(0).alias("__kind"))
    )
    w = (
        Window.partitionBy(*on, "__slice")
        .orderBy(F.col("__x").asc_nulls_first(), "__kind", F.col("__tie").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        lrows.unionByName(rrows, allowMissingColumns=True)
        .unionByName(carry, allowMissingColumns=True)
        .withColumn("__seen", F.last("__held", ignorenulls=True).over(w))
        .where("__kind = 2")
        .withColumn("__seen", F.when(F.col("__x").isNotNull(), F.col("__seen")))
        .select(*left.columns, *[F.col("__seen").getField(c).alias(c) for c in columns])
    )
