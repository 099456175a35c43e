"""Landing and applying change feeds as streams.

Each micro-batch is one commit that belongs to its query and batch, so a batch that is run again
after a failure finds its own commit: done work is skipped, half-done work is written anew. Feeds
with checkpoints of their own never share a commit, and an event that is delivered again, by
another feed or after a checkpoint was lost, is told by its id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.changes import latest_per_key, reason_not_applied
from tidelog.schemas import EVENT_ORDER, LOG, TableSpec, lookup
from tidelog.sources.feed import select_table, typed_changes
from tidelog.streaming import live
from tidelog.tables import commits
from tidelog.tables.keyed import KeyedTable

Batch = Callable[[DataFrame, int], None]
WHY = "__not_applied"  # beside the columns of any table: the spec refuses such a name
COMMIT_FIELD = T.StructField("commit_time", T.StringType())


def run_batches(
    stream: DataFrame,
    each: Batch,
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands micro-batches to `each`.

    With an interval it keeps running; without one it works off what is there and stops.
    """
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.outputMode(mode)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()


# -- log -----------------------------------------------------------------------------------


def land_batch(path: str) -> Batch:
    """Append log rows to one log of all tables, with a directory per database and table.

    Rebalancing keeps the file count of a commit low and splits a table that dominates it.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*LOG.names).hint("rebalance", "db", "tb")
        commit = f"{commits.commit_id(batch_id)}-{commits.query_of(batch)}"
        commits.write(rows, path, commit, ("db", "tb"))

    return each


def land_log(
    events: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    commits.make_dir(events.sparkSession, path)
    return run_batches(events, land_batch(path), checkpoint, interval)


def read_log(
    spark: SparkSession, path: str, after: str = "", upto: str | None = None
) -> DataFrame:
    """Log rows of the complete commits in (after, upto], each event once.

    Bounds may be whole commit ids or just those of the batches they begin with.
    """
    ids = [
        c for c in commits.complete(spark, path)
        if (not after or c[:len(after)] > after) and (upto is None or c[:len(upto)] <= upto)
    ]
    # By database and table too, so that a filter on them still reaches the directories.
    return latest_per_key(commits.read(spark, path, ids, LOG), ["db", "tb", "id"], ["ts_ms"])


def stream_log(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The log as a stream of rows."""
    reader = spark.readStream.schema(T.StructType([*LOG.fields, COMMIT_FIELD]))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select(*LOG.names)


# -- tables --------------------------------------------------------------------------------


def upsert_changes(changes: DataFrame, table: KeyedTable, commit: str, kept: str = "*") -> None:
    """Apply the change events that can be applied. The others, with `reason`, go to the table's
    log of bad events under the same commit; of them the columns `kept` are written. A `reason` of
    the event itself is `event_reason` there."""
    marked = changes.withColumn(WHY, reason_not_applied(table.spec.keys)).persist()
    try:
        bad = marked.where(F.col(WHY).isNotNull())
        if not bad.isEmpty():
            bad = bad.select(kept, *([] if kept == "*" else [WHY])).withColumnsRenamed({"reason": "event_reason"})
            commits.write(bad.withColumnRenamed(WHY, "reason"), bad_log(table), commit)
        table.upsert(marked.where(F.col(WHY).isNull()).drop(WHY), commit)
    finally:
        marked.unpersist()


def bad_log(table: KeyedTable) -> str:
    return f"{table.path}/bad"


def bad_events(table: KeyedTable) -> DataFrame:
    """The events that could not be applied, each with its reason; no rows if there were none."""
    spark, path = table.spark, bad_log(table)
    if not commits.complete(spark, path):
        return spark.createDataFrame([], "reason string, commit_time string")
    return spark.read.parquet(path)


def upsert_batch(table: KeyedTable) -> Batch:
    def each(batch: DataFrame, batch_id: int) -> None:
        commit = table.stream_commit(batch, batch_id)
        if "op" in batch.columns:
            upsert_changes(batch, table, commit)
        else:
            table.upsert(batch, commit)

    return each


def stream_upsert(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Apply a stream to a keyed table, one commit per micro-batch.

    Takes change events, plain rows, or (with mode "update") revised aggregates. Batch size is
    set at the source: the trigger interval and `maxFilesPerTrigger`.
    """
    return run_batches(stream, upsert_batch(table), checkpoint, interval, mode)


def follow(
    table: KeyedTable, each: Callable[[Sequence[str], DataFrame, int], None], checkpoint: str,
    interval: str | None = None, commits_per_trigger: int | None = None,
) -> StreamingQuery:
    """Hand the complete commits of a table, each once and in their order, to `each` as (commit ids,
    batch, batch id). The offsets are commits: a commit that is being written is not told yet, and a
    restart goes on behind the last one that was handled. A writer, or this function when it is
    called, tells what is complete."""
    reader = table.spark.readStream.schema("commit string")
    if commits_per_trigger:
        reader = reader.option("maxFilesPerTrigger", commits_per_trigger)
    told = reader.text(table.publish())

    def handle(batch: DataFrame, batch_id: int) -> None:
        ids = sorted(r["commit"] for r in batch.collect())  # one short row per commit
        if ids:
            each(ids, batch, batch_id)

    return run_batches(told, handle, checkpoint, interval)


def follow_changes(
    table: KeyedTable, each: Batch, checkpoint: str, from_commit: str = "", **options
) -> StreamingQuery:
    """The rows of complete commits from one on, with `op` and the commit, batch by batch; patched
    keys come with their whole rows (see MergeOnRead.changed)."""
    def handle(ids: Sequence[str], _, batch_id: int) -> None:
        each(table.changed([c for c in ids if c >= from_commit]), batch_id)

    return follow(table, handle, checkpoint, **options)


def follow_aggregate(
    source: KeyedTable, target: KeyedTable, checkpoint: str, groups: dict[str, Column],
    value: Column, where: Column | None = None, **options,
) -> StreamingQuery:
    """Keep `cnt` and `total` of the current rows of a keyed table per group in a target keyed by
    the groups. Each batch takes the rows its commits replaced out and puts the new ones in, so
    updates, late events, deletes and rows that come to satisfy or leave `where` are right; a group
    without rows is deleted. State is the target, one row per group."""
    names = list(groups)

    def handle(ids: Sequence[str], batch: DataFrame, batch_id: int) -> None:
        commit = target.stream_commit(batch, batch_id)
        if commits.is_complete(target.spark, target.log, commit):
            return
        # Stretches of the timeline without a gap: what they changed adds up, whatever their order.
        line = sorted({c for c, _ in source.commit_ids()})
        known, parts = set(ids), []
        for at, c in enumerate(line):
            if c in known and (at == 0 or line[at - 1] not in known):
                parts.append([line[at - 1] if at else "", c])
            elif c in known:
                parts[-1][1] = c
        images = reduce(DataFrame.unionByName, [source.images(*p) for p in parts])
        delta = live.retracted(images, groups, value, where).persist()
        held = target.as_of(target.last_commit()).select(*names, "cnt", "total").join(
            delta.select(*names), names, "left_semi")
        both = delta.unionByName(held).groupBy(*names).agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))
        table_op = F.when(F.col("cnt") == 0, "d").otherwise("u")
        try:
            target.upsert(both.withColumn("op", table_op), commit)
        finally:
            delta.unpersist()

    return follow(source, handle, checkpoint, **options)


def target_schema(schema: T.StructType) -> T.StructType:
    """Target columns plus the event order the rows are ranked by."""
    out = T.StructType(list(schema.fields))
    for name in EVENT_ORDER:
        out = out.add(LOG[name])
    return out


def open_target(
    spark: SparkSession, root: str, db: str, tb: str, kind: str = "mor"
) -> KeyedTable:
    """Keyed target of one captured table, by its registered schema."""
    schema, keys = lookup(db, tb)
    return KeyedTable.create(
        spark, f"{root}/ods_{db}_{tb}", target_schema(schema),
        TableSpec(tuple(keys), EVENT_ORDER, kind=kind),
    )


def apply_log(log: DataFrame, table: KeyedTable, db: str, tb: str, commit: str) -> None:
    """Apply one table's events, deletes included, in one pass.

    Of an event that cannot be applied the log row is kept as it came, see `bad_events`.
    """
    schema, _ = lookup(db, tb)
    event = F.struct(*LOG.names).alias("event")
    changes = typed_changes(select_table(log, db, tb), schema, event)
    upsert_changes(changes, table, commit, kept="event.*")


def fan_out_batch(tables: dict[tuple[str, str], KeyedTable]) -> Batch:
    """Apply a batch of a shared log to each of its tables."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for (db, tb), table in tables.items():
                apply_log(batch, table, db, tb, table.stream_commit(batch, batch_id))
        finally:
            batch.unpersist()

    return each


def fan_out(
    log_path: str,
    spark: SparkSession,
    root: str,
    names: Sequence[tuple[str, str]],
    checkpoint: str,
    interval: str | None = None,
    files_per_trigger: int | None = None,
) -> dict[tuple[str, str], KeyedTable]:
    """Keep many targets up to date from one log. A table added later gets its own query over
    the same log and so starts from its first event. With an interval the query keeps running
    when this returns."""
    tables = {(db, tb): open_target(spark, root, db, tb) for db, tb in names}
    stream = stream_log(spark, log_path, files_per_trigger)
    query = run_batches(stream, fan_out_batch(tables), checkpoint, interval)
    if not interval:
        finish(query)
    return tables
