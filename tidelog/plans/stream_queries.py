"""Continuous queries, run to the end of the landed feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.images import image_map
from tidelog.operators.changes import current_state
from tidelog.operators.ordered import previous
from tidelog.plans.inputs import (
    FEED_ORDER, IMAGE, env_sql, feed, feed_sql, feed_stream, land_feed, ntz,
    per_trigger, state_sql,
)
from tidelog.plans.registry import query
from tidelog.schemas import DOUBLE, EVENT_ORDER, LONG, STRING, TIMESTAMP, TableSpec, schema
from tidelog.session import scratch
from tidelog.sources.feed import decode, read_feed, typed_changes
from tidelog.streaming import live
from tidelog.streaming.apply import (
    fan_out, finish, follow_aggregate, land_batch, land_log, read_log, run_batches, stream_upsert, target_schema,
)
from tidelog.tables import commits
from tidelog.tables.keyed import KeyedTable


def state_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable.create(spark, path, target_schema(IMAGE), TableSpec(("id",), EVENT_ORDER))


def rows(t: KeyedTable) -> DataFrame:
    return ntz(t.snapshot().select(*IMAGE.names), "ts")


@query("st_processing_window", "select event_type as data, count(*) as n from events group by 1")
def st_processing_window(spark: SparkSession, sf: str) -> DataFrame:
    """Which window an event falls in depends on when it is run; over all windows every event
    counts once."""
    root = scratch(spark, "processing-window")
    columns = schema(window_start=TIMESTAMP, window_end=TIMESTAMP, data=STRING, n=LONG)
    t = KeyedTable.create(
        spark, f"{root}/windows", columns, TableSpec(("window_start", "data"))
    )
    stream = feed_stream(spark, sf).select(kind_of().alias("data"))
    counts = live.processing_time_sum(stream, "5 seconds", ["data"], F.lit(1), "n")
    finish(stream_upsert(counts, t, f"{root}/checkpoint", mode="update"))
    return t.snapshot().groupBy("data").agg(F.sum("n").alias("n"))


def kind_of():
    """The `data` field of an event's image."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return image_map(image).getItem("data")


@query("st_tumbling", env_sql("""select time_bucket(interval '5 seconds', ts) as window_start,
  time_bucket(interval '5 seconds', ts) + interval '5 seconds' as window_end, data,
  count(*) as n, round(sum(coalesce(value, 0)), 2) as total from env group by all"""))
def st_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "tumbling")
    columns = schema(
        window_start=TIMESTAMP, window_end=TIMESTAMP, data=STRING, n=LONG, total=DOUBLE
    )
    t = KeyedTable.create(
        spark, f"{root}/windows", columns, TableSpec(("window_start", "data"))
    )
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    stream = feed_stream(spark, sf).select(image_map(image).alias("m")).select(
        F.try_to_timestamp(F.col("m")["ts"]).alias("ts"),
        F.col("m")["data"].alias("data"),
        F.coalesce(F.col("m")["value"].try_cast("double"), F.lit(0.0)).alias("value"),
    )
    counts = live.tumbling(
        stream, "ts", "5 seconds", ["data"],
        F.count("*").alias("n"), F.sum("value").alias("total"),
    )
    finish(stream_upsert(counts, t, f"{root}/checkpoint", mode="update"))
    out = t.snapshot().drop("commit_time").withColumn("total", F.round("total", 2))
    return ntz(out, "window_start", "window_end")


@query("st_running_count", "select 'all' as dimension, count(*) as cnt from events")
def st_running_count(spark: SparkSession, sf: str) -> DataFrame:
    """Each emission is a row under the time it was made; the last one is the count."""
    root = scratch(spark, "running-count")
    t = KeyedTable.create(
        spark, f"{root}/counts", schema(ts=STRING, dimension=STRING, cnt=LONG),
        TableSpec(("ts",)),
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        emitted = batch.withColumn("ts", F.current_timestamp().cast("string"))
        t.upsert(emitted, commits.commit_id(batch_id))

    counts = live.running_count(feed_stream(spark, sf))
    finish(run_batches(counts, each, f"{root}/checkpoint", mode="update"))
    return t.snapshot().groupBy("dimension").agg(F.max_by("cnt", "commit_time").alias("cnt"))


@query("st_running_metric", feed_sql(""", ranked as (
  select *, row_number() over (partition by id order by ts desc, pos desc) as rn from feed)
select 'total_amount' as dimension, round(sum(value), 2) as metric
from ranked where rn = 1 and op <> 'd'"""))
def st_running_metric(spark: SparkSession, sf: str) -> DataFrame:
    """Sum over the current rows, kept by adding what each event changes."""
    root = scratch(spark, "running-metric")
    # What a row held before an event: nothing after a delete.
    held = feed(spark, sf).withColumn("held", F.when(F.col("op") != "d", F.col("value")))
    events = previous(held, ["id"], FEED_ORDER, {"held": "prior"})
    # A snapshot or insert event of a key that exists replaces its row like an update.
    upserts = F.when(F.col("op") != "d", "u").otherwise("d")
    land_feed(events.withColumn("op", upserts), f"{root}/in", F.col("prior"))
    stream = decode(
        read_feed(spark, f"{root}/in", streaming=True,
                  files_per_trigger=per_trigger(spark, f"{root}/in"))
    )
    changes = stream.select(
        "op",
        image_map(F.col("after")).getItem("value").try_cast("double").alias("value"),
        image_map(F.col("before")).getItem("value").try_cast("double").alias("prior"),
    )
    metric = live.running_metric(
        changes, "total_amount", live.change_delta("value", "prior")
    )
    t = KeyedTable.create(
        spark, f"{root}/metrics", schema(dimension=STRING, metric=DOUBLE),
        TableSpec(("dimension",)),
    )
    finish(stream_upsert(metric, t, f"{root}/checkpoint", mode="update"))
    return t.snapshot().select("dimension", F.round("metric", 2).alias("metric"))


RANKED = """, ranked as (
  select *, row_number() over (
    partition by id order by ts_ms desc, file desc, pos desc, row_no desc) as rn from env)"""


def ods_and_figures(spark: SparkSession, sf: str, root: str, where: Column | None = None) -> KeyedTable:
    """A feed to a keyed table, and figures of its current rows per day to another one, in turns:
    the second query goes on behind the commits it has seen."""
    day = F.substring(F.col("ts").cast("string"), 1, 10)
    ods = state_table(spark, f"{root}/ods")
    dw = KeyedTable.create(
        spark, f"{root}/dw", schema(dt=STRING, cnt=LONG, total=DOUBLE), TableSpec(("dt",))
    )
    changes = typed_changes(feed_stream(spark, sf), IMAGE)
    for step in range(2):
        if step:
            finish(stream_upsert(changes, ods, f"{root}/checkpoint-ods"))
        finish(follow_aggregate(ods, dw, f"{root}/checkpoint-dw", {"dt": day}, F.col("value"), where,
                                commits_per_trigger=1))
    return dw


@query("st_ods_to_dw", env_sql(f"""{RANKED}
select dt, count(*) as cnt, round(sum(coalesce(value, 0)), 2) as total
from ranked where rn = 1 and op <> 'd' group by dt"""))
def st_ods_to_dw(spark: SparkSession, sf: str) -> DataFrame:
    """Feed to a keyed table by one query, its current rows to daily figures by another."""
    dw = ods_and_figures(spark, sf, scratch(spark, "ods-dw"))
    return dw.snapshot().select("dt", "cnt", F.round("total", 2).alias("total"))


@query("st_metric_today", env_sql(f"""{RANKED},
figures as (
  select dt, count(*) as cnt, round(sum(coalesce(value, 0)), 2) as total
  from ranked where rn = 1 and op <> 'd' and data in ('click', 'purchase') group by dt)
select 'total_amount' as dimension, dt, cnt, total from figures where dt = (select max(dt) from figures)"""))
def st_metric_today(spark: SparkSession, sf: str) -> DataFrame:
    """Sum over the rows that satisfy a filter now, of the newest day. Rows go out as they are
    updated across the filter or deleted; kept per day, it turns with the day by itself."""
    dw = ods_and_figures(spark, sf, scratch(spark, "metric-today"), F.col("data").isin("click", "purchase"))
    days = dw.snapshot()
    newest = days.agg(F.max("dt").alias("dt"))
    return days.join(newest, "dt").select(
        F.lit("total_amount").alias("dimension"), "dt", "cnt", F.round("total", 2).alias("total")
    )


@query("st_replay_idempotent", env_sql("select op, count(*) as n from env group by op"))
def st_replay_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Every batch is written twice, and the whole stream once more without its checkpoint."""
    root = scratch(spark, "replay")
    land = land_batch(f"{root}/log")

    def twice(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id)
        land(batch, batch_id)

    for attempt in ("first", "again"):
        stream = feed_stream(spark, sf)
        finish(run_batches(stream, twice, f"{root}/checkpoint-{attempt}"))
    return read_log(spark, f"{root}/log").groupBy("op").agg(F.count("*").alias("n"))


@query("st_resume", state_sql("id, value, data, props, ts", source="env"))
def st_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The query stops, more files land, and a new query goes on from the checkpoint."""
    root = scratch(spark, "resume")
    t = state_table(spark, f"{root}/table")
    early = F.col("dt") <= "2024-01-12"
    for n, part in enumerate((early, ~early)):
        land_feed(feed(spark, sf).where(part), f"{root}/in/part={n}")
        stream = decode(read_feed(spark, f"{root}/in", streaming=True))
        finish(stream_upsert(typed_changes(stream, IMAGE), t, f"{root}/checkpoint"))
    return rows(t)


@query("st_out_of_order", state_sql("id, value, data, props, ts", source="env"))
def st_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """State held by a streaming aggregate: the order key decides, not the arrival."""
    root = scratch(spark, "out-of-order")
    t = state_table(spark, f"{root}/table")
    changes = typed_changes(feed_stream(spark, sf), IMAGE)
    state = current_state(changes, ["id"], EVENT_ORDER)
    finish(stream_upsert(state, t, f"{root}/checkpoint", mode="update"))
    return rows(t)


@query("st_fan_out", env_sql(""", ranked as (
  select *, row_number() over (partition by tb, id order by ts_ms desc, file desc, pos desc) as rn
  from env where db = 'app')
select tb, id, value, data from ranked where rn = 1 and op <> 'd'"""))
def st_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """One shared log feeds many tables; the second is added when the first is done."""
    root = scratch(spark, "fan-out")
    finish(land_log(feed_stream(spark, sf), f"{root}/log", f"{root}/checkpoint-log"))
    found = []
    for tb in ("events_a", "events_b"):
        tables = fan_out(
            f"{root}/log", spark, root, [("app", tb)], f"{root}/checkpoint-{tb}"
        )
        found.append(tables["app", tb].snapshot().select(
            F.lit(tb).alias("tb"), "id", "value", "data"
        ))
    return found[0].unionByName(found[1])
