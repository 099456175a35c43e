"""Applying changes to keyed tables and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.changes import current_state, latest_per_key, partial_state
from tidelog.plans.inputs import (
    FEED_ORDER, IMAGE, feed, feed_sql, feed_stream, feed_table, land_feed, log, ntz,
    state_sql, table,
)
from tidelog.plans.registry import query
from tidelog.schemas import EVENT_ORDER, TableSpec
from tidelog.session import scratch
from tidelog.sources import jdbc
from tidelog.sources.feed import decode, read_feed, typed_changes
from tidelog.streaming.apply import (
    apply_log, bad_events, finish, open_target, run_batches, stream_upsert, target_schema,
)
from tidelog.tables.commits import commit_id
from tidelog.tables.keyed import KeyedTable

STATE = ("id", "value", "data", "props", "ts", "dt")
STATE_SQL = ", ".join(STATE)


@query("app_current_state", state_sql(f"{STATE_SQL}, pos, op"))
def app_current_state(spark: SparkSession, sf: str) -> DataFrame:
    return current_state(feed(spark, sf), ["id"], FEED_ORDER).select(*STATE, "pos", "op")


@query("app_partial_update", feed_sql(""", gone as (
  select id, max((ts, pos)) as at from feed where op = 'd' group by id),
alive as (
  select f.* from feed f left join gone g on f.id = g.id
  where g.at is null or (f.ts, f.pos) > g.at)
select id, arg_max(value, (ts, pos)) filter (where value is not null) as value,
       arg_max(data, (ts, pos)) as data, arg_max(props, (ts, pos)) as props
from alive group by id"""))
def app_partial_update(spark: SparkSession, sf: str) -> DataFrame:
    return partial_state(feed(spark, sf), ["id"], FEED_ORDER, ["value", "data", "props"])


@query("app_patch_out_of_order", feed_sql(""", cells as (
  select id, arg_max(op, (ts, pos)) as op,
    arg_max({'v': case when op <> 'd' then value end}, (ts, pos))
      filter (where op <> 'u' or value is not null) as value,
    arg_max({'v': case when op <> 'd' then data end}, (ts, pos))
      filter (where op <> 'u' or pos % 2 = 0) as data,
    arg_max({'v': case when op <> 'd' then props end}, (ts, pos))
      filter (where op <> 'u' or pos % 2 = 1) as props, arg_max(pos, (ts, pos)) as pos
  from feed group by id)
select id, value.v as value, data.v as data, props.v as props, pos from cells where op <> 'd'"""))
def app_patch_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Updates that say something about some columns only, and whole rows and deletes, by turns
    and the later ones first: each column has the last word said about it."""
    t, events = feed_table(spark, "patched"), feed(spark, sf)
    parts = events.withColumns({
        "data": F.when(F.col("pos") % 2 == 0, F.col("data")), "props": F.when(F.col("pos") % 2 == 1, F.col("props")),
    }).where("op = 'u'")
    whole = events.where("op <> 'u'")
    t.patch(parts.where("dt > '2024-01-15'"), "c1")
    t.upsert(whole.where("dt <= '2024-01-10'"), "c2")
    t.patch(parts.where("dt <= '2024-01-15'"), "c3")
    t.upsert(whole.where("dt > '2024-01-10'"), "c4")
    return t.snapshot().select("id", "value", "data", "props", "pos")


def keyed_copy(
    spark: SparkSession, df: DataFrame, key: str, label: str, kind: str = "mor", **spec
) -> KeyedTable:
    """An empty keyed table for the rows of a driver table."""
    return KeyedTable.create(
        spark, scratch(spark, label), df.schema, TableSpec((key,), kind=kind, **spec)
    )


def rows(t: KeyedTable) -> DataFrame:
    return t.snapshot().drop("commit_time")


@query("app_insert", """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority from orders where o_orderstatus <> 'F'""")
def app_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Insert that starts the table anew, over one that had other rows."""
    orders = table(spark, sf, "orders")
    t = keyed_copy(spark, orders, "o_orderkey", "insert", "cow")
    t.insert(orders.where("o_orderstatus = 'F'"), "c1")
    t.insert(orders.where("o_orderstatus <> 'F'"), "c2", overwrite=True)
    return rows(t)


def upsert_in_parts(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    t = feed_table(spark, f"upsert-{kind}", kind)
    events = feed(spark, sf)
    t.upsert(events.where("dt <= '2024-01-10'"), "c1")
    t.upsert(events.where("dt > '2024-01-20'"), "c2")
    t.upsert(events.where("dt > '2024-01-10' and dt <= '2024-01-20'"), "c3")
    return ntz(t.snapshot().select(*STATE), "ts")


@query("app_upsert_mor", state_sql(STATE_SQL))
def app_upsert_mor(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_in_parts(spark, sf, "mor")


@query("app_upsert_cow", state_sql(STATE_SQL))
def app_upsert_cow(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_in_parts(spark, sf, "cow")


@query("app_delete_keys", "select * from customer where c_nationkey <> 3")
def app_delete_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Delete by key alone; as many of the keys again are not in the table."""
    customer = table(spark, sf, "customer")
    t = keyed_copy(spark, customer, "c_custkey", "delete")
    t.insert(customer, "c1")
    keys = customer.where("c_nationkey = 3").select("c_custkey")
    absent = keys.select((F.col("c_custkey") + 1_000_000_000_000).alias("c_custkey"))
    t.delete_keys(keys.unionByName(absent), "c2")
    return rows(t)


@query("app_bulk_insert", """select c_custkey, c_name, cast(2 as bigint) as versions
from customer""")
def app_bulk_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Two bulk inserts of the same rows are two versions of each."""
    customer = table(spark, sf, "customer")
    t = keyed_copy(spark, customer, "c_custkey", "bulk")
    t.bulk_insert(customer, "c1")
    t.bulk_insert(customer, "c2")
    return t.versions().groupBy("c_custkey", "c_name").agg(F.count("*").alias("versions"))


@query("app_update_where", """select p_partkey, p_name, p_brand, p_type,
  case when p_brand = 'Brand#1' then p_size + 100 else p_size end as p_size, p_retailprice
from part""")
def app_update_where(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    t = keyed_copy(spark, part, "p_partkey", "update")
    t.insert(part, "c1")
    t.update_where("p_brand = 'Brand#1'", {"p_size": F.col("p_size") + 100}, "c2")
    return rows(t)


@query("app_delete_where", "select * from part where not p_size > 25")
def app_delete_where(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    t = keyed_copy(spark, part, "p_partkey", "delete-where", "cow")
    t.insert(part, "c1")
    t.delete_where("p_size > 25", "c2")
    return rows(t)


@query("app_truncate", "select * from supplier where s_nationkey < 5")
def app_truncate(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    t = keyed_copy(spark, supplier, "s_suppkey", "truncate")
    t.insert(supplier, "c1")
    t.truncate("c2")
    t.insert(supplier.where("s_nationkey < 5"), "c3")
    return rows(t)


@query("app_apply_feed", state_sql(
    "id, value, data, props, ts", "db = 'app' and tb = 'events_b'", "env"))
def app_apply_feed(spark: SparkSession, sf: str) -> DataFrame:
    """All four ops of one table's events, the later half first."""
    t = open_target(spark, scratch(spark, "apply"), "app", "events_b")
    events = log(spark, sf)
    half = 1705363200000
    apply_log(events.where(F.col("ts_ms") >= half), t, "app", "events_b", "c1")
    apply_log(events.where(F.col("ts_ms") < half), t, "app", "events_b", "c2")
    return ntz(t.snapshot().select(*IMAGE.names), "ts")


@query("app_stream_upsert", state_sql("id, value, data, props, ts", source="env"))
def app_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "stream-upsert")
    t = KeyedTable.create(
        spark, f"{root}/table", target_schema(IMAGE), TableSpec(("id",), EVENT_ORDER)
    )
    changes = typed_changes(feed_stream(spark, sf), IMAGE)
    finish(stream_upsert(changes, t, f"{root}/checkpoint"))
    return ntz(t.snapshot().select(*IMAGE.names), "ts")


@query("app_stream_reason_column", feed_sql(""", ranked as (
  select *, row_number() over (partition by id order by ts desc, pos desc) as rn from feed)
select id, data as reason, pos from ranked where rn = 1 and op <> 'd'"""))
def app_stream_reason_column(spark: SparkSession, sf: str) -> DataFrame:
    """A stream into a table with a column named like one of the library's own."""
    root = scratch(spark, "reason-column")
    events = feed(spark, sf).select("id", F.col("data").alias("reason"), "ts", "pos", "op")
    events.repartition(3).write.parquet(f"{root}/in")
    kinds = events.schema
    t = KeyedTable.create(spark, f"{root}/table", events.drop("op").schema, TableSpec(("id",), ("ts", "pos")))
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    finish(stream_upsert(stream, t, f"{root}/checkpoint"))
    return t.snapshot().select("id", "reason", "pos")


@query("cdc_bad_events", feed_sql("""select
  case when pos % 101 = 0 then 'op' else 'key' end as reason, count(*) as n
from feed where pos % 101 = 0 or pos % 103 = 0 group by all"""))
def cdc_bad_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of an unknown op or without a key, which a stream keeps beside its table."""
    root = scratch(spark, "bad-events")
    odd = feed(spark, sf).withColumns({
        "op": F.when(F.col("pos") % 101 == 0, "t").otherwise(F.col("op")),
        "id": F.when(F.col("pos") % 103 != 0, F.col("id")),
    })
    land_feed(odd, f"{root}/landed")
    events = decode(read_feed(spark, f"{root}/landed", streaming=True))
    t = KeyedTable.create(
        spark, f"{root}/table", target_schema(IMAGE), TableSpec(("id",), EVENT_ORDER)
    )
    finish(stream_upsert(typed_changes(events, IMAGE), t, f"{root}/checkpoint"))
    return bad_events(t).groupBy("reason").agg(F.count("*").alias("n"))


@query("app_jdbc_upsert", state_sql("id, value, data"))
def app_jdbc_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A changing query's rows upserted by primary key as its batches come."""
    options = jdbc.connection(spark, "sink")
    target = "feed_result"
    columns = ["id", "value", "data"]
    events = feed(spark, sf)
    jdbc.write_table(events.select(*columns).where("false"), options, target)
    # Batches split by key, so that which is the newest does not depend on the batch.
    for batch_id in range(3):
        batch = events.where(F.pmod(F.col("id"), F.lit(3)) == batch_id)
        latest = current_rows(batch)
        jdbc.upsert_batch(options, target, ["id"])(latest.select(*columns, "op"), batch_id)
        jdbc.upsert_batch(options, target, ["id"])(latest.select(*columns, "op"), batch_id)
    return jdbc.read_table(spark, options, target)


def current_rows(events: DataFrame) -> DataFrame:
    """Latest event per key, deletes kept, as an upsert sink takes them."""
    return latest_per_key(events, ["id"], FEED_ORDER)


@query("app_kudu_shape_upsert", state_sql("id, data, value as cnt, ts, dt"))
def app_kudu_shape_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Row shape with count, load time and day, streamed through the JDBC upsert."""
    options = jdbc.connection(spark, "wide_sink")
    target = "wide_result"
    root = scratch(spark, "wide")
    state = KeyedTable.create(
        spark, f"{root}/state", target_schema(IMAGE), TableSpec(("id",), EVENT_ORDER)
    )
    shaped = ["id", "data", F.col("value").alias("cnt"), "ts",
              F.substring(F.col("ts").cast("string"), 1, 10).alias("dt")]
    empty = state.snapshot().select(*shaped)
    jdbc.write_table(empty, options, target)

    def each(batch: DataFrame, batch_id: int) -> None:
        """Fold the batch in, then upsert the state of just the keys it changed."""
        commit = state.upsert(batch, commit_id(batch_id))
        keys = batch.select("id").distinct()
        now = state.as_of(commit).join(keys, ["id"], "left_semi").select(*shaped)
        live = now.withColumn("op", F.lit("u"))
        gone = keys.join(now.select("id"), ["id"], "left_anti").withColumn("op", F.lit("d"))
        jdbc.upsert_table(
            live.unionByName(gone, allowMissingColumns=True), options, target, ["id"]
        )

    changes = typed_changes(feed_stream(spark, sf, batches=2), IMAGE)
    finish(run_batches(changes, each, f"{root}/checkpoint"))
    return ntz(jdbc.read_table(spark, options, target), "ts")
