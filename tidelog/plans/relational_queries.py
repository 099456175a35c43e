"""Projections, filters, joins, aggregates, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.clock import is_today, now
from tidelog.operators.changes import current_state
from tidelog.operators.joins import (
    ChangelogLeftJoin, left_join_cast, stream_lookup, temporal_lookup,
)
from tidelog.operators.ordered import position_in_group, running_sum, with_position
from tidelog.operators.words import word_count
from tidelog.plans.inputs import (
    FEED_ORDER, dealt, drain, env_sql, feed, feed_sql, feed_stream, ntz, per_trigger, table,
)
from tidelog.plans.registry import query
from tidelog.schemas import LONG, STRING, TIMESTAMP, TableSpec, schema
from tidelog.session import scratch
from tidelog.streaming.apply import finish, run_batches
from tidelog.tables.commits import commit_id

CLOCK = "2024-01-05 12:30:00"


@query("rel_project", feed_sql("select id as user_id, data as kind, value as cnt, dt from feed"))
def rel_project(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf).select(
        F.col("id").alias("user_id"), F.col("data").alias("kind"), F.col("value").alias("cnt"),
        "dt",
    )


@query("rel_star_plus", f"select *, timestamp '{CLOCK}' as etl_time from orders")
def rel_star_plus(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return ntz(orders.select("*", now(CLOCK).alias("etl_time")), "etl_time")


@query("rel_filter_eq", """select event_id, ts, value from events
where event_type = 'view' and user_id = 8""")
def rel_filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    mine = events.where((F.col("event_type") == "view") & (F.col("user_id") == 8))
    return mine.select("event_id", "ts", "value")


@query("rel_filter_today", feed_sql("select pos, id, value from feed where dt = '2024-01-05'"))
def rel_filter_today(spark: SparkSession, sf: str) -> DataFrame:
    events = feed(spark, sf).where(is_today(F.col("ts").cast("string"), CLOCK))
    return events.select("pos", "id", "value")


@query("rel_metric_today", feed_sql("""select 'total_amount' as dimension,
  round(sum(value), 2) as metric from feed where dt = '2024-01-05'"""))
def rel_metric_today(spark: SparkSession, sf: str) -> DataFrame:
    today = feed(spark, sf).where(is_today(F.col("ts").cast("string"), CLOCK))
    return today.agg(F.round(F.sum("value"), 2).alias("metric")).select(
        F.lit("total_amount").alias("dimension"), "metric"
    )


@query("rel_left_join_cast", feed_sql(""", ranked as (
  select *, row_number() over (partition by id order by ts desc, pos desc) as rn from feed),
state as (select id, data, value from ranked where rn = 1 and op <> 'd')
select o_orderkey, o_custkey, s.data, s.value
from (select o_orderkey, cast(o_custkey as varchar) as o_custkey from orders) o
left join state s on o.o_custkey = cast(s.id as varchar)"""))
def rel_left_join_cast(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey")
    )
    state = current_state(feed(spark, sf), ["id"], FEED_ORDER).select("id", "data", "value")
    return left_join_cast(orders, state, "o_custkey", "id").drop("id")


FACT = schema(id=LONG, data=STRING, data3=STRING, ts=TIMESTAMP, pos=LONG)
DIMENSION = schema(id=LONG, name=STRING, ts=TIMESTAMP, pos=LONG)


@query("rel_changelog_left_join", feed_sql(""", facts as (
  select id, data, cast(id as varchar) as data3, op,
    row_number() over (partition by id, data order by ts desc, pos desc) as rn
  from feed where pos % 2 = 0),
dims as (
  select id, data as name, op,
    row_number() over (partition by id order by ts desc, pos desc) as rn
  from feed where pos % 2 = 1)
select f.id, f.data, f.data3, d.name
from (select * from facts where rn = 1 and op <> 'd') f
left join (select * from dims where rn = 1 and op <> 'd') d on f.data3 = cast(d.id as varchar)"""))
def rel_changelog_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the feed changes facts (a user's row per kind), the other half dimension rows (one
    per user), arriving out of order."""
    root = scratch(spark, "changelog-join")
    join = ChangelogLeftJoin(
        spark, f"{root}/tables", (FACT, TableSpec(("id", "data"), FEED_ORDER)),
        (DIMENSION, TableSpec(("id",), FEED_ORDER)), "data3", ["name"],
    )
    events = feed(spark, sf)
    dealt(events, "pos").write.parquet(f"{root}/in")
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", per_trigger(spark, f"{root}/in", 2))
        .parquet(f"{root}/in")
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        facts = batch.where("pos % 2 = 0").withColumn("data3", F.col("id").cast("string"))
        dims = batch.where("pos % 2 = 1")
        join.apply(facts, dims.withColumnRenamed("data", "name"), commit_id(batch_id))

    finish(run_batches(stream, each, f"{root}/checkpoint"))
    return join.current().select("id", "data", "data3", "name")


@query("rel_temporal_lookup", feed_sql(""", facts as (
  select pos, id, ts from feed where pos % 2 = 0),
versions as (select id, ts, data, value from feed where pos % 2 = 1)
select f.pos, f.id, v.data, v.value
from facts f asof left join versions v on f.id = v.id and f.ts >= v.ts"""))
def rel_temporal_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Facts with the version of their dimension row valid at the time of the fact."""
    events = feed(spark, sf)
    facts = events.where("pos % 2 = 0").select("pos", "id", "ts")
    versions = events.where("pos % 2 = 1").select(
        "id", F.col("ts").alias("valid_from"), "data", "value", F.col("pos").alias("version")
    )
    found = temporal_lookup(
        facts, versions, ["id"], "ts", "valid_from", ["data", "value"], ["version"]
    )
    return found.select("pos", "id", "data", "value")


@query("rel_stream_static_join", env_sql("""select event_id, cast(id as varchar) as user_id,
  c_name, c_mktsegment from env left join customer on id = c_custkey"""))
def rel_stream_static_join(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    stream = feed_stream(spark, sf).select(
        F.col("id").alias("event_id"),
        F.get_json_object("primary_key_data", "$.id").alias("user_id"),
    )
    found = stream_lookup(
        stream, customer, F.col("user_id") == F.col("c_custkey").cast("string")
    )
    return drain(found.drop("c_custkey"), "lookup")


@query("rel_group_sum", """select event_type, round(sum(value), 2) as total from events
group by event_type""")
def rel_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"))


@query("rel_group_count", "select user_id, count(*) as cnt from events group by user_id")
def rel_group_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("cnt"))


@query("rel_global_agg", """select count(*) as cnt, cast(sum(user_id) as bigint) as ids,
  round(sum(value), 2) as total from events""")
def rel_global_agg(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").agg(
        F.count("*").alias("cnt"), F.sum("user_id").alias("ids"),
        F.round(F.sum("value"), 2).alias("total"),
    )


@query("rel_distinct", feed_sql("select dt from feed group by dt"))
def rel_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf).select("dt").distinct()


@query("rel_sort_desc", """select o_orderkey, o_totalprice,
  row_number() over (order by o_totalprice desc, o_orderkey) as pos from orders""")
def rel_sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_position(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("rel_sort_partition", """select event_id, event_type, value,
  row_number() over (partition by event_type order by value, event_id) as pos from events""")
def rel_sort_partition(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return position_in_group(events, "event_type", [F.asc("value"), F.asc("event_id")])


@query("rel_top_k", """select pos, c_custkey, c_acctbal from (
  select row_number() over (order by c_acctbal desc, c_custkey) as pos, c_custkey, c_acctbal
  from customer) where pos <= 10""")
def rel_top_k(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    top = customer.orderBy(*order).limit(10)  # ten rows are left for the window below
    pos = F.row_number().over(Window.orderBy(*order)).cast("long").alias("pos")
    return top.select(pos, "c_custkey", "c_acctbal")


@query("rel_union_all", """select event_id as id, event_type as name from events
where event_type = 'view' union all select event_id, event_type from events where value > 50
union all select o_orderkey, o_orderstatus from orders""")
def rel_union_all(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    named = events.select(F.col("event_id").alias("id"), F.col("event_type").alias("name"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("name"), F.col("o_orderkey").alias("id")
    )
    return (
        named.where("name = 'view'")
        .unionByName(named.where(events["value"] > 50))
        .unionByName(orders)
    )


@query("rel_running_metric", feed_sql("""select pos, round(sum(coalesce(value, 0)) over
  (order by ts, pos rows unbounded preceding), 2) as metric from feed"""))
def rel_running_metric(spark: SparkSession, sf: str) -> DataFrame:
    """The metric after each single event, in the order of the events."""
    events = feed(spark, sf).select("pos", "ts", F.coalesce("value", F.lit(0.0)).alias("value"))
    run = running_sum(events, [F.asc(c) for c in FEED_ORDER], "value", "metric")
    return run.select("pos", F.round("metric", 2).alias("metric"))


@query("rel_words_regex", """select word, count(*) as n from (
  select unnest(regexp_split_to_array(lower(text), '\\W+')) as word from documents)
where word <> '' group by word""")
def rel_words_regex(spark: SparkSession, sf: str) -> DataFrame:
    return word_count(table(spark, sf, "documents"), "text", "word")


@query("rel_words_space", """select word, count(*) as n from (
  select unnest(case when text = '' then [''] when rtrim(text, ' ') = '' then []
                     else string_split(rtrim(text, ' '), ' ') end) as word from documents)
group by word""")
def rel_words_space(spark: SparkSession, sf: str) -> DataFrame:
    return word_count(table(spark, sf, "documents"), "text", "space")
