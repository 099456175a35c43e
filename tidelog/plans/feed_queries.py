"""Decoding, routing and rendering the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import sql_text
from tidelog.functions.images import json_text, typed_image
from tidelog.operators.changes import known_ops, route, unknown_ops
from tidelog.plans.inputs import (
    IMAGE, env_sql, envelopes, feed, feed_sql, feed_stream, lines, log, ntz,
)
from tidelog.plans.registry import query
from tidelog.schemas import LOG
from tidelog.session import scratch
from tidelog.sources import feed as feeds
from tidelog.streaming.apply import finish, land_log, read_log

LOG_SQL = """event_id as id, '1' as server_id, file, pos, row_no as row, before, after, op, ts_ms,
primary_key_data, db, tb"""


@query("cdc_decode", env_sql(f"select {LOG_SQL} from env"))
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.decode_with(lines(spark, sf), feeds.decode, LOG)


@query("cdc_topic_route", env_sql("select db, tb, count(*) as n from env group by db, tb"))
def cdc_topic_route(spark: SparkSession, sf: str) -> DataFrame:
    topics = feeds.envelope(lines(spark, sf))
    return topics.select(*feeds.topic_route(F.col("topic"))).groupBy("db", "tb").agg(
        F.count("*").alias("n")
    )


@query("cdc_json_to_record", env_sql(f"select {LOG_SQL} from env"))
def cdc_json_to_record(spark: SparkSession, sf: str) -> DataFrame:
    text = log(spark, sf).select(json_text(*LOG.names).alias("value"))
    return feeds.json_to_record(text)


@query("cdc_parse_stock", env_sql("""select ts_ms as id,
  case when before = '{}' then 'null' else before end as before,
  case when after = '{}' then 'null' else after end as after,
  cast(to_json({'version': '1.5.4', 'connector': 'mysql', 'name': 'srv', 'ts_ms': ts_ms,
    'snapshot': case when op = 'r' then 'true' else 'false' end, 'db': db,
    'sequence': cast(null as varchar), 'table': tb, 'server_id': 1,
    'gtid': cast(null as varchar), 'file': file, 'pos': pos, 'row': row_no,
    'thread': cast(null as bigint), 'query': cast(null as varchar)}) as varchar) as source,
  op, ts_ms, 'null' as transaction, db, tb from env"""))
def cdc_parse_stock(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.parse_stock(lines(spark, sf))


@query("cdc_event_id", env_sql(
    "select event_id as id, cast(2 as bigint) as deliveries from env"))
def cdc_event_id(spark: SparkSession, sf: str) -> DataFrame:
    """Every event delivered twice keeps one id."""
    events = log(spark, sf).select("id")
    return events.unionByName(events).groupBy("id").agg(F.count("*").alias("deliveries"))


def landed_log(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "log")
    finish(land_log(feed_stream(spark, sf), f"{root}/log", f"{root}/checkpoint"))
    return read_log(spark, f"{root}/log")


@query("cdc_select_table", env_sql(f"""select {LOG_SQL} from env
where db = 'app' and tb = 'events_b'"""))
def cdc_select_table(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.select_table(landed_log(spark, sf), "app", "events_b").select(*LOG.names)


@query("cdc_land_log", env_sql("""select db, tb, op, count(*) as n,
  count(distinct event_id) as events from env group by db, tb, op"""))
def cdc_land_log(spark: SparkSession, sf: str) -> DataFrame:
    return landed_log(spark, sf).groupBy("db", "tb", "op").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("events")
    )


@query("cdc_typed_image", env_sql(
    "select file, pos, ts_ms, id, value, data, props, ts from env where op <> 'd'"))
def cdc_typed_image(spark: SparkSession, sf: str) -> DataFrame:
    events = log(spark, sf).where("op <> 'd'")
    return ntz(events.select("file", "pos", "ts_ms", *typed_image(F.col("after"), IMAGE)), "ts")


def rendered(events: DataFrame, text) -> DataFrame:
    return events.select("file", "pos", "ts_ms", "op", text.alias("sql"))


# SQL literals of the image fields.
LITERALS = {
    "id": "cast(id as varchar)",
    "value": "cast(value as varchar)",
    "data": "'''' || replace(data, '''', '''''') || ''''",
    "props": "'''' || replace(props, '''', '''''') || ''''",
    "ts": "'to_timestamp(''' || cast(ts as varchar) || ''')'",
}


@query("cdc_sql_insert", env_sql(f"""select file, pos, ts_ms, op,
  'insert into ods_events (' || concat_ws(', ', 'id',
     case when value is not null then 'value' end, 'data', 'props', 'ts') || ') values (' ||
  concat_ws(', ', {', '.join(LITERALS.values())}) || ')' as sql
from env where op in ('c', 'r')"""))
def cdc_sql_insert(spark: SparkSession, sf: str) -> DataFrame:
    text = sql_text.insert_text("ods_events", F.col("after"), IMAGE)
    return rendered(log(spark, sf).where("op in ('c', 'r')"), text)


@query("cdc_sql_insert_null", env_sql(f"""select file, pos, ts_ms, op,
  'insert into ods_events values (' ||
  concat_ws(', ', {', '.join(f"coalesce({v}, 'null')" for v in LITERALS.values())}) || ')' as sql
from env where op in ('c', 'r')"""))
def cdc_sql_insert_null(spark: SparkSession, sf: str) -> DataFrame:
    text = sql_text.insert_text_with_nulls("ods_events", F.col("after"), IMAGE)
    return rendered(log(spark, sf).where("op in ('c', 'r')"), text)


@query("cdc_sql_update", env_sql(f"""select file, pos, ts_ms, op,
  'update ods_events set ' ||
  concat_ws(', ', {', '.join(f"'{n}=' || {v}" for n, v in LITERALS.items() if n != 'id')}) ||
  ' where id=' || cast(id as varchar) as sql from env where op = 'u'"""))
def cdc_sql_update(spark: SparkSession, sf: str) -> DataFrame:
    text = sql_text.update_text(
        "ods_events", F.col("after"), F.col("primary_key_data"), IMAGE, ["id"]
    )
    return rendered(log(spark, sf).where("op = 'u'"), text)


@query("cdc_sql_delete", env_sql("""select file, pos, ts_ms, op,
  'delete from ods_events where id=' || cast(id as varchar) as sql from env where op = 'd'"""))
def cdc_sql_delete(spark: SparkSession, sf: str) -> DataFrame:
    text = sql_text.delete_text("ods_events", F.col("primary_key_data"), IMAGE, ["id"])
    return rendered(log(spark, sf).where("op = 'd'"), text)


def with_truncates(spark: SparkSession, sf: str) -> DataFrame:
    """The feed with an op no target can apply here and there."""
    odd = F.when(F.col("pos") % 101 == 0, "t").otherwise(F.col("op"))
    return feed(spark, sf).withColumn("op", odd)


@query("cdc_op_route", feed_sql("""select dt,
  case when pos % 101 = 0 then 'unknown' when op in ('c', 'r') then 'insert'
       when op = 'u' then 'update' else 'delete' end as action, count(*) as n
from feed group by all"""))
def cdc_op_route(spark: SparkSession, sf: str) -> DataFrame:
    events = with_truncates(spark, sf)
    return events.groupBy("dt", route().alias("action")).agg(F.count("*").alias("n"))


@query("cdc_bad_ops", feed_sql("""select case when pos % 101 = 0 then 'bad' else 'good' end as side,
  case when pos % 101 = 0 then 't' else op end as op, count(*) as n from feed group by all"""))
def cdc_bad_ops(spark: SparkSession, sf: str) -> DataFrame:
    events = feeds.decode(envelopes(with_truncates(spark, sf)))
    both = known_ops(events).select(F.lit("good").alias("side"), "op").unionByName(
        unknown_ops(events).select(F.lit("bad").alias("side"), "op")
    )
    return both.groupBy("side", "op").agg(F.count("*").alias("n"))
