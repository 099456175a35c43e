"""Scalar functions and user code."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import clock
from tidelog.functions.images import field_state, image_map
from tidelog.functions.sql_text import literal
from tidelog.functions.user import map_with_setup, register_splitter
from tidelog.plans.inputs import env_sql, feed, feed_sql, log, ntz, table
from tidelog.plans.registry import query
from tidelog.schemas import STRING

CLOCK = "2024-01-10 12:30:00"


@query("fn_strings", """select doc_id, substr(text, 1, 10) as head,
  lang || '_text' as label, lower(text) as low, length(text) as len,
  cast(len(string_split(text, ' ')) as integer) as pieces from documents""")
def fn_strings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        F.substring("text", 1, 10).alias("head"),
        F.concat("lang", F.lit("_text")).alias("label"),
        F.lower("text").alias("low"),
        F.length("text").cast("long").alias("len"),
        F.size(F.split("text", " ")).alias("pieces"),
    )


@query("fn_sql_literal", """select doc_id,
  '''' || replace(text, '''', '''''') || '''' as literal from documents""")
def fn_sql_literal(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", literal(F.col("text"), STRING).alias("literal")
    )


@query("fn_cast_string", """select o_orderkey, cast(o_custkey as varchar) as custkey,
  cast(o_totalprice as varchar) as price, cast(o_orderdate as varchar) as day from orders""")
def fn_cast_string(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("custkey"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderdate").cast("string").alias("day"),
    )


@query("fn_clock", feed_sql(f"""select pos, timestamp '{CLOCK}' as load_time,
  '2024-01-10' as load_day, dt = '2024-01-10' as today from feed"""))
def fn_clock(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(feed(spark, sf).select(
        "pos",
        clock.now(CLOCK).alias("load_time"),
        clock.today(CLOCK).alias("load_day"),
        clock.is_today(F.col("ts").cast("string"), CLOCK).alias("today"),
    ), "load_time")


@query("fn_to_timestamp", """select event_id,
  case when event_id % 7 <> 0 then date_trunc('second', ts) end as at from events""")
def fn_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """ISO texts with a zone, some of them malformed."""
    text = F.col("ts").cast("string")
    iso = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z"))
    given = F.when(F.col("event_id") % 7 != 0, iso).otherwise(F.concat(F.lit("no "), iso))
    events = table(spark, sf, "events")
    return ntz(events.select("event_id", F.try_to_timestamp(given).alias("at")), "at")


@query("fn_epoch_ms", """select event_id, epoch_us(ts) // 1000 as ms,
  date_trunc('milliseconds', ts) as at from events""")
def fn_epoch_ms(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", clock.timestamp_to_millis(F.col("ts")).alias("ms")
    )
    return ntz(events.withColumn("at", clock.millis_to_timestamp(F.col("ms"))), "at")


@query("fn_json", """select event_id, json_extract_string(props, '$.k') as k,
  '{"k":"' || json_extract_string(props, '$.k') || '"}' as text from events""")
def fn_json(spark: SparkSession, sf: str) -> DataFrame:
    fields = image_map(F.col("props"))
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.to_json(fields).alias("text"),
    )


@query("fn_map_contains", env_sql("""select event_id,
  case when op = 'd' then 'absent' when value is null then 'null' else 'value' end as value,
  case when op = 'd' then 'absent' else 'value' end as data, 'absent' as other from env"""))
def fn_map_contains(spark: SparkSession, sf: str) -> DataFrame:
    after = F.col("after")
    return log(spark, sf).select(
        F.col("id").alias("event_id"),
        field_state(after, "value").alias("value"),
        field_state(after, "data").alias("data"),
        field_state(after, "other").alias("other"),
    )


@query("fn_struct", feed_sql(
    "select pos, id as q1, data as q2, id * 2 as doubled from feed"))
def fn_struct(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed(spark, sf).select(
        "pos", F.struct(F.col("id").alias("q1"), F.col("data").alias("q2")).alias("family")
    )
    return rows.select("pos", "family.*", (F.col("family.q1") * 2).alias("doubled"))


@query("fn_json_numbers", """select event_id, 9000000000000000000 + event_id as big,
  cast(value as varchar) as text, cast(user_id as varchar) as whole from events""")
def fn_json_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """19-digit ids survive JSON, an int does not become a double."""
    big = F.col("event_id") + F.lit(9_000_000_000_000_000_000)
    image = F.to_json(F.struct(big.alias("big"), "value", F.col("user_id").alias("whole")))
    fields = table(spark, sf, "events").select("event_id", image_map(image).alias("m"))
    return fields.select(
        "event_id",
        F.col("m")["big"].cast("long").alias("big"),
        F.col("m")["value"].alias("text"),
        F.col("m")["whole"].alias("whole"),
    )


@query("ud_udtf_split", """select word, count(*) as n from (
  select unnest(string_split(text, ' ')) as word from conversations) group by word""")
def ud_udtf_split(spark: SparkSession, sf: str) -> DataFrame:
    register_splitter(spark, "tide_split", lambda text: text.split(" "))
    table(spark, sf, "conversations").createOrReplaceTempView("tide_conversations")
    return spark.sql(
        "SELECT word, count(*) AS n FROM tide_conversations, LATERAL tide_split(text) "
        "GROUP BY word"
    )


@query("ud_map_partitions", """select conv_id, turn,
  cast(len(list_filter(regexp_split_to_array(text, '[^a-zA-Z]+'), lambda x: x <> '')) as bigint)
    as words from conversations""")
def ud_map_partitions(spark: SparkSession, sf: str) -> DataFrame:
    def count(pattern, batch: pd.DataFrame) -> pd.DataFrame:
        words = batch["text"].map(lambda t: len(pattern.findall(t)))
        return batch[["conv_id", "turn"]].assign(words=words)

    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return map_with_setup(
        rows, lambda: re.compile("[a-zA-Z]+"), count, "conv_id long, turn long, words long"
    )
