"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.words import word_count
from tidelog.plans.inputs import (
    IMAGE, dealt, env_sql, feed, feed_sql, feed_stream, land_text, log, ntz, per_trigger, state_sql,
    table,
)
from tidelog.plans.registry import query
from tidelog.schemas import LONG, STRING, TableSpec, schema
from tidelog.session import scratch
from tidelog.sources import feed as feeds
from tidelog.sources import jdbc, kafka, nested
from tidelog.sources.files import read_lines, stream_lines
from tidelog.streaming.apply import finish, land_log, read_log, stream_upsert
from tidelog.tables.catalog import create_as, first_rows, new_database
from tidelog.tables.keyed import KeyedTable

EVENT = ("primary_key_data", "file", "pos", "op", "ts_ms")
EVENT_COLUMNS = ", ".join(EVENT)


@query("src_feed_stream", env_sql(f"select event_id as id, db, tb, {EVENT_COLUMNS} from env"))
def src_feed_stream(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "feed-stream")
    finish(land_log(feed_stream(spark, sf), f"{root}/log", f"{root}/checkpoint"))
    return read_log(spark, f"{root}/log").select("id", "db", "tb", *EVENT)


@query("src_start_initial", env_sql(f"select {EVENT_COLUMNS} from env"))
def src_start_initial(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.start_from(log(spark, sf), "initial").select(*EVENT)


@query("src_start_earliest", env_sql(f"select {EVENT_COLUMNS} from env where op <> 'r'"))
def src_start_earliest(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.start_from(log(spark, sf), "earliest").select(*EVENT)


@query("src_start_offset", env_sql(f"""select {EVENT_COLUMNS} from env
where file > 'mysql-bin.000000001' or (file = 'mysql-bin.000000001' and pos >= 50004)"""))
def src_start_offset(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.start_from(
        log(spark, sf), "offset", file="mysql-bin.000000001", pos=50004
    ).select(*EVENT)


@query("src_start_timestamp", env_sql(f"""select {EVENT_COLUMNS} from env
where ts >= timestamp '2024-01-10 00:00:00'"""))
def src_start_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.start_from(log(spark, sf), "timestamp", ts_ms=1704844800000).select(*EVENT)


@query("src_start_latest", env_sql(f"""select {EVENT_COLUMNS} from env
where ts > (select max(ts) from env where dt <= '2024-01-15')"""))
def src_start_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Start when the feed has come to the fifteenth of the month."""
    events = log(spark, sf)
    there = feeds.end_position(events.where(F.col("ts_ms") < 1705363200000))
    return feeds.start_from(events, "latest", after=there).select(*EVENT)


@query("src_table_filter", env_sql(f"""select db, tb, {EVENT_COLUMNS} from env
where db = 'audit' or tb = 'events_b'"""))
def src_table_filter(spark: SparkSession, sf: str) -> DataFrame:
    patterns = [r"audit\..*", r"app\.events_b"]
    return feeds.table_filter(log(spark, sf), patterns).select("db", "tb", *EVENT)


@query("src_changelog_table", state_sql(
    "id, value, data, props, ts", "db = 'app' and tb = 'events_a'", "env"))
def src_changelog_table(spark: SparkSession, sf: str) -> DataFrame:
    events = feeds.select_table(log(spark, sf), "app", "events_a")
    return ntz(feeds.changelog_table(events, IMAGE, ["id"]), "ts")


@query("src_jdbc", "select p_partkey, p_name, p_size, p_retailprice from part where p_size > 20")
def src_jdbc(spark: SparkSession, sf: str) -> DataFrame:
    options = jdbc.connection(spark, "src")
    part = table(spark, sf, "part")
    jdbc.write_table(part, options, "part_copy")
    top = part.agg(F.max("p_partkey")).first()[0]
    scan = jdbc.read_table(
        spark, options, "part_copy", "p_partkey", 0, top + 1, partitions=8
    )
    return scan.where("p_size > 20").select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("src_catalog_limit", """select o_orderkey, o_custkey, o_orderstatus from orders
order by o_orderkey limit 10""")
def src_catalog_limit(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{new_database(spark, 'limited')}.orders"
    create_as(spark, name, table(spark, sf, "orders"))
    rows = spark.table(name).select("o_orderkey", "o_custkey", "o_orderstatus")
    return first_rows(rows, 10, ["o_orderkey"])


@query("src_values", """select w.word, cast(sum(w.frequency) as bigint) as frequency, count(*) as n
from events e join (values ('view', 1), ('click', 2), ('view', 3)) as w(word, frequency)
  on e.event_type = w.word group by w.word""")
def src_values(spark: SparkSession, sf: str) -> DataFrame:
    """Inline rows as a table, joined with the events they name."""
    words = spark.sql(
        "select * from values ('view', 1L), ('click', 2L), ('view', 3L) as w(word, frequency)"
    )
    events = table(spark, sf, "events").select(F.col("event_type").alias("word"))
    return events.join(F.broadcast(words), "word").groupBy("word").agg(
        F.sum("frequency").alias("frequency"), F.count("*").alias("n")
    )


WORDS_SQL = """select word, count(*) as n from (
  select unnest(regexp_split_to_array(lower(text), '\\W+')) as word from {source})
where word <> '' group by word"""


@query("src_text_stream", WORDS_SQL.format(source="documents"))
def src_text_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Lines arrive, counts per word are revised in a keyed table."""
    root = scratch(spark, "lines")
    texts = dealt(table(spark, sf, "documents"), "doc_id").select(F.col("text").alias("value"))
    land_text(texts, f"{root}/in")
    stream = stream_lines(
        spark, f"{root}/in", files_per_trigger=per_trigger(spark, f"{root}/in")
    )
    counts = KeyedTable.create(
        spark, f"{root}/counts", schema(word=STRING, n=LONG), TableSpec(("word",))
    )
    finish(stream_upsert(word_count(stream), counts, f"{root}/checkpoint", mode="update"))
    return counts.snapshot().select("word", "n")


@query("src_text_multi", WORDS_SQL.format(
    source="(select text from documents union all select text from conversations)"))
def src_text_multi(spark: SparkSession, sf: str) -> DataFrame:
    paths = []
    for name in ("documents", "conversations"):
        text = table(spark, sf, name).select(F.col("text").alias("value"))
        paths.append(scratch(spark, name))
        text.write.text(paths[-1])
    return word_count(read_lines(spark, paths))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """The feed as Kafka records."""
    return feed(spark, sf).select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.to_csv(F.struct("id", "pos", "data")).cast("binary").alias("value"),
        F.lit("user_behavior").alias("topic"),
        (F.col("id") % 4).cast("int").alias("partition"),
        F.col("pos").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "op",
    )


@query("src_kafka_csv", feed_sql(
    "select id as user_id, pos as item_id, data as behavior, ts from feed"))
def src_kafka_csv(spark: SparkSession, sf: str) -> DataFrame:
    shape = "user_id bigint, item_id bigint, behavior string"
    return ntz(kafka.decode_csv(records(spark, sf), shape), "ts")


@query("src_upsert_kafka", state_sql(
    "cast(id as varchar) as key, id || ',' || pos || ',' || data as value"))
def src_upsert_kafka(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("op") != "d", F.col("value")).alias("value")
    tombstoned = records(spark, sf).select("key", value, "partition", "offset", "timestamp")
    return kafka.upsert_state(tombstoned).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


# Families of the wide row, as {family: {qualifier: feed column}}.
FAMILIES = {
    "family1": {"q1": "id"},
    "family2": {"q2": "data", "q3": "pos"},
    "family3": {"q4": "value", "q5": "flag", "q6": "dt"},
}


def families(spark: SparkSession, sf: str) -> DataFrame:
    flat = feed(spark, sf).withColumn("flag", F.col("op") == "c")
    path = scratch(spark, "families")
    nested.build_families(flat, "pos", FAMILIES).write.parquet(path)
    return spark.read.parquet(path)


@query("src_nested_families", feed_sql(
    "select pos as rowkey, id as q1, value as q4, dt as q6 from feed"))
def src_nested_families(spark: SparkSession, sf: str) -> DataFrame:
    return nested.scan_families(
        families(spark, sf), ["family1.q1", "family3.q4", "family3.q6"]
    )


@query("app_nested_write", feed_sql("""select pos as rowkey, id as q1, data as q2, pos as q3,
value as q4, op = 'c' as q5, dt as q6 from feed"""))
def app_nested_write(spark: SparkSession, sf: str) -> DataFrame:
    return families(spark, sf).select("rowkey", "family1.*", "family2.*", "family3.*")


@query("app_csv", WORDS_SQL.format(source="conversations"))
def app_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "csv")
    counts = word_count(table(spark, sf, "conversations"), "text")
    counts.write.option("sep", " ").csv(path)
    return spark.read.schema("word string, n bigint").option("sep", " ").csv(path)
