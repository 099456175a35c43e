"""Reads of keyed tables. The table is the feed with one commit per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.plans.inputs import (
    FEED_ORDER, feed, feed_sql, feed_table, history, ntz, state_sql,
)
from tidelog.plans.registry import query
from tidelog.schemas import DOUBLE, LONG, STRING, TIMESTAMP, TableSpec, schema
from tidelog.session import scratch
from tidelog.streaming.apply import finish, follow_changes
from tidelog.tables.keyed import KeyedTable

COLUMNS = ("id", "value", "data", "props", "ts", "dt", "pos")
COLUMNS_SQL = ", ".join(COLUMNS)


@query("tbl_snapshot", state_sql(f"{COLUMNS_SQL}, dt as commit_time"))
def tbl_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(history(spark, sf).snapshot(), "ts")


@query("tbl_as_of", state_sql(f"{COLUMNS_SQL}, dt as commit_time", "dt <= '2024-01-10'"))
def tbl_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(history(spark, sf).as_of("2024-01-10"), "ts")


@query("tbl_incremental", state_sql(
    f"{COLUMNS_SQL}, dt as commit_time", "dt > '2024-01-05' and dt <= '2024-01-07'"))
def tbl_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(history(spark, sf).incremental("2024-01-05", "2024-01-07"), "ts")


@query("tbl_commit_filter", "select * from (" + state_sql("id, data, dt as commit_time")
       + ") where commit_time >= '2024-01-25'")
def tbl_commit_filter(spark: SparkSession, sf: str) -> DataFrame:
    current = history(spark, sf).snapshot()
    return current.where("commit_time >= '2024-01-25'").select("id", "data", "commit_time")


@query("tbl_commits", feed_sql("""select dt as commit_time, 'log' as kind from feed
group by dt order by dt desc limit 2"""))
def tbl_commits(spark: SparkSession, sf: str) -> DataFrame:
    return history(spark, sf).commits().limit(2)


def followed(spark: SparkSession, sf: str, label: str, from_commit: str = "") -> DataFrame:
    """All changes a stream reads from a table, in two runs, while a commit is half written."""
    t, root = history(spark, sf), scratch(spark, label)
    half = t.versions().drop("commit_time").write.mode("overwrite")
    half = half.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    half.parquet(f"{t.log}/commit_time=2024-01-15x")

    def each(batch: DataFrame, batch_id: int) -> None:
        found = batch.withColumnRenamed("commit_time", "written").select("id", "pos", "op", "written")
        found.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for _ in range(2):  # the second run goes on behind the first: nothing comes again
        finish(follow_changes(t, each, f"{root}/checkpoint", from_commit, commits_per_trigger=10))
    return spark.read.parquet(f"{root}/out").select("id", "pos", "op", F.col("written").alias("commit_time"))


@query("tbl_stream_read", feed_sql("select id, pos, op, dt as commit_time from feed"))
def tbl_stream_read(spark: SparkSession, sf: str) -> DataFrame:
    return followed(spark, sf, "stream-read")


@query("tbl_stream_from_commit", feed_sql(
    "select id, pos, op, dt as commit_time from feed where dt >= '2024-01-20'"))
def tbl_stream_from_commit(spark: SparkSession, sf: str) -> DataFrame:
    return followed(spark, sf, "stream-from", "2024-01-20")


@query("app_reused_commit", feed_sql(""", ranked as (
  select *, row_number() over (partition by id order by ts desc, pos desc) as rn from feed)
select id, pos, true as refused from ranked where rn = 1 and op <> 'd'"""))
def app_reused_commit(spark: SparkSession, sf: str) -> DataFrame:
    """Every write under an id that was used is refused, and nothing of the table changes."""
    t, events, refused = feed_table(spark, "reused"), feed(spark, sf), True
    t.upsert(events, "c1")
    for write in (t.insert, t.upsert, t.delete_keys, t.patch):
        try:
            write(events, "c1")
            refused = False
        except ValueError:
            pass
    return t.snapshot().select("id", "pos", F.lit(refused).alias("refused"))


@query("app_compact", state_sql(COLUMNS_SQL))
def app_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Days arrive newest part first; the older ones must not win over the folded base, nor
    bring back keys it knows as deleted."""
    t = feed_table(spark, "compacted")
    events = feed(spark, sf)
    t.upsert(events.where("dt > '2024-01-20'"), "c1")
    t.compact()
    t.upsert(events.where("dt > '2024-01-10' and dt <= '2024-01-20'"), "c2")
    t.compact()
    t.upsert(events.where("dt <= '2024-01-10'"), "c3")
    return ntz(t.snapshot().select(*COLUMNS), "ts")


@query("app_hive_partitions", state_sql("id, substr(cast(ts as varchar), 12, 2) as hh, data"))
def app_hive_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Directories like `hh=09`, whose values stay text."""
    columns = schema(id=LONG, value=DOUBLE, data=STRING, ts=TIMESTAMP, pos=LONG, hh=STRING)
    t = KeyedTable.create(
        spark, scratch(spark, "hive"), columns,
        TableSpec(("id",), FEED_ORDER, partition_by=("hh",)),
    )
    hour = F.substring(F.col("ts").cast("string"), 12, 2)
    t.upsert(feed(spark, sf).withColumn("hh", hour), "c1")
    return t.snapshot().select("id", "hh", "data")
