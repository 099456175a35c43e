"""Inputs of the registered queries: the driver tables and the change feed made of `events`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.functions.images import json_text
from tidelog.schemas import DOUBLE, LONG, STRING, TIMESTAMP, TableSpec, schema
from tidelog.session import scratch
from tidelog.sources.feed import decode, read_feed
from tidelog.streaming.apply import finish, run_batches
from tidelog.tables import commits
from tidelog.tables.keyed import KeyedTable

# Columns of the captured tables.
IMAGE = schema(id=LONG, value=DOUBLE, data=STRING, props=STRING, ts=TIMESTAMP)
schemas.register("app", "events_a", IMAGE, ("id",))
schemas.register("app", "events_b", IMAGE, ("id",))

FEED_ORDER = ("ts", "pos")

# The feed in SQL, for the oracles.
FEED_SQL = """
feed as (
  select event_id as pos, user_id as id,
         case when event_id % 3 = 0 then null else value end as value,
         event_type as data, props, ts, substr(cast(ts as varchar), 1, 10) as dt,
         case event_type when 'view' then 'r' when 'signup' then 'c'
                         when 'error' then 'd' else 'u' end as op
  from events)"""

ENV_SQL = FEED_SQL + """,
env0 as (
  select pos as event, id, value, data, props, ts, dt, op,
         case when id % 10 = 0 then 'audit' else 'app' end as db,
         case when id % 2 = 0 then 'events_a' else 'events_b' end as tb,
         case when op = 'r' then ''
              else 'mysql-bin.' || lpad(cast(pos // 1000 + 1 as varchar), 9, '0') end as file,
         case when op = 'r' then 0 else pos % 1000 * 100 + 4 end as pos,
         cast(pos % 1000 as integer) as row_no, epoch_us(ts) // 1000 as ts_ms,
         cast(to_json({'id': id}) as varchar) as primary_key_data,
         cast(to_json({'id': id, 'value': value, 'data': data, 'props': props,
                       'ts': cast(ts as varchar)}) as varchar) as image
  from feed),
env as (
  select *,
         case when op in ('u', 'd') then image else '{}' end as before,
         case when op = 'd' then '{}' else image end as after,
         sha256(concat_ws(chr(1), db, tb, file, cast(pos as varchar), cast(row_no as varchar),
                          primary_key_data, op, cast(ts_ms as varchar),
                          case when op in ('u', 'd') then image else '{}' end,
                          case when op = 'd' then '{}' else image end)) as event_id
  from env0)"""


def feed_sql(body: str) -> str:
    return f"with {FEED_SQL}\n{body}"


def env_sql(body: str) -> str:
    return f"with {ENV_SQL}\n{body}"


def state_sql(columns: str, where: str = "true", source: str = "feed") -> str:
    """Latest row per id, deletes removed."""
    order = "ts desc, pos desc" if source == "feed" else "ts_ms desc, file desc, pos desc, row_no desc"
    make = feed_sql if source == "feed" else env_sql
    return make(f""", ranked as (
  select *, row_number() over (partition by id order by {order}) as rn
  from {source} where {where})
select {columns} from ranked where rn = 1 and op <> 'd'""")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as changes of the row of their user."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("pos"),
        F.col("user_id").alias("id"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
        kind.alias("data"),
        "props",
        "ts",
        F.col("ts").cast("date").cast("string").alias("dt"),
        F.when(kind == "view", "r").when(kind == "signup", "c").when(kind == "error", "d")
        .otherwise("u").alias("op"),
    )


def envelopes(df: DataFrame, before_value: Column | None = None) -> DataFrame:
    """Feed rows as envelope JSON, one per line."""
    snapshot = F.col("op") == "r"
    number = F.lpad((F.floor(F.col("pos") / 1000) + 1).cast("string"), 9, "0")
    db = F.when(F.col("id") % 10 == 0, "audit").otherwise("app")
    tb = F.when(F.col("id") % 2 == 0, "events_a").otherwise("events_b")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))

    def image(value: Column) -> Column:
        return F.struct(
            "id", value.alias("value"), "data", "props", F.col("ts").cast("string").alias("ts")
        )

    none = F.lit(None).cast("string")
    source = F.struct(
        F.lit("1.5.4").alias("version"), F.lit("mysql").alias("connector"),
        F.lit("srv").alias("name"), ms.alias("ts_ms"),
        F.when(snapshot, "true").otherwise("false").alias("snapshot"), db.alias("db"),
        none.alias("sequence"), tb.alias("table"), F.lit(1).cast("long").alias("server_id"),
        none.alias("gtid"),
        F.when(snapshot, "").otherwise(F.concat(F.lit("mysql-bin."), number)).alias("file"),
        F.when(snapshot, F.lit(0)).otherwise(F.col("pos") % 1000 * 100 + 4).alias("pos"),
        (F.col("pos") % 1000).cast("int").alias("row"), none.cast("long").alias("thread"),
        none.alias("query"),
    )
    before = F.col("value") if before_value is None else before_value
    return df.select(
        json_text(
            F.concat(F.lit("srv."), db, F.lit("."), tb).alias("topic"),
            F.struct("id").alias("key"),
            F.when(F.col("op").isin("u", "d"), image(before)).alias("before"),
            F.when(F.col("op") != "d", image(F.col("value"))).alias("after"),
            source.alias("source"),
            "op",
            ms.alias("ts_ms"),
            none.alias("transaction"),
        ).alias("value")
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """The landed feed."""
    return read_feed(spark, landed(spark, sf))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """The feed as flat log rows."""
    return decode(lines(spark, sf))


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Times as the driver tables have them, without a zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# -- streams -------------------------------------------------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf: str, label: str) -> tuple[str, bool]:
    """A folder for an input several queries share, and whether it is still to be written."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key in _written and commits.exists(spark, _written[key]):
        return _written[key], False
    return scratch(spark, label), True


def written(spark: SparkSession, sf: str, label: str, path: str) -> None:
    _written[(spark.sparkContext.applicationId, sf, label)] = path


def landing_files(spark: SparkSession) -> int:
    return max(8, spark.sparkContext.defaultParallelism)


# A landed file is compressed and read by one task, so it holds no more lines than this.
LANDED_LINES = 50_000


def per_trigger(spark: SparkSession, path: str, batches: int = 3) -> int:
    """Files per micro-batch, so that what is landed takes a few batches at any size."""
    return max(1, -(-len(commits.names(spark, path)) // batches))


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt over the files of a landing by a hash, so that the order of files says nothing
    about the order of events. Dealt in turns instead, a task would sort all its rows first."""
    return df.repartition(landing_files(df.sparkSession), *by)


def land_text(df: DataFrame, path: str) -> str:
    """Write lines as files, in as many tasks as there are partitions. Rows are dealt before they
    are made texts, which are several times their size."""
    df.write.option("compression", "gzip").option("maxRecordsPerFile", LANDED_LINES).text(path)
    return path


def land_feed(events: DataFrame, path: str, before_value: Column | None = None) -> str:
    """Write feed rows as files of envelopes."""
    return land_text(envelopes(dealt(events, "pos"), before_value), path)


def landed(spark: SparkSession, sf: str) -> str:
    """Folder of the feed's JSON files, written once per session."""
    path, todo = once(spark, sf, "landed")
    if todo:
        land_feed(feed(spark, sf), path)
        written(spark, sf, "landed", path)
    return path


def feed_stream(spark: SparkSession, sf: str, batches: int = 3) -> DataFrame:
    """The landed feed as a stream of flat log rows, out of order."""
    path = landed(spark, sf)
    return decode(
        read_feed(spark, path, streaming=True, files_per_trigger=per_trigger(spark, path, batches))
    )


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream to its end and read back what it emitted."""
    spark = stream.sparkSession
    root = scratch(spark, label)
    out = f"{root}/out"

    def each(batch: DataFrame, batch_id: int) -> None:
        commits.write(batch, out, commits.commit_id(batch_id))

    finish(run_batches(stream, each, f"{root}/checkpoint"))
    return commits.read(spark, out, commits.complete(spark, out), stream.schema).drop(
        "commit_time"
    )


# -- tables --------------------------------------------------------------------------------

FEED_TABLE = schema(id=LONG, value=DOUBLE, data=STRING, props=STRING, ts=TIMESTAMP, dt=STRING,
                    pos=LONG)


def feed_table(spark: SparkSession, label: str, kind: str = "mor", **spec) -> KeyedTable:
    """An empty table for feed rows, keyed by id."""
    return KeyedTable.create(
        spark, scratch(spark, label), FEED_TABLE,
        TableSpec(("id",), FEED_ORDER, kind=kind, **spec),
    )


def history(spark: SparkSession, sf: str) -> KeyedTable:
    """The feed as a table with one commit per day, written once per session."""
    path, todo = once(spark, sf, "history")
    if not todo:
        return KeyedTable.open(spark, path)
    t = KeyedTable.create(spark, path, FEED_TABLE, TableSpec(("id",), FEED_ORDER))
    t.load_history(feed(spark, sf), "dt")
    written(spark, sf, "history", path)
    return t
