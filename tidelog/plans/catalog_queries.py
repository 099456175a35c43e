"""Table definition and catalog jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.plans.inputs import drain, env_sql, feed, feed_stream, ntz, table
from tidelog.plans.registry import query
from tidelog.schemas import DOUBLE, LONG, STRING, TableSpec, schema
from tidelog.session import scratch
from tidelog.tables import catalog
from tidelog.tables.keyed import KeyedTable

CLOCK = "2024-02-01 12:30:00"


def with_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a year and a month, the month as two digits."""
    day = F.col("o_orderdate").cast("string")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"),
        F.col("o_totalprice").alias("price"),
        F.substring(day, 1, 4).alias("dt"), F.substring(day, 6, 2).alias("hh"),
    )


PARTS_SQL = """select o_orderkey as id, o_orderstatus as name, o_totalprice as price,
  substr(cast(o_orderdate as varchar), 1, 4) as dt,
  substr(cast(o_orderdate as varchar), 6, 2) as hh from orders"""
PARTS = schema(id=LONG, name=STRING, price=DOUBLE, dt=STRING, hh=STRING)


def parts_table(spark: SparkSession, label: str) -> str:
    name = f"{catalog.new_database(spark, label)}.parts"
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT, name STRING, price DOUBLE, dt STRING, hh STRING) "
        "USING parquet PARTITIONED BY (dt, hh)"
    )
    return name


@query("app_insert_dynamic_part", PARTS_SQL)
def app_insert_dynamic_part(spark: SparkSession, sf: str) -> DataFrame:
    name = parts_table(spark, "dynamic")
    catalog.insert_partitions(spark, name, with_parts(spark, sf), {"dt": None, "hh": None})
    return spark.table(name)


@query("app_insert_static_part", f"""select id, name, price, '2024' as dt, '09' as hh
from ({PARTS_SQL}) where hh = '09'""")
def app_insert_static_part(spark: SparkSession, sf: str) -> DataFrame:
    """One partition filled in two inserts."""
    name = parts_table(spark, "static")
    september = with_parts(spark, sf).where("hh = '09'")
    for half in (september.where("name = 'O'"), september.where("name <> 'O'")):
        catalog.insert_partitions(spark, name, half, {"dt": "2024", "hh": "09"})
    return spark.table(name)


@query("app_insert_overwrite", f"""select o_orderkey, o_custkey, o_totalprice,
  timestamp '{CLOCK}' as etl_time from orders""")
def app_insert_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded twice: the second load replaces the first, reading the table it writes."""
    db = catalog.new_database(spark, "reload")
    catalog.create_as(
        spark, f"{db}.src",
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
    )
    catalog.rebuild_like(spark, f"{db}.dst", f"{db}.src", {"etl_time": "TIMESTAMP"})
    catalog.overwrite_with_load_time(spark, f"{db}.src", f"{db}.dst", "2024-01-01 00:00:00")
    catalog.overwrite_with_load_time(spark, f"{db}.dst", f"{db}.dst", CLOCK)
    return ntz(spark.table(f"{db}.dst"), "etl_time")


@query("ddl_create_keyed", "select o_orderkey, o_custkey, o_orderstatus from orders")
def ddl_create_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Key, order, partition and kind are kept with the table and found when it is opened."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch(spark, "keyed")
    KeyedTable.create(
        spark, path, orders.schema,
        TableSpec(("o_orderkey",), ("o_custkey",), ("o_orderstatus",)),
    )
    KeyedTable.open(spark, path).insert(orders, "c1")
    return KeyedTable.open(spark, path).snapshot().select(*orders.columns)


@query("ddl_external", f"select dt, hh, count(*) as n from ({PARTS_SQL}) group by dt, hh")
def ddl_external(spark: SparkSession, sf: str) -> DataFrame:
    db = catalog.new_database(spark, "external")
    path = scratch(spark, "files")
    rows = with_parts(spark, sf).hint("rebalance", "dt", "hh")
    rows.write.partitionBy("dt", "hh").parquet(path)
    catalog.register_files(spark, f"{db}.t", path, PARTS, ["dt", "hh"])
    return spark.table(f"{db}.t").groupBy("dt", "hh").agg(F.count("*").alias("n"))


@query("ddl_ctas", """select o_orderpriority, count(*) as n, min(o_orderkey) as first
from orders group by o_orderpriority""")
def ddl_ctas(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{catalog.new_database(spark, 'ctas')}.orders"
    catalog.create_as(
        spark, name, table(spark, sf, "orders").hint("rebalance", "o_orderpriority"),
        ["o_orderpriority"],
    )
    return spark.sql(
        f"SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first FROM {name} "
        "GROUP BY o_orderpriority"
    )


@query("ddl_like", "select * from customer where c_mktsegment = 'BUILDING'")
def ddl_like(spark: SparkSession, sf: str) -> DataFrame:
    """Dropped and made anew: rows of the first table are gone."""
    db = catalog.new_database(spark, "like")
    catalog.create_as(spark, f"{db}.src", table(spark, sf, "customer"))
    for segment in ("MACHINERY", "BUILDING"):
        catalog.rebuild_like(spark, f"{db}.copy", f"{db}.src")
        spark.table(f"{db}.src").where(F.col("c_mktsegment") == segment).write.insertInto(
            f"{db}.copy"
        )
    return spark.table(f"{db}.copy")


@query("ddl_like_add", f"select *, timestamp '{CLOCK}' as etl_time from supplier")
def ddl_like_add(spark: SparkSession, sf: str) -> DataFrame:
    db = catalog.new_database(spark, "added")
    catalog.create_as(spark, f"{db}.src", table(spark, sf, "supplier"))
    catalog.rebuild_like(spark, f"{db}.dst", f"{db}.src", {"etl_time": "TIMESTAMP"})
    catalog.overwrite_with_load_time(spark, f"{db}.src", f"{db}.dst", CLOCK)
    return ntz(spark.table(f"{db}.dst"), "etl_time")


@query("ddl_computed_col", "select c_custkey, c_name || '_sex' as full_name from customer")
def ddl_computed_col(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    full = F.concat("c_name", F.lit("_sex"))
    return catalog.with_computed(customer, {"full_name": full}).select("c_custkey", "full_name")


@query("ddl_subset", "select o_orderkey, o_totalprice from orders")
def ddl_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Fewer columns declared than the files hold: the scan reads only these."""
    return spark.read.schema(schema(o_orderkey=LONG, o_totalprice=DOUBLE)).parquet(
        f"{sf}/orders.parquet"
    )


@query("ddl_schema_probe", """with counted as (
  unpivot (select count(o_orderkey) as o_orderkey, count(o_custkey) as o_custkey,
    count(o_orderstatus) as o_orderstatus, count(o_totalprice) as o_totalprice,
    count(o_orderdate) as o_orderdate, count(o_orderpriority) as o_orderpriority from orders)
  on * into name name value filled),
shape(pos, name, type) as (values (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'),
  (3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'),
  (5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string'))
select pos, name, type, filled from shape join counted using (name)""")
def ddl_schema_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Names and types found without reading; then the names drive a count of filled values."""
    orders = table(spark, sf, "orders")
    probe = catalog.probe_schema(orders)
    counted = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot(
        [], orders.columns, "name", "filled"
    )
    return probe.join(counted, "name").select("pos", "name", "type", "filled")


@query("ddl_temp_view", env_sql("""select 'batch' as side, data as what, count(*) as n from env
group by data union all select 'stream', op, count(*) from env where op <> 'r' group by op"""))
def ddl_temp_view(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over a view of a batch frame and over one of a stream."""
    feed(spark, sf).createOrReplaceTempView("tide_feed")
    batch = spark.sql(
        "SELECT 'batch' AS side, data AS what, count(*) AS n FROM tide_feed GROUP BY data"
    )
    feed_stream(spark, sf).createOrReplaceTempView("tide_stream")
    live = drain(spark.sql("SELECT op FROM tide_stream WHERE op <> 'r'"), "view")
    return batch.unionByName(
        live.groupBy(F.lit("stream").alias("side"), F.col("op").alias("what")).agg(
            F.count("*").alias("n")
        )
    )
