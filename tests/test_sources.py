"""Kafka-shaped frames, nested rows, JDBC, catalog jobs, user code."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidelog import session
from tidelog.functions import clock
from tidelog.functions.user import map_with_setup, register_splitter
from tidelog.schemas import INT, STRING, schema
from tidelog.sources import jdbc, kafka, nested
from tidelog.tables import catalog

RECORD = "key string, value string, partition int, offset long, timestamp timestamp"


def test_kafka(spark):
    at = "2024-01-01 00:00:0"
    df = spark.createDataFrame(
        [("1", "1,2,buy", 0, 0, at + "1"), ("1", None, 0, 1, at + "2"),
         ("2", "2,3,x", 0, 2, at + "3"), ("2", "2,4,y", 0, 3, at + "3"),
         ("3", "bad", 1, 0, at + "4")],
        RECORD.replace("timestamp timestamp", "timestamp string"),
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert rows(kafka.upsert_state(df), "key", "value") == [("2", "2,4,y"), ("3", "bad")]
    shape = "user_id bigint, item_id bigint, behavior string"
    got = kafka.decode_csv(df.where("value is not null"), shape)
    assert got.columns == ["user_id", "item_id", "behavior", "ts"]
    assert (1, 2, "buy") in rows(got.drop("ts")) and (None, None, None) in rows(got.drop("ts"))


def test_nested(spark):
    df = spark.createDataFrame([(1, 10, "a", 2.5)], "k int, x int, y string, z double")
    wide = nested.build_families(df, "k", {"f1": {"q1": "x"}, "f2": {"q2": "y", "q3": "z"}})
    assert wide.schema.simpleString() == (
        "struct<rowkey:int,f1:struct<q1:int>,f2:struct<q2:string,q3:double>>")
    assert rows(nested.scan_families(wide, ["f1", "f2.q3"])) == [(1, (10,), 2.5)]


@pytest.fixture
def db(spark):
    return jdbc.connection(spark, "tests")


def test_jdbc_upsert_and_partitioned_read(spark, db):
    shape = "id int, name string, op string"
    empty = spark.createDataFrame([], shape).drop("op")
    jdbc.write_table(empty, db, "students")
    first = spark.createDataFrame([(1, "a", "c"), (2, "b", "c"), (3, "c", "r")], shape)
    second = spark.createDataFrame([(2, "B", "u"), (3, None, "d"), (4, "d", "c")], shape)
    for batch in (first, second, second):
        jdbc.upsert_batch(db, "students", ["id"])(batch, 0)
    back = jdbc.read_table(spark, db, "students", "id", 1, 5, 3)
    assert rows(back) == [(1, "a"), (2, "B"), (4, "d")]
    assert back._jdf.rdd().getNumPartitions() == 3


def test_failed_statement_changes_nothing(spark, db):
    jdbc.write_table(spark.createDataFrame([(1,)], "id int"), db, "one")
    with pytest.raises(Exception):
        jdbc.execute(spark, db, ['delete from one', 'delete from nothing_there'])
    assert rows(jdbc.read_table(spark, db, "one")) == [(1,)]


def test_merge_text():
    assert jdbc.merge_text("t", "s", ["id", "v"], ["id"], "merge") == (
        'merge into t t using s s on t."id" = s."id" when matched then update set "v" = s."v" '
        'when not matched then insert ("id", "v") values (s."id", s."v")')
    assert jdbc.merge_text("t", "s", ["id", "v"], ["id"], "mysql") == (
        "insert into t (`id`, `v`) select `id`, `v` from s s "
        "on duplicate key update `v` = s.`v`")


class Session:
    """As much of a session as the set-up asks, without a checkpoint folder or database."""

    def __init__(self, master):
        self.master, self.applicationId, self.dir = master, f"app-{master}", None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_cluster_needs_a_shared_database_and_folder(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    for needs in (session.shared_dir, lambda s: jdbc.connection(s, "x")):
        with pytest.raises(RuntimeError):
            needs(Session("spark://host:7077"))
    one = Session("local[2]")
    assert session.shared_dir(one) == session.shared_dir(one) == one.dir


def test_executors_in_processes_of_their_own_need_a_shared_database():
    with pytest.raises(RuntimeError, match=jdbc.URL_CONF):
        jdbc.connection(Session("local-cluster[2,2,1500]"), "x")
    for master in ("local", "local[2]", "local[*]"):
        assert jdbc.connection(Session(master), "x")["url"].startswith("jdbc:derby:memory:x")


def test_catalog(spark):
    db = catalog.new_database(spark, "tests")
    df = spark.createDataFrame([(1, "a", "09"), (2, "b", "10")], "id int, name string, hh string")
    catalog.create_as(spark, f"{db}.t", df, ["hh"])
    catalog.rebuild_like(spark, f"{db}.u", f"{db}.t", {"etl_time": "TIMESTAMP"})
    assert spark.table(f"{db}.u").columns == ["id", "name", "etl_time", "hh"]
    catalog.insert_partitions(spark, f"{db}.t", df.limit(1), {"hh": "11"})
    catalog.insert_partitions(spark, f"{db}.t", df.where("id = 2"), {"hh": None})
    assert rows(spark.table(f"{db}.t")) == [
        (1, "a", "09"), (1, "a", "11"), (2, "b", "10"), (2, "b", "10")]
    catalog.overwrite_with_load_time(spark, f"{db}.t", f"{db}.u", "2024-01-01 00:00:00")
    catalog.overwrite_with_load_time(spark, f"{db}.u", f"{db}.u", "2024-01-02 00:00:00")
    out = spark.table(f"{db}.u")
    assert out.count() == 4
    assert rows(out.select(F.col("etl_time").cast("string")).distinct()) == [
        ("2024-01-02 00:00:00",)]
    assert rows(catalog.probe_schema(df)) == [
        (1, "id", "int"), (2, "name", "string"), (3, "hh", "string")]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_files_registered_as_a_table_keep_partition_text(spark, tmp_path):
    shape = schema(id=INT, name=STRING, hh=STRING)
    df = spark.createDataFrame([(1, "a", "09"), (2, "b", "000")], shape)
    df.write.partitionBy("hh").parquet(str(tmp_path / "f"))
    db = catalog.new_database(spark, "files")
    catalog.register_files(spark, f"{db}.t", str(tmp_path / "f"), shape, ["hh"])
    assert rows(spark.table(f"{db}.t")) == [(1, "a", "09"), (2, "b", "000")]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_clock(spark):
    df = spark.createDataFrame(
        [("2024-01-05 10:00:00",), ("2024-01-06",), ("never",), (None,)], "t string"
    )
    got = rows(df.where(clock.is_today(F.col("t"), "2024-01-05 23:00:00")))
    assert got == [("2024-01-05 10:00:00",)]
    ms = df.limit(1).select(
        clock.timestamp_to_millis(F.col("t")).alias("ms")
    ).select(clock.millis_to_timestamp(F.col("ms")).cast("string"))
    assert rows(ms) == [("2024-01-05 10:00:00",)]


def test_user_code(spark):
    register_splitter(spark, "test_split", lambda text: text.split("-"))
    got = spark.sql("SELECT word FROM VALUES ('a-b'), (NULL) AS t(x), LATERAL test_split(x)")
    assert rows(got) == [("a",), ("b",)]
    out = map_with_setup(
        spark.range(10, numPartitions=2), lambda: 5,
        lambda tool, batch: batch.assign(plus=batch["id"] + tool), "id long, plus long",
    )
    assert rows(out)[0] == (0, 5) and out.count() == 10
