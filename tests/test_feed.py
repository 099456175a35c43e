"""Decoding envelopes: the awkward events."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidelog import schemas
from tidelog.functions import sql_text
from tidelog.functions.images import field_state, typed_image
from tidelog.sources import feed

STUDENT = schemas.lookup("test", "student")[0]


def event(op, ts_ms, image=None, before=None, file="mysql-bin.000190", pos=358, row=0,
          tb="student", db="test", **more):
    source = {"version": "1", "connector": "mysql", "name": "srv", "ts_ms": ts_ms, "db": db,
              "table": tb, "server_id": 1, "file": file, "pos": pos, "row": row}
    return json.dumps({"before": before, "after": image, "source": source, "op": op,
                       "ts_ms": ts_ms, "transaction": None, **more})


def lines(spark, *events):
    return spark.createDataFrame([(e,) for e in events], "value string")


def student(id, name, **more):
    return {"id": id, "name": name, "sex": None, "birthday": None,
            "create_time": "2022-03-07T16:47:13Z", **more}


def test_decode_keeps_nulls_and_big_numbers(spark):
    image = {"birthday": None, "name": "it's", "id": 9223372036854775806}
    df = feed.decode(lines(spark, event("c", 1, image, key={"id": 9223372036854775806})))
    r = df.first()
    assert df.schema.names == schemas.LOG.names
    assert json.loads(r["after"]) == image and r["before"] == "{}"
    assert r["primary_key_data"] == '{"id":9223372036854775806}'
    assert (r["db"], r["tb"], r["server_id"], r["file"], r["pos"]) == (
        "test", "student", "1", "mysql-bin.000190", 358)


def test_key_is_taken_from_the_image_when_the_event_has_none(spark):
    df = feed.decode(lines(
        spark, event("c", 1, student(1, "a")), event("d", 2, None, student(2, "b"))
    ))
    assert rows(df, "primary_key_data") == [('{"id":"1"}',), ('{"id":"2"}',)]


def test_topic_names_the_table(spark):
    text = json.dumps({"topic": "srv.shop.cart", "key": {"id": 1}, "after": {"id": 1}, "op": "c",
                       "ts_ms": 1})
    assert rows(feed.decode(lines(spark, text)), "db", "tb") == [("shop", "cart")]


def test_event_id_is_the_same_for_a_redelivered_event(spark):
    one, other = event("u", 5, student(1, "a")), event("u", 5, student(1, "a"), row=1)
    ids = [r["id"] for r in feed.decode(lines(spark, one, other, one)).collect()]
    assert ids[0] == ids[2] != ids[1] and len(ids[0]) == 64


def test_malformed_line_is_an_unknown_op(spark):
    from tidelog.operators.changes import unknown_ops

    df = feed.decode(lines(spark, "{not json", event("t", 1), event("c", 2, student(1, "a"))))
    assert unknown_ops(df).count() == 2


def test_stock_rows(spark):
    r = feed.parse_stock(lines(spark, event("r", 7, student(1, "小明"), file="", pos=0))).first()
    assert (r["id"], r["before"], r["transaction"], r["tb"]) == (7, "null", "null", "student")
    assert json.loads(r["source"])["file"] == ""


def test_typed_image(spark):
    image = json.dumps(student(1, "小明", create_time="2021-05-13T14:30:45Z"))
    bad = json.dumps(student("x", "b", create_time="yesterday"))
    df = spark.createDataFrame([(image,), (bad,), ("{}",), ("null",)], "after string")
    got = df.select(*typed_image(F.col("after"), STUDENT)).select(
        "id", "name", F.col("create_time").cast("string")
    )
    assert [tuple(r) for r in got.collect()] == [
        (1, "小明", "2021-05-13 14:30:45"), (None, "b", None),
        (None, None, None), (None, None, None),
    ]


def test_field_state(spark):
    df = spark.createDataFrame([('{"a":null,"b":1}',), ("null",)], "i string")
    got = df.select(*[field_state(F.col("i"), c) for c in "abc"]).collect()
    assert [tuple(r) for r in got] == [("null", "value", "absent"), ("absent",) * 3]


def test_changelog_table_orders_events_of_one_millisecond(spark):
    df = feed.decode(lines(
        spark,
        event("u", 5, student(1, "late"), file="mysql-bin.000191", pos=4),
        event("u", 5, student(1, "mid"), file="mysql-bin.000190", pos=900),
        event("r", 5, student(1, "snap"), file="", pos=0),
        event("c", 1, student(2, "b")),
        event("d", 9, None, student(2, "b")),
        event("u", 3, student(2, "older")),
        event("d", 9, {}, {}, key={"id": 3}),
        event("c", 8, student(3, "c"), key={"id": 3}),
    ))
    assert rows(feed.changelog_table(df, STUDENT, ["id"]), "id", "name") == [(1, "late")]


def test_start_positions(spark):
    log = feed.decode(lines(
        spark,
        event("r", 10, student(1, "a"), file="", pos=0),
        event("u", 20, student(1, "b"), file="bin.1", pos=100),
        event("u", 20, student(1, "c"), file="bin.1", pos=200),
        event("u", 30, student(1, "d"), file="bin.2", pos=50),
    ))

    def at(mode, **kw):
        return [(r["ts_ms"], r["pos"])
                for r in feed.start_from(log, mode, **kw).orderBy("ts_ms", "pos").collect()]

    assert len(at("initial")) == 4
    assert at("earliest") == [(20, 100), (20, 200), (30, 50)]
    assert at("offset", file="bin.1", pos=200) == [(20, 200), (30, 50)]
    assert at("timestamp", ts_ms=20) == [(20, 100), (20, 200), (30, 50)]
    there = feed.end_position(log.where("pos <= 100 and ts_ms < 30"))
    assert at("latest", after=there) == [(20, 200), (30, 50)]
    with pytest.raises(ValueError):
        feed.start_from(log, "middle")


def test_table_filter_matches_whole_names(spark):
    log = spark.createDataFrame(
        [("db1", "a"), ("db2", "a"), ("xdb1", "a"), ("db1", "ab")], "db string, tb string"
    )
    assert rows(feed.table_filter(log, [r"db.*\.a"])) == [("db1", "a"), ("db2", "a")]


def test_sql_text(spark):
    shape = schemas.schema(id=schemas.INT, name=schemas.STRING, sex=schemas.STRING,
                           create_time=schemas.TIMESTAMP)
    image = json.dumps({"birthday": None, "create_time": "2022-03-07T16:47:13Z", "sex": None,
                        "name": "it's", "id": -1})
    df = spark.createDataFrame([(image, '{"id":-1}')], "after string, key string")
    after, key = F.col("after"), F.col("key")
    got = df.select(
        sql_text.insert_text("t", after, shape),
        sql_text.insert_text_with_nulls("t", after, shape),
        sql_text.update_text("t", after, key, shape, ["id"]),
        sql_text.delete_text("t", key, shape, ["id"]),
    ).first()
    time = "to_timestamp('2022-03-07T16:47:13Z')"
    assert tuple(got) == (
        f"insert into t (id, name, create_time) values (-1, 'it''s', {time})",
        f"insert into t values (-1, 'it''s', null, {time})",
        f"update t set name='it''s', create_time={time} where id=-1",
        "delete from t where id=-1",
    )
