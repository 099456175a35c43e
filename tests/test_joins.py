"""The changelog join step by step, and joins under skew."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidelog.operators.joins import ChangelogLeftJoin, left_join_cast
from tidelog.schemas import INT, LONG, STRING, TableSpec, schema

FACT = schema(id=INT, data3=STRING, seq=LONG)
STUDENT = schema(id=INT, name=STRING, seq=LONG)


@pytest.fixture
def join(spark, tmp_path):
    spec = TableSpec(("id",), ("seq",))
    return ChangelogLeftJoin(
        spark, str(tmp_path), (FACT, spec), (STUDENT, spec), "data3", ["name"]
    )


def apply(spark, join, commit, facts=(), students=()):
    join.apply(
        spark.createDataFrame(list(facts), "id int, data3 string, seq long, op string"),
        spark.createDataFrame(list(students), "id int, name string, seq long, op string"),
        commit,
    )
    return rows(join.current(), "id", "data3", "name")


def test_late_and_changing_rows_revise_the_result(spark, join):
    assert apply(spark, join, "c1", [(1, "7", 1, "c")]) == [(1, "7", None)]
    assert apply(spark, join, "c2", [], [(7, "g", 2, "c")]) == [(1, "7", "g")]
    assert apply(spark, join, "c3", [], [(7, "h", 3, "u")]) == [(1, "7", "h")]
    # An older version of the student comes late.
    assert apply(spark, join, "c4", [], [(7, "old", 1, "u")]) == [(1, "7", "h")]
    assert apply(spark, join, "c5", [], [(7, None, 5, "d"), (2, "x", 5, "r")]) == [
        (1, "7", None)]
    assert apply(spark, join, "c6", [(1, "2", 6, "u"), (5, None, 6, "c")]) == [
        (1, "2", "x"), (5, None, None)]
    assert apply(spark, join, "c7", [], [(7, "back", 7, "c")]) == [
        (1, "2", "x"), (5, None, None)]
    assert apply(spark, join, "c8", [(1, None, 8, "d")], [(2, "y", 8, "u")]) == [
        (5, None, None)]


def test_batch_run_again_changes_nothing(spark, join):
    args = ([(1, "7", 1, "c"), (2, "7", 1, "c")], [(7, "g", 2, "c")])
    first = apply(spark, join, "c1", *args)
    assert apply(spark, join, "c1", *args) == first == [(1, "7", "g"), (2, "7", "g")]


def test_many_batches_equal_the_full_join(spark, join):
    events = [(i, (i * 7) % 30, (i * 11) % 12, (i * 37) % 100, "d" if i % 9 == 0 else "u")
              for i in range(120)]
    facts = [(k, str(f), s, op) for i, k, f, s, op in events if i % 3]
    dims = [(f, f"n{i}", s, op) for i, k, f, s, op in events if not i % 3]
    for b in range(4):
        got = apply(spark, join, f"c{b}", facts[b::4], dims[b::4])
        if b == 1:
            join.compact()

    def state(data):
        last = {}
        for e in sorted(data, key=lambda e: e[2]):
            last[e[0]] = e
        return {k: e[1] for k, e in last.items() if e[3] != "d"}

    left, right = state(facts), state(dims)
    assert got == sorted(((k, f, right.get(int(f))) for k, f in left.items()), key=repr)


def test_hot_foreign_key_is_split(spark):
    """A third of the left rows share one key: the adaptive join spreads them over tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "40",
    }
    saved = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 == 0, "0").otherwise(
                (F.col("id") % 1000).cast("string")).alias("fk")
        )
        right = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        out = left_join_cast(left, right, "fk", "k")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert out.count() == 60000
        assert out.where("w is null").count() == left.where("cast(fk as int) >= 900").count()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
