"""Ordered operators against brute force, with a key that holds half of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import ordered


def events(seed, n=300):
    rng = random.Random(seed)
    keys = [0] * 5 + [1, 2, 3, 4, 5]
    return [
        (i, rng.choice(keys), rng.randrange(120), rng.choice([None, *range(9)]))
        for i in range(n)
    ]


def frame(spark, data):
    return spark.createDataFrame(data, "pos long, id long, at long, v long").repartition(5)


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_previous(spark, slices):
    data = events(1)
    got = ordered.previous(frame(spark, data), ["id"], ["at", "pos"], {"v": "prior"}, slices)
    want, held = {}, {}
    for pos, key, at, v in sorted(data, key=lambda r: (r[2], r[0])):
        want[pos] = held.get(key)
        held[key] = v
    assert {r["pos"]: r["prior"] for r in got.collect()} == want


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_asof_left_join(spark, slices):
    facts, versions = events(2), events(3, 60)
    right = frame(spark, versions).select(
        "id", F.col("at").alias("since"), F.col("v").alias("w"), F.col("pos").alias("n")
    )
    got = ordered.asof_left_join(
        frame(spark, facts), right, ["id"], "at", "since", ["w", "n"], ["n"], slices
    )
    want = {}
    for pos, key, at, _ in facts:
        valid = [r for r in versions if r[1] == key and r[2] <= at]
        last = max(valid, key=lambda r: (r[2], r[0]), default=None)
        want[pos] = (last[3], last[0]) if last else (None, None)
    assert {r["pos"]: (r["w"], r["n"]) for r in got.collect()} == want


def test_running_sum_and_position(spark):
    data = events(4)
    order = [F.asc("at"), F.asc("pos")]
    df = frame(spark, data).na.fill(0, ["v"])
    run = {r["pos"]: r["s"] for r in ordered.running_sum(df, order, "v", "s").collect()}
    place = {r["pos"]: r["n"] for r in ordered.with_position(df, order, "n").collect()}
    total = 0
    for i, (pos, _, _, v) in enumerate(sorted(data, key=lambda r: (r[2], r[0]))):
        total += v or 0
        assert (run[pos], place[pos]) == (total, i + 1)


def test_position_in_group(spark):
    data = [(p, None if k == 3 else k, a, v) for p, k, a, v in events(5)]
    got = ordered.position_in_group(
        frame(spark, data), "id", [F.desc("at"), F.asc("pos")], "n"
    )
    seen, want = {}, {}
    for pos, key, at, _ in sorted(data, key=lambda r: (-r[2], r[0])):
        seen[key] = want[pos] = seen.get(key, 0) + 1
    assert {r["pos"]: r["n"] for r in got.collect()} == want


def test_no_rows(spark):
    none = frame(spark, events(6)).where("id > 99")
    assert ordered.with_position(none, [F.asc("at")]).count() == 0
    assert ordered.previous(none, ["id"], ["at"], {"v": "p"}).count() == 0


def test_asof_nulls_and_exact_times(spark):
    facts = [(1, 7, 2**60), (2, None, 2**60), (3, 7, None), (4, 7, 2**60 + 1)]
    versions = [(7, 2**60 + 1, "late"), (7, 5, "early"), (None, 1, "no key"), (7, None, "no time")]
    left = spark.createDataFrame(facts, "pos long, id long, at long")
    right = spark.createDataFrame(versions, "id long, since long, v string")
    got = ordered.asof_left_join(left, right, ["id"], "at", "since", ["v"], slices=3)
    assert {r["pos"]: r["v"] for r in got.collect()} == {1: "early", 2: None, 3: None, 4: "late"}


def test_asof_dates(spark):
    left = spark.sql("select 1 as id, date '2024-01-02' as at")
    right = spark.sql("select 1 as id, date '2024-01-01' as since, 'x' as v")
    got = ordered.asof_left_join(left, right, ["id"], "at", "since", ["v"])
    assert [r["v"] for r in got.collect()] == ["x"]
    with pytest.raises(ValueError, match="order"):
        ordered.asof_left_join(left.withColumn("at", F.lit("a")), right.withColumn("since", F.lit("a")),
                               ["id"], "at", "since", ["v"])
