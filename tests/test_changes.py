"""Folding events: order, deletes, partial updates; randomised against brute force."""

import random

from pyspark.sql import functions as F

from helpers import rows
from tidelog.operators.changes import (
    current_state, known_ops, latest_per_key, partial_state, route, unknown_ops,
)

SHAPE = "id int, ts int, pos int, a int, b string, op string"


def events(seed, n=200):
    rng = random.Random(seed)
    return [
        (rng.choice([0] * 6 + [1, 2, 3, 4]), rng.randrange(50), i,
         rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]), rng.choice("rcuud"))
        for i in range(n)
    ]


def test_current_state(spark):
    for seed in range(3):
        data = events(seed)
        last = {}
        for e in sorted(data, key=lambda e: (e[1], e[2])):
            last[e[0]] = e
        want = sorted((e for e in last.values() if e[5] != "d"), key=repr)
        df = spark.createDataFrame(data, SHAPE).repartition(7)
        assert rows(current_state(df, ["id"], ["ts", "pos"])) == want


def test_partial_state_forgets_at_a_delete(spark):
    for seed in range(3):
        data = events(seed + 10)
        state = {}
        for key, _, _, a, b, op in sorted(data, key=lambda e: (e[1], e[2])):
            if op == "d":
                state.pop(key, None)
                continue
            old = state.get(key, (None, None))
            state[key] = (a if a is not None else old[0], b if b is not None else old[1])
        df = spark.createDataFrame(data, SHAPE).repartition(7)
        got = partial_state(df, ["id"], ["ts", "pos"], ["a", "b"])
        assert {r["id"]: (r["a"], r["b"]) for r in got.collect()} == state


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_routing(spark):
    df = spark.createDataFrame([(o,) for o in ("r", "c", "u", "d", "t", None)], "op string")
    assert rows(known_ops(df)) == [("c",), ("d",), ("r",), ("u",)]
    assert rows(unknown_ops(df)) == [("t",), (None,)]
    got = {r["op"]: r["to"] for r in df.select("op", route().alias("to")).collect()}
    assert got == {"r": "insert", "c": "insert", "u": "update", "d": "delete",
                   "t": "unknown", None: "unknown"}
