"""Images of large commits: the log is ranked before it is shuffled, with the same result."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidelog.schemas import LONG, TableSpec, schema
from tidelog.tables import keyed
from tidelog.tables.keyed import KeyedTable


def table(spark, path):
    t = KeyedTable.create(spark, path, schema(id=LONG, at=LONG, v=LONG), TableSpec(("id",), ("at",)))
    events = spark.range(600).select(
        F.col("id").alias("n"), F.pmod(F.col("id") * 7, F.lit(40)).alias("id"),
        F.pmod(F.col("id") * 13, F.lit(97)).alias("at"), F.col("id").alias("v"),
        F.when(F.col("id") % 11 == 0, "d").otherwise("u").alias("op"))
    for n in range(3):
        t.upsert(events.where(f"n % 3 = {n} and id % 10 <> {n}"), f"00{n}")
    t.delete_keys(events.where("id % 8 = 0"), "003")
    t.upsert(events.where("n % 5 = 0").withColumn("at", F.col("at") + 90), "004")
    return t


SPANS = [("", "000"), ("000", "001"), ("001", "004"), ("002", "003")]


@pytest.mark.parametrize("span", SPANS)
def test_both_ways_tell_the_same(spark, tmp_path, monkeypatch, span):
    t = table(spark, str(tmp_path / "t"))
    monkeypatch.setattr(keyed, "FEW_BYTES", 1 << 30)
    few = rows(t.images(*span))
    monkeypatch.setattr(keyed, "FEW_BYTES", 0)
    assert rows(t.images(*span)) == few and few


def test_log_of_large_commits_is_ranked_before_its_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "FEW_BYTES", 0, raising=False)
    t = table(spark, str(tmp_path / "t"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.images("000", "002")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    scans = [n for n, line in enumerate(plan) if "FileScan" in line and ",v#" in line]
    assert scans
    for n in scans:
        above = next(m for m in range(n, -1, -1) if "Exchange" in plan[m])
        assert any("WindowGroupLimit" in line for line in plan[above:n])
