"""Measures the keyed tables: how reads and writes depend on commits and change size.

Uses the tables in BENCH_SF_DIR and prints one line per figure.
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidelog import session  # noqa: E402
from tidelog.operators.changes import current_state  # noqa: E402
from tidelog.plans import inputs  # noqa: E402
from tidelog.schemas import TableSpec  # noqa: E402
from tidelog.sources.feed import typed_changes  # noqa: E402
from tidelog.streaming.apply import finish, stream_upsert, target_schema  # noqa: E402
from tidelog.tables.keyed import KeyedTable  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(label: str, work, rows: int | None = None) -> None:
    work()
    start = time.perf_counter()
    work()
    took = time.perf_counter() - start
    rate = f", {rows / took:,.0f} rows/s" if rows else ""
    print(f"{label}: {took:.2f} s{rate}", flush=True)


def main() -> None:
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session.build("tidelog-measure", cores, **{"spark.sql.shuffle.partitions": cores})
    spark.sparkContext.setLogLevel("ERROR")
    feed = inputs.feed(spark, SF)
    n = feed.count()
    timed("batch feed to current state",
          lambda: run(current_state(feed, ["id"], inputs.FEED_ORDER)), n)
    timed("decode of landed events", lambda: run(inputs.log(spark, SF)), n)

    orders = inputs.table(spark, SF, "orders")
    total = orders.count()
    spec = TableSpec(("o_orderkey",), ("o_orderdate",))
    for commits in (1, 10, 50):
        t = KeyedTable.create(spark, session.scratch(spark, "m"), orders.schema, spec)
        part = F.lpad(F.pmod(F.xxhash64("o_orderkey"), F.lit(commits)).cast("string"), 3, "0")
        t.load_history(orders.withColumn("c", part), "c")
        timed(f"snapshot, {commits} commits", lambda: run(t.snapshot()), total)
        timed("  last commit, incremental",
              lambda: run(t.incremental(f"{commits - 2:03d}" if commits > 1 else "")))
        t.compact()
        timed("  snapshot, compacted", lambda: run(t.snapshot()), total)
        few = orders.where("o_orderkey % 100 = 7")
        t.upsert(few, "x1")
        timed("  snapshot, compacted, 1 % changed since", lambda: run(t.snapshot()), total)

    for kind in ("mor", "cow"):
        t = KeyedTable.create(
            spark, session.scratch(spark, kind), orders.schema,
            TableSpec(("o_orderkey",), (), kind=kind, buckets=16),
        )
        timed(f"{kind} insert of all", lambda: t.insert(orders), total)
        for pct in (1, 10):
            some = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(100)) < pct)
            timed(f"{kind} upsert of {pct} %", lambda: t.upsert(some))

    def stream() -> None:
        root = session.scratch(spark, "stream")
        t = KeyedTable.create(
            spark, f"{root}/t", target_schema(inputs.IMAGE),
            TableSpec(("id",), ("ts_ms", "file", "pos")),
        )
        changes = typed_changes(inputs.feed_stream(spark, SF), inputs.IMAGE)
        finish(stream_upsert(changes, t, f"{root}/checkpoint"))
        run(t.snapshot())

    timed("stream apply in 3 batches, end to end", stream, n)
    spark.stop()


if __name__ == "__main__":
    main()
