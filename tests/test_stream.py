"""Streams: equal to batch, and unharmed by failures, replays and restarts."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidelog import schemas
from tidelog.operators.words import word_count
from tidelog.schemas import EVENT_ORDER, LONG, STRING, TableSpec
from tidelog.sources import feed
from tidelog.sources.files import stream_lines
from tidelog.streaming import apply, live
from tidelog.tables import commits
from tidelog.tables.keyed import KeyedTable

SHAPE = schemas.schema(id=schemas.INT, name=STRING)
OPS = "rcuud"


def lines(n=60):
    out = []
    for i in range(n):
        op = OPS[i % 5]
        image = {"id": i % 7, "name": f"n{i}"}
        tb = "student" if i % 7 % 2 else "test4"
        out.append(json.dumps({
            "key": {"id": i % 7}, "before": image if op in "ud" else None,
            "after": None if op == "d" else image, "op": op, "ts_ms": 1000 + i // 2,
            "source": {"db": "test", "table": tb, "server_id": 1,
                       "file": "" if op == "r" else "bin.1", "pos": 0 if op == "r" else i,
                       "row": i},
        }))
    return out


@pytest.fixture
def landed(spark, tmp_path):
    """The feed in four files, its events dealt out so that no file is in order."""
    (tmp_path / "in").mkdir()
    for f in range(4):
        (tmp_path / "in" / f"{f}.json").write_text("\n".join(lines()[f::4][::-1]))
    return str(tmp_path / "in")


def table(spark, tmp_path, kind="mor"):
    return KeyedTable.create(
        spark, str(tmp_path / "table"), apply.target_schema(SHAPE),
        TableSpec(("id",), EVENT_ORDER, kind=kind, buckets=3),
    )


def expected(spark, landed):
    log = feed.decode(feed.read_feed(spark, landed))
    return rows(feed.changelog_table(log, SHAPE, ["id"]))


def stream(spark, landed, files=1):
    return feed.decode(feed.read_feed(spark, landed, True, files))


@pytest.mark.parametrize("kind", ["mor", "cow"])
def test_stream_equals_batch(spark, tmp_path, landed, kind):
    t = table(spark, tmp_path, kind)
    changes = feed.typed_changes(stream(spark, landed), SHAPE)
    apply.finish(apply.stream_upsert(changes, t, str(tmp_path / "cp")))
    assert rows(t.snapshot(), "id", "name") == expected(spark, landed)
    ids = [c for c, kind in t.commit_ids() if kind == "log"]
    assert ids == [commits.commit_id(i) for i in range(4)]


def test_events_that_cannot_be_applied_are_kept_beside_the_table(spark, tmp_path):
    shape = schemas.lookup("test", "student")[0]
    rows_in = [("c", 1, 0, "1", "a"), ("t", 2, 0, "1", "cut"), (None, 3, 0, "1", "none"),
               ("u", 4, 0, "x", "no key"), ("u", 5, 1, "1", "second"), ("u", 5, 0, "1", "first")]
    log = spark.createDataFrame([
        (str(i), "1", "bin.1", 4, row, "{}", json.dumps({"id": id, "name": name}), op, ts, "{}", "test", "student")
        for i, (op, ts, row, id, name) in enumerate(rows_in)
    ], schemas.LOG)
    t = apply.open_target(spark, str(tmp_path), "test", "student")
    apply.apply_log(log, t, "test", "student", "c1")
    assert rows(t.snapshot(), "id", "name") == [(1, "second")]
    bad = apply.bad_events(t)
    assert rows(bad, "id", "reason") == [("1", "op"), ("2", "op"), ("3", "key")]
    assert set(schemas.LOG.names) < set(bad.columns) and shape.names[0] in bad.columns


def test_batch_that_fails_after_its_write_is_not_doubled(spark, tmp_path, landed):
    log = str(tmp_path / "log")
    land = apply.land_batch(log)
    failing = {1}

    def each(batch, batch_id):
        land(batch, batch_id)
        if batch_id in failing:
            raise RuntimeError("lost")

    def run():
        apply.finish(apply.run_batches(stream(spark, landed), each, str(tmp_path / "cp")))

    with pytest.raises(Exception, match="lost"):
        run()
    failing.clear()
    run()
    back = apply.read_log(spark, log)
    assert back.count() == 60 and back.select("id").distinct().count() == 60
    again = str(tmp_path / "again")
    apply.finish(apply.run_batches(stream(spark, landed), land, again))
    assert apply.read_log(spark, log).count() == 60


def test_feeds_share_a_log(spark, tmp_path, landed):
    log = str(tmp_path / "log")
    apply.finish(apply.land_log(stream(spark, landed, 9), log, str(tmp_path / "one")))
    other = tmp_path / "other"
    other.mkdir()
    (other / "more.json").write_text("\n".join(lines(63)[59:]))  # one event is there already
    apply.finish(apply.land_log(stream(spark, str(other), 9), log, str(tmp_path / "two")))
    assert len(commits.complete(spark, log)) == 2
    back = apply.read_log(spark, log)
    assert back.count() == 63 and back.select("id").distinct().count() == 63


def test_resume_reads_only_what_is_new(spark, tmp_path, landed):
    log, cp = str(tmp_path / "log"), str(tmp_path / "cp")
    apply.finish(apply.land_log(stream(spark, landed, 9), log, cp))
    more = lines(62)[60:]
    with open(f"{landed}/more.json", "w") as f:
        f.write("\n".join(more))
    apply.finish(apply.land_log(stream(spark, landed, 9), log, cp))
    assert len(commits.complete(spark, log)) == 2
    assert apply.read_log(spark, log, after=commits.commit_id(0)).count() == 2


def test_log_has_a_directory_per_table(spark, tmp_path, landed):
    log = str(tmp_path / "log")
    apply.finish(apply.land_log(stream(spark, landed, 9), log, str(tmp_path / "cp")))
    one = feed.select_table(apply.read_log(spark, log), "test", "student")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(db" in plan
    assert one.count() == sum('"student"' in e for e in lines())


def test_table_added_later_starts_from_the_log(spark, tmp_path, landed, monkeypatch):
    for tb in ("student", "test4"):
        monkeypatch.setitem(schemas.REGISTRY, f"ods_test_{tb}", (SHAPE, ("id",)))
    log = str(tmp_path / "log")
    apply.finish(apply.land_log(stream(spark, landed), log, str(tmp_path / "cp")))
    found = []
    for tb in ("student", "test4"):
        t = apply.fan_out(
            log, spark, str(tmp_path), [("test", tb)], str(tmp_path / f"cp-{tb}"),
            files_per_trigger=2,
        )["test", tb]
        found += rows(t.snapshot(), "id", "name")
    assert sorted(found) == expected(spark, landed)


def test_running_count_and_metric(spark, tmp_path, landed):
    spec = TableSpec(("dimension",))
    n = KeyedTable.create(
        spark, str(tmp_path / "n"), schemas.schema(dimension=STRING, cnt=LONG), spec
    )
    counts = live.running_count(stream(spark, landed))
    apply.finish(apply.stream_upsert(counts, n, str(tmp_path / "cp1"), mode="update"))
    assert rows(n.snapshot(), "cnt") == [(60,)]
    assert rows(n.versions(), "cnt") == [(15,), (30,), (45,), (60,)]

    # Deltas of one row: 5 -> 8 -> deleted -> 2.
    data = [("c", 5.0, None), ("u", 8.0, 5.0), ("d", None, 8.0), ("c", 2.0, None)]
    df = spark.createDataFrame(data, "op string, v double, b double")
    metric = live.running_metric(df, "total", live.change_delta("v", "b"))
    assert rows(metric) == [("total", 2.0)]


def test_windows(spark, tmp_path, landed):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:04", "a"), ("2024-01-01 00:00:05", "a"), ("2024-01-01 00:00:09", "a")],
        "ts string, w string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    got = live.tumbling(df, "ts", "5 seconds", ["w"], F.count("*").alias("n"))
    assert rows(got.select(F.col("window_start").cast("string"), "n")) == [
        ("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:05", 2)]

    t = KeyedTable.create(
        spark, str(tmp_path / "w"),
        schemas.schema(window_start=schemas.TIMESTAMP, window_end=schemas.TIMESTAMP,
                       kind=STRING, n=LONG),
        TableSpec(("window_start", "kind")),
    )
    counts = live.processing_time_sum(
        stream(spark, landed).select(F.col("op").alias("kind")), "5 seconds", ["kind"],
        F.lit(1), "n",
    )
    apply.finish(apply.stream_upsert(counts, t, str(tmp_path / "cp"), mode="update"))
    assert t.snapshot().agg(F.sum("n")).first()[0] == 60


def test_streaming_words(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, text in enumerate(("a b a", "b\na")):
        (tmp_path / "in" / f"{i}.txt").write_text(text)
    t = KeyedTable.create(
        spark, str(tmp_path / "t"), schemas.schema(word=STRING, n=LONG), TableSpec(("word",))
    )
    words = word_count(stream_lines(spark, str(tmp_path / "in"), files_per_trigger=1))
    apply.finish(apply.stream_upsert(words, t, str(tmp_path / "cp"), mode="update"))
    assert rows(t.snapshot(), "word", "n") == [("a", 3), ("b", 2)]


def test_table_changes_as_a_stream(spark, tmp_path):
    t = KeyedTable.create(
        spark, str(tmp_path / "t"), schemas.schema(id=LONG, v=LONG), TableSpec(("id",))
    )
    for i in range(3):
        t.upsert(spark.range(4).selectExpr("id", f"{i}L v"), f"c{i}")
    seen = []

    def each(batch, _):
        seen.extend(tuple(r) for r in batch.select("id", "v", "commit_time").collect())

    apply.finish(apply.run_batches(t.stream_changes("c1"), each, str(tmp_path / "cp")))
    assert sorted(seen) == sorted((k, i, f"c{i}") for k in range(4) for i in (1, 2))


def test_running_query_commits_per_interval(spark, tmp_path, landed):
    """With an interval the query keeps running until it is stopped."""
    t = table(spark, tmp_path)
    changes = feed.typed_changes(stream(spark, landed), SHAPE)
    q = apply.stream_upsert(changes, t, str(tmp_path / "cp"), interval="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert rows(t.snapshot(), "id", "name") == expected(spark, landed)


def test_jobs(spark, tmp_path, landed, monkeypatch):
    monkeypatch.setitem(schemas.REGISTRY, "ods_test_student", (SHAPE, ("id",)))
    from tidelog import jobs

    common = ["--log", str(tmp_path / "log"), "--files-per-trigger", "2"]
    land = jobs.arguments(["land", "--feed", landed, "--tables", r"test\.stud.*",
                           "--checkpoint", str(tmp_path / "cp1"), *common])
    apply.finish(jobs.start(spark, land))
    one = jobs.arguments(["apply", "-d", "test", "-t", "student", "--root", str(tmp_path / "ods"),
                          "--checkpoint", str(tmp_path / "cp2"), *common])
    apply.finish(jobs.start(spark, one))
    t = KeyedTable.open(spark, str(tmp_path / "ods" / "ods_test_student"))
    events = feed.select_table(feed.decode(feed.read_feed(spark, landed)), "test", "student")
    want = rows(feed.changelog_table(events, SHAPE, ["id"]))
    assert rows(t.snapshot(), "id", "name") == want
    with pytest.raises(SystemExit):
        jobs.arguments(["apply", "-d", "test"])


def test_figures_follow_updates_late_events_and_deletes(spark, tmp_path):
    cols = "id int, g string, v double, ts int"
    make = lambda name, ddl, *spec: KeyedTable.create(
        spark, str(tmp_path / name), spark.createDataFrame([], ddl).schema, TableSpec(*spec))
    ods = make("ods", cols, ("id",), ("ts",))
    dw = make("dw", "g string, cnt long, total double", ("g",))

    def follow():
        apply.finish(apply.follow_aggregate(
            ods, dw, str(tmp_path / "cp"), {"g": F.col("g")}, F.col("v"), F.col("v") > 1, commits_per_trigger=1))

    def want():
        return rows(ods.snapshot().where("v > 1").groupBy("g").agg(F.count("*").alias("cnt"), F.sum("v").alias("total")))

    steps = [
        [(1, "a", 2.0, 1), (2, "a", 3.0, 5), (3, "b", 4.0, 1)], [(1, "b", 2.0, 2), (2, "a", 9.0, 4)],
        [(3, "b", 1.0, 2)], [(2, "c", 5.0, 6), (1, "b", 0.5, 3)],
    ]
    for n, step in enumerate(steps):
        ods.upsert(spark.createDataFrame(step, cols), f"c{n}")
        if n != 1:  # two commits wait for one run
            follow()
            assert rows(dw.snapshot(), "g", "cnt", "total") == want()
    follow()  # nothing new
    ods.delete_keys(spark.createDataFrame([(2,)], "id int"), "c8")
    follow()
    assert rows(dw.snapshot(), "g", "cnt", "total") == want() == []


def test_followers_see_complete_commits_once(spark, tmp_path):
    t = KeyedTable.create(spark, str(tmp_path / "t"), spark.createDataFrame([], "id int").schema, TableSpec(("id",)))
    seen = []
    each = lambda batch, n: seen.extend((r.commit_time, r.id) for r in batch.collect())
    follow = lambda: apply.finish(apply.follow_changes(t, each, str(tmp_path / "cp"), "c1"))
    for c in ("c0", "c1"):
        t.upsert(spark.createDataFrame([(1,)], "id int"), c)
    half = spark.createDataFrame([(9, "u")], "id int, op string").write
    half.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{t.log}/commit_time=c15")
    follow()
    t.upsert(spark.createDataFrame([(2,), (3,)], "id int"), "c2")
    follow()
    follow()
    assert sorted(seen) == [("c1", 1), ("c2", 2), ("c2", 3)]
