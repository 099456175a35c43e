"""Timeline of a small keyed table: the same golden rows for both kinds."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tidelog.schemas import INT, STRING, TableSpec
from tidelog.schemas import schema as schema_of
from tidelog.tables import commits
from tidelog.tables.keyed import KeyedTable

SCHEMA = schema_of(id=INT, name=STRING, price=INT, flag=STRING, update_date=STRING)

# The commits of the sample timeline.
C1 = [(1, "aaa", 55, "I"), (2, "bbb", 55, "I"), (3, "ccc", 55, "I")]
C2 = [(2, "bbb", 99, "U"), (4, "ddd", 100, "I"), (9, "zzz", -99, "D")]


def frame(spark, data):
    return spark.createDataFrame([(*r, "2020-01-01") for r in data], SCHEMA)


def prices(df):
    return {r["id"]: r["price"] for r in df.collect()}


@pytest.fixture(params=["mor", "cow"])
def table(spark, tmp_path, request):
    spec = TableSpec(("id",), ("update_date",), kind=request.param, buckets=4)
    t = KeyedTable.create(spark, str(tmp_path / "h1"), SCHEMA, spec)
    t.insert(frame(spark, C1), "c1", overwrite=True)
    t.upsert(frame(spark, C2), "c2")
    t.delete_keys(spark.createDataFrame([(9,), (10,)], "id int"), "c3")
    return t


def test_timeline(spark, table):
    assert prices(table.as_of("c1")) == {1: 55, 2: 55, 3: 55}
    assert prices(table.as_of("c2")) == {1: 55, 2: 99, 3: 55, 4: 100, 9: -99}
    assert prices(table.snapshot()) == {1: 55, 2: 99, 3: 55, 4: 100}
    assert prices(table.incremental("000", "c2")) == prices(table.as_of("c2"))
    assert prices(table.incremental("c1", "c2")) == {2: 99, 4: 100, 9: -99}
    current = table.snapshot()
    assert prices(current.where("commit_time >= 'c2'")) == {2: 99, 4: 100}
    assert rows(current.select("commit_time").distinct()) == [("c1",), ("c2",)]
    ids = [r["commit_time"] for r in table.commits().where("kind <> 'truncates'").collect()]
    assert ids == ["c3", "c2", "c1"]


def test_reopen(spark, table):
    again = KeyedTable.open(spark, table.path)
    assert type(again) is type(table) and again.spec == table.spec
    assert rows(again.snapshot()) == rows(table.snapshot())


def test_key_delete_ends_older_versions_only(spark, table):
    late = spark.createDataFrame([(9, "back", 7, "I", "2019-01-01")], SCHEMA)
    table.upsert(late, "c4")
    assert prices(table.snapshot())[9] == 7


def test_older_order_value_loses(spark, table):
    table.upsert(spark.createDataFrame([(1, "old", 1, "U", "2019-12-31")], SCHEMA), "c4")
    assert prices(table.snapshot())[1] == 55


def test_update_delete_truncate(spark, table):
    table.update_where("id = 2", {"price": F.lit(1)}, "c4")
    table.delete_where("id = 3", "c5")
    assert prices(table.snapshot()) == {1: 55, 2: 1, 4: 100}
    table.truncate("c6")
    assert prices(table.snapshot()) == {}
    table.insert(frame(spark, C1[:1]), "c7")
    assert prices(table.snapshot()) == {1: 55}
    assert prices(table.as_of("c5")) == {1: 55, 2: 1, 4: 100}


def test_replayed_commit_is_one_commit(spark, table):
    before = rows(table.snapshot())
    table.upsert(frame(spark, C2), commits.OfBatch("c2"))
    table.delete_keys(spark.createDataFrame([(9,)], "id int"), commits.OfBatch("c3"))
    assert rows(table.snapshot()) == before


def test_unfinished_commit_is_not_read(spark, table):
    assert commits.write(frame(spark, C1).withColumn("op", F.lit("u")), table.log, "c8")
    import os

    os.remove(f"{table.log}/commit_time=c8/_SUCCESS")
    assert "c8" not in [c for c, _ in table.commit_ids()]
    assert prices(table.snapshot()) == {1: 55, 2: 99, 3: 55, 4: 100}


@pytest.mark.parametrize("kind", ["mor", "cow"])
def test_patch_keeps_what_a_change_leaves_out(spark, tmp_path, kind):
    shape = schema_of(id=INT, a=INT, b=STRING, ts=INT)
    spec = TableSpec(("id",), ("ts",), kind=kind, buckets=2)
    t = KeyedTable.create(spark, str(tmp_path / "p"), shape, spec)
    given = "id int, a int, b string, ts int, op string"
    t.insert(spark.createDataFrame([(1, 1, "x", 1), (2, 2, "y", 1), (3, 3, "z", 1)], shape), "c1")
    t.patch(spark.createDataFrame(
        [(1, None, "X", 2, "u"), (1, 11, None, 3, "u"), (2, None, None, 2, "d"),
         (3, None, None, 2, "d"), (3, 30, None, 3, "c"), (4, 4, None, 1, "c")], given), "c2")
    got = rows(t.snapshot(), "id", "a", "b", "ts")
    assert got == [(1, 11, "X", 3), (3, 30, None, 3), (4, 4, None, 1)]
    # A late change older than the row only fills what is null; a partial frame may lack columns.
    t.patch(spark.createDataFrame([(1, 5, "old", 0, "u"), (4, 5, "w", 0, "u")], given), "c3")
    t.patch(spark.createDataFrame([(3, 9)], "id int, ts int"), "c4")
    got = rows(t.snapshot(), "id", "a", "b", "ts")
    assert got == [(1, 11, "X", 3), (3, 30, None, 9), (4, 4, "w", 1)]
    # An older change of a deleted key does not bring it back.
    t.patch(spark.createDataFrame([(2, 7, "back", 1, "u")], given), "c5")
    assert 2 not in [r["id"] for r in t.snapshot().collect()]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    spec = TableSpec(("id",), (), kind="cow", buckets=8)
    t = KeyedTable.create(spark, str(tmp_path / "t"), T.StructType.fromDDL("id int, v int"), spec)
    t.insert(spark.range(100).selectExpr("cast(id as int) id", "1 v"), "c1")
    t.upsert(spark.createDataFrame([(5, 2)], "id int, v int"), "c2")
    assert [c for c, _ in commits.children(spark, t.log, "bucket")] == ["c1"] * 8 + ["c2"]
    assert t.snapshot().agg(F.count("*"), F.sum("v")).first()[:] == (100, 101)


def test_partitioned_rows_keep_text_and_stay_unique(spark, tmp_path):
    schema = T.StructType.fromDDL("id bigint, name string, ts bigint, dt string, hh string")
    spec = TableSpec(("id",), ("ts",), ("dt", "hh"))
    t = KeyedTable.create(spark, str(tmp_path / "pt"), schema, spec)
    t.insert(spark.createDataFrame([(1, "a1", 1000, "2021-12-09", "10")], schema), "c1")
    t.insert(
        spark.createDataFrame(
            [(2, "a2", 1000, "2021-12-09", "11"), (3, "a3", 1000, "2021-12-09", "11")], schema
        ), "c2",
    )
    t.update_where("id = 2", {"ts": F.lit(1999)}, "c3")
    t.delete_where("id = 3", "c4")
    assert rows(t.snapshot().drop("commit_time")) == [
        (1, "a1", 1000, "2021-12-09", "10"), (2, "a2", 1999, "2021-12-09", "11"),
    ]
    t.upsert(spark.createDataFrame([(1, "a1", 1001, "2021-12-10", "09")], schema), "c5")
    assert rows(t.snapshot().where("id = 1").select("dt", "hh")) == [("2021-12-10", "09")]


def test_compaction_changes_no_read(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, v int, ts int")
    plain, folded = (
        KeyedTable.create(spark, str(tmp_path / n), schema, TableSpec(("id",), ("ts",)))
        for n in ("plain", "folded")
    )
    for i in range(6):
        batch = spark.range(40).selectExpr(
            f"cast((id * 7 + {i}) % 25 as int) id", f"cast(id + {i} as int) v",
            f"cast((id * 13 + {i} * 5) % 60 as int) ts",
            f"case when (id + {i}) % 5 = 0 then 'd' else 'u' end op",
        )
        for t in (plain, folded):
            t.upsert(batch.dropDuplicates(["id", "ts"]).orderBy("id"), f"c{i}")
            if i == 2:
                t.delete_keys(spark.createDataFrame([(3,), (4,)], "id int"), "c2d")
        if i in (1, 3):
            folded.compact()
    assert rows(folded.snapshot()) == rows(plain.snapshot())
    for c in ("c0", "c1", "c2", "c2d", "c4"):
        assert rows(folded.as_of(c)) == rows(plain.as_of(c))
    assert rows(folded.incremental("c1", "c4")) == rows(plain.incremental("c1", "c4"))


def test_history_load(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, v int")
    t = KeyedTable.create(spark, str(tmp_path / "h"), schema, TableSpec(("id",)))
    data = spark.range(30).selectExpr("cast(id % 5 as int) id", "cast(id as int) v",
                                      "lpad(cast(id div 5 as string), 3, '0') c")
    t.load_history(data, "c")
    t.load_history(data, "c")
    assert [r[0] for r in t.commits().limit(2).collect()] == ["005", "004"]
    assert rows(t.as_of("001").select("id", "v")) == [(i, 5 + i) for i in range(5)]
    assert t.snapshot().count() == 5


def test_spec_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        TableSpec(())
    with pytest.raises(ValueError):
        KeyedTable.create(spark, str(tmp_path / "x"), SCHEMA, TableSpec(("nope",)))
    with pytest.raises(ValueError):
        commits.write(frame(spark, C1), str(tmp_path / "y"), "a/b")


def test_stream_and_batch_commits_grow(spark, tmp_path):
    t = KeyedTable.create(spark, str(tmp_path / "g"), T.StructType.fromDDL("id int, v int"), TableSpec(("id",)))

    def row(i, v):
        return spark.createDataFrame([(i, v)], "id int, v int")

    t.upsert(row(1, 1), t.stream_commit(row(1, 1), 0))
    t.truncate()
    t.upsert(row(2, 2), t.stream_commit(row(2, 2), 1))
    assert [r["id"] for r in t.snapshot().collect()] == [2]
    t.delete_where("id = 2")
    t.upsert(row(2, 3), t.stream_commit(row(2, 3), 2))
    assert [r["v"] for r in t.snapshot().collect()] == [3]
    assert t.stream_commit(row(2, 3), 1) == sorted(c for c, k in t.commit_ids() if k == "log")[1]
    with pytest.raises(ValueError, match="not later"):
        t.upsert(row(9, 9), "00000000000000000-1")


def test_create_opens_and_refuses_another_spec(spark, tmp_path):
    shape, path = T.StructType.fromDDL("id int, v int"), str(tmp_path / "o")
    KeyedTable.create(spark, path, shape, TableSpec(("id",))).insert(
        spark.createDataFrame([(1, 1)], "id int, v int"))
    assert KeyedTable.create(spark, path, shape, TableSpec(("id",))).snapshot().count() == 1
    with pytest.raises(ValueError, match="another"):
        KeyedTable.create(spark, path, shape, TableSpec(("id",), kind="cow"))


ROW = "id int, v int, ts int"


def keyed(spark, tmp_path, name="t"):
    schema = spark.createDataFrame([], ROW).schema
    return KeyedTable.create(spark, str(tmp_path / name), schema, TableSpec(("id",), ("ts",)))


def test_used_commit_ids_are_refused(spark, tmp_path):
    t = keyed(spark, tmp_path)
    one, two = (spark.createDataFrame([(i, i, 1)], ROW) for i in (1, 2))
    t.insert(one, "c1")
    for again in (t.insert, t.upsert, t.delete_keys, t.patch):
        with pytest.raises(ValueError):
            again(two, "c1")
    t.upsert(two, "c2")
    with pytest.raises(ValueError):
        t.upsert(two, "c1")
    t.delete_keys(one, "c3")
    with pytest.raises(ValueError):
        t.delete_keys(two, "c3")
    assert rows(t.snapshot(), "id") == [(2,)]


def test_a_partitioned_commit_is_seen_whatever_the_session_overwrites(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        schema = spark.createDataFrame([], ROW).schema
        t = KeyedTable.create(spark, str(tmp_path / "p"), schema, TableSpec(("id",), ("ts",), ("v",)))
        t.insert(spark.createDataFrame([(1, 1, 1)], ROW), "c1")
        assert t.snapshot().count() == 1
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_loading_history_leaves_unfinished_commits_alone(spark, tmp_path):
    t = keyed(spark, tmp_path)
    half = spark.createDataFrame([(9, 9, 9, "c")], f"{ROW}, op string").write
    half.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{t.log}/commit_time=c0")
    t.load_history(spark.createDataFrame([(1, 1, 1, "c1")], f"{ROW}, c string"), "c")
    assert rows(t.snapshot(), "id") == [(1,)]


def test_compacting_nothing(spark, tmp_path):
    assert keyed(spark, tmp_path).compact() == ""


def test_images_are_what_a_stretch_of_commits_changed(spark, tmp_path):
    t = keyed(spark, tmp_path)
    frame = lambda *r: spark.createDataFrame(list(r), ROW)
    t.upsert(frame((1, 1, 1), (2, 2, 5), (3, 3, 1)), "c1")
    t.upsert(frame((1, 10, 2), (2, 20, 4), (4, 4, 1)), "c2")  # (2, 20) is late and changes nothing
    t.delete_keys(frame((3, 0, 0)), "c3")
    got = rows(t.images("c1", "c3").selectExpr("id", "old.v as old", "new.v as new"))
    assert got == sorted([(1, 1, 10), (3, 3, None), (4, None, 4)], key=repr)
    assert rows(t.images("", "c1").selectExpr("id", "old.v as old", "new.v as new")) == sorted(
        [(1, None, 1), (2, None, 2), (3, None, 3)], key=repr)
    t.truncate("c4")
    assert rows(t.images("c3", "c4").selectExpr("id", "old.v as old", "new.v as new")) == sorted(
        [(1, 10, None), (2, 2, None), (4, 4, None)], key=repr)


GIVEN = "id int, a int, b string, ts int, op string"
SAID = [  # (kind, row): whole rows and deletes say something about every column, patches about some
    ("patch", (1, None, "x", 3, "u")), ("upsert", (1, 1, "w", 1, "c")), ("patch", (1, 2, None, 2, "u")),
    ("upsert", (2, 5, "y", 1, "c")), ("patch", (2, 6, None, 3, "u")), ("upsert", (2, None, None, 2, "d")),
    ("patch", (2, 4, "old", 1, "u")), ("upsert", (3, None, "v", 4, "c")), ("patch", (3, 9, "u", 3, "u")),
    ("patch", (4, 8, None, 2, "d")), ("patch", (4, 7, "z", 1, "u")), ("upsert", (5, 3, "plain", 1, "c")),
]
LAST_WORDS = [(1, 2, "x", 3), (2, 6, None, 3), (3, None, "v", 4), (5, 3, "plain", 1)]


def patched(spark, path, said):
    shape = T.StructType.fromDDL("id int, a int, b string, ts int")
    t = KeyedTable.create(spark, path, shape, TableSpec(("id",), ("ts",)))
    for n, (kind, row) in enumerate(said):
        getattr(t, kind)(spark.createDataFrame([row], GIVEN), f"c{n:02}")
    return t


@pytest.mark.parametrize("order", [range(12), range(11, -1, -1), [5, 0, 7, 2, 9, 4, 11, 6, 1, 8, 3, 10]])
def test_patches_have_the_last_word_in_any_order(spark, tmp_path, order):
    t = patched(spark, str(tmp_path / "t"), [SAID[n] for n in order])
    assert rows(t.snapshot(), "id", "a", "b", "ts") == LAST_WORDS


def test_patches_in_every_kind_of_read(spark, tmp_path):
    t = patched(spark, str(tmp_path / "t"), SAID[:2])
    got = ["id", "a", "b", "ts"]
    assert rows(t.as_of("c00"), *got) == [(1, None, "x", 3)]
    assert rows(t.snapshot(), *got) == [(1, 1, "x", 3)]
    assert t.commits().count() == 2 and t.versions().count() == 2
    assert t.compact() == "c01" and rows(t.snapshot(), *got) == [(1, 1, "x", 3)]
    t.patch(spark.createDataFrame([(1, 4)], "id int, a int"), "c02")  # no order: older than all
    t.patch(spark.createDataFrame([(1, 6, 2)], "id int, a int, ts int"), "c03")
    assert rows(t.incremental("c02"), *got) == [(1, 6, "x", 3)]
    assert rows(t.changed(["c02", "c03"]), *got) == [(1, 6, "x", 3)]
    image, = t.images("c01", "c03").collect()
    assert (image["old"]["a"], image["new"]["a"], image["new"]["b"]) == (1, 6, "x")
    t.delete_keys(spark.createDataFrame([(1,)], "id int"), "c04")
    assert rows(t.snapshot()) == []
    t.patch(spark.createDataFrame([(1, 7, 1)], "id int, a int, ts int"), "c05")
    assert rows(t.snapshot(), *got) == [(1, 7, None, 1)]
    t.truncate("c06")
    t.patch(spark.createDataFrame([(2, 7, 1)], "id int, a int, ts int"), "c07")
    assert rows(t.snapshot(), *got) == [(2, 7, None, 1)]


def test_patch_over_a_folded_base(spark, tmp_path):
    t = patched(spark, str(tmp_path / "t"), [SAID[1], SAID[3], SAID[5]])
    t.compact()
    t.patch(spark.createDataFrame([SAID[2][1], SAID[6][1]], GIVEN), "c10")
    assert rows(t.snapshot(), "id", "a", "b", "ts") == [(1, 2, "w", 2)]
