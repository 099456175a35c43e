"""Every stage of the pipeline on its own input against brute force, and the queries against SQL."""

import collections

import brute
import duckdb
import pytest

import corpus_pipeline
from tidelog import session
from tidelog.llm import divergence, queries

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = session.scratch(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        was = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        if number < 4:
            assert docs.columns == columns
            now = {r.doc_id: r.text for r in docs.collect()}
        if number == 0:
            assert set(now) == {r.doc_id for r in divergence.score(before).where("kept").collect()}
        elif number == 1:
            assert set(now) == {w[0] for w in brute.near(list(was.items()), k=5) if w[3] or not w[1]}
        elif number == 2:
            want = {w[0]: w for w in brute.repeats(list(was.items()))}
            assert set(now) == set(was)
            for d, text in now.items():
                assert (text == was[d]) == (want[d][2] == 0)
                assert abs(len(text.encode()) - (want[d][1] - want[d][2])) <= 6 * want[d][3]
        elif number == 3:
            assert set(now) == {w[0] for w in brute.contamination(list(was.items()), items) if not w[5]}
        else:
            rows = docs.collect()
            assert {r.doc_id for r in rows} == set(was)
            full = collections.Counter()
            for r in rows:
                full[r.sequence_id] += r.length
            assert max(full.values()) <= 4096 and len(full) <= -(-sum(full.values()) // 4096) + 1


def test_near_dedup_takes_five_words(spark):
    docs = corpus_pipeline.quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    two, five = ({w[0] for w in brute.near(rows, k=k) if w[3] or not w[1]} for k in (2, 5))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).select("doc_id").collect()}
    assert kept == five and two < five


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    left, right = (x[columns].sort_values(columns).astype(str).values.tolist() for x in (want, got))
    assert left == right
