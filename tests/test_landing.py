"""Landing of the feed: what it moves, and that its parts stay small and whole."""

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import TESTDATA, rows
from tidelog.plans import inputs
from tidelog.sources.feed import decode, read_feed


def files(path):
    return sorted(Path(path).glob("part-*"))


def test_texts_are_made_behind_the_exchange(spark):
    """No sort of rows dealt in turns, and no envelope in the shuffle: both several times the events."""
    shown = inputs.envelopes(inputs.dealt(inputs.feed(spark, TESTDATA), "pos"))
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan
    behind, before = plan.split("Exchange hashpartitioning(pos")
    assert "json" in behind.lower() and "json" not in before.lower()


def test_landed_files_are_compressed_bounded_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "LANDED_LINES", 20)
    events = inputs.feed(spark, TESTDATA).limit(500).localCheckpoint()
    path = inputs.land_feed(events, str(tmp_path / "in"))
    texts = [gzip.decompress(f.read_bytes()).decode().splitlines() for f in files(path)]
    assert max(map(len, texts)) <= 20 and sum(map(len, texts)) == 500
    expected = rows(decode(inputs.envelopes(events)))
    assert rows(decode(read_feed(spark, path))) == expected
    assert inputs.per_trigger(spark, path) == -(-len(texts) // 3)


def test_order_of_files_says_nothing_about_the_order_of_events(spark, tmp_path):
    path = inputs.land_feed(inputs.feed(spark, TESTDATA), str(tmp_path / "in"))
    log = decode(read_feed(spark, path)).groupBy(F.input_file_name()).agg(
        F.min("ts_ms").alias("a"), F.max("ts_ms").alias("b"))
    found = [(r["a"], r["b"]) for r in log.collect()]
    assert len(found) >= 8 and max(a for a, _ in found) < min(b for _, b in found)


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_a_landed_feed_takes_a_few_batches_at_any_size(spark, tmp_path, monkeypatch, batches):
    sizes = []
    for lines in (1_000, 5):
        monkeypatch.setattr(inputs, "LANDED_LINES", lines)
        path = inputs.land_feed(inputs.feed(spark, TESTDATA).limit(300), str(tmp_path / f"in{lines}"))
        n = len(files(path))
        sizes.append(n)
        assert -(-n // inputs.per_trigger(spark, path, batches)) <= batches
    assert sizes[1] > sizes[0]
