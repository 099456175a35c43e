"""Removal of byte passages that occur more than once, by prefix doubling in Spark.

A position's rank identifies the bytes that follow it; ranks of length 2n come from the pair of
ranks n apart. Sorting the ranks of all positions at every length would shuffle many times the
corpus, so the positions are thinned by content: a window of `min_bytes` is filed under the
smallest rank, among the prefixes of a given length inside it, and neighbouring windows with one
place of that rank form a run. Equal windows are always filed alike, so a rank that occurs in one run
only clears all its windows. The rounds go on at growing lengths (64 bytes, 4/5 of the threshold,
the threshold):

* runs whose rank is unique are dropped;
* runs equal to another run as a whole are repeated, and done;
* the rest, with one run for every text already known as repeated to compare with, go to the
  next length. At the threshold a run is a single window and equality decides.

Every count is an aggregate that combines before the shuffle and every way back is a plain
equi-join, so no task holds all places of a common passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batch, flat, give_back, joined, lean, stored, utf8

SEGMENT = 1 << 18  # windows of one text that are ranked at once
RUNS = {"k1": pa.int64(), "k2": pa.int64(), "v": pa.int64(), "u": pa.int64(), "lo": pa.int32(),
        "n": pa.int32(), "known": pa.bool_()}
RUNS_SQL = "k1 long, k2 long, v long, u long, lo int, n int, known boolean"


def power(length: int) -> int:
    return 1 << (length.bit_length() - 1)


def ranks(data: np.ndarray, lengths: set[int]) -> dict[int, np.ndarray]:
    """Ranks of all prefixes of the given lengths (at least 8), by doubling."""
    h = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    h = joined(h, h)
    at, found = 8, {}
    while True:
        for length in lengths:
            if power(length) == at:
                d = length - at
                found[length] = h if d == 0 else joined(h[:-d], h[d:])
        if at >= power(max(lengths)):
            return found
        h = joined(h[:-at], h[at:])
        at *= 2


def least(h: np.ndarray, count: int) -> np.ndarray:
    """Minimum of `count` neighbours from each position on."""
    step = 1
    while step * 2 <= count:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    rest = count - step
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def runs_of(data: np.ndarray, length: int, size: int,
            marks: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Runs of windows of `size` bytes filed under one rank of `length`: v, u, lo, n, known.

    marks: 0 for windows to leave out, 1 for open ones, 2 for known ones.
    """
    half = power(size) // 2
    h = ranks(data, {half, length, size})
    whole = h[size]
    if length == size:
        v = whole
        cuts = np.arange(1, len(v))
    else:
        v = least(h[length], size - length + 1)
        # A run ends where its smallest rank changes place, even if the next one is equal, so
        # that no two windows of a run are equal.
        cut = v[1:] != v[:-1]
        cut |= h[length][:len(cut)] == v[:-1]
        if marks is not None:
            cut |= marks[1:] != marks[:-1]
        cuts = np.flatnonzero(cut) + 1
    lo = np.concatenate([[0], cuts])
    hi = np.concatenate([cuts, [len(v)]])
    if marks is not None:
        keep = marks[lo] > 0
        lo, hi = lo[keep], hi[keep]
    if length == size:  # a second, differently built rank of the same bytes
        g, middle = h[half], (size - half) // 2
        u = joined(joined(g[lo], g[lo + middle]), g[lo + size - half])
        if size > 3 * half:
            u = joined(u, g[lo + half])
    else:
        u = joined(whole[lo], whole[hi - 1]) + (hi - lo).astype(np.uint64)
    known = np.zeros(len(lo), bool) if marks is None else marks[lo] == 2
    return v[lo], u, lo, hi - lo, known


def run_batches(length: int, size: int):
    """mapInArrow function: rows (k1, k2, b[, spans]) to runs."""

    def one(body: np.ndarray, spans) -> list[tuple[np.ndarray, ...]]:
        windows = len(body) - size + 1
        found = []
        for a in range(0, max(windows, 0), SEGMENT):
            z = min(a + SEGMENT, windows)
            marks = None
            if spans is not None:
                inside = [s for s in spans if s[0] < z and s[0] + s[1] > a]
                if not inside:
                    continue
                marks = np.zeros(z - a, np.int8)
                for lo, n, known in inside:
                    part = marks[max(lo - a, 0):lo + n - a]
                    np.maximum(part, 2 if known else 1, out=part)
            v, u, lo, n, known = runs_of(body[a:z + size - 1], length, size, marks)
            found.append((v, u, lo + a, n, known))
        return found

    def run(batches):
        for b in batches:
            data, offsets = flat(b.column(2))
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            spans = b.column(3) if b.num_columns > 3 else None
            out, rows, held = [], [], 0
            for i in range(b.num_rows):
                listed = None
                if spans is not None:
                    listed = [(s["lo"], s["n"], s["known"]) for s in spans[i].as_py()]
                for part in one(data[offsets[i]:offsets[i + 1]], listed):
                    out.append(part)
                    rows.append(i)
                    held += len(part[0])
                if held > 200_000:
                    yield packed(out, rows, k1, k2)
                    out, rows, held = [], [], 0
            if out:
                yield packed(out, rows, k1, k2)

    def packed(out, rows, k1, k2):
        v, u, lo, n, known = (np.concatenate([o[i] for o in out]) for i in range(5))
        who = np.repeat(rows, [len(o[0]) for o in out])
        return batch({"k1": k1[who], "k2": k2[who], "v": v.view(np.int64), "u": u.view(np.int64),
                      "lo": lo.astype(np.int32), "n": n.astype(np.int32), "known": known}, RUNS)

    return run


def settled(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs now known to be repeated, and the runs to look at with longer ranks."""
    shared = stored(
        runs.groupBy("v").agg(F.count("*").alias("c"), F.min("u").alias("u0"), F.max("u").alias("u1"))
        .where("c > 1").select("v", (F.col("u0") == F.col("u1")).alias("alike")), "shared-ranks")
    open_runs = runs.join(shared, "v")
    whole = open_runs.where("alike and not known")
    mixed = stored(open_runs.where("not alike"), "mixed-runs")
    kinds = stored(
        mixed.groupBy("v", "u").agg(
            F.count("*").alias("c"), F.max("known").alias("known"),
            F.min(F.struct("k1", "k2", "lo", "n")).alias("at"))
        .select("v", "u", (F.col("known") | (F.col("c") > 1)).alias("seen"), "at"), "kinds-of-runs")
    equal = mixed.where("not known").join(kinds.where("seen").select("v", "u"), ["v", "u"])
    spans = ["k1", "k2", "lo", "n"]
    found = stored(whole.select(spans).unionByName(equal.select(spans)), "repeated-runs")
    return found, kinds.select("at.*", F.col("seen").alias("known"))


def repeated_spans(texts: DataFrame, min_bytes: int) -> DataFrame:
    """(k1, k2, spans): for texts (k1, k2, b), the runs of windows that also start elsewhere."""
    size = min_bytes
    if size < 80:
        raise ValueError("min_bytes is 80 at least: the first ranks are of 64 bytes")
    long = texts.where(F.length("b") >= size)
    runs = stored(long.mapInArrow(lean(run_batches(64, size)), RUNS_SQL), "runs")
    found = []
    for length in (size * 4 // 5, size):
        done, rest = settled(runs)
        found.append(done)
        rest = stored(rest.groupBy("k1", "k2").agg(
            F.collect_set(F.struct("lo", "n", "known")).alias("spans")), "open-runs")
        # Equal rows of the table need not be ranked twice: their runs are known by now.
        again = long.join(rest, ["k1", "k2"]).select("k1", "k2", "b", "spans")
        runs = stored(again.mapInArrow(lean(run_batches(length, size)), RUNS_SQL), "runs")
    found.append(settled(runs)[0])
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return stored(spans.distinct().groupBy("k1", "k2").agg(
        F.collect_list(F.struct("lo", "n")).alias("spans")), "spans")


def cover(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of the union."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[first], hi[np.concatenate([first[1:], [True]])]


def cut_spans(bodies: pa.Array, listed: pa.Array, size: int):
    """Of each row: its bytes, the maximal removed spans, and what remains."""
    data, offsets = flat(bodies)
    at = listed.offsets.to_numpy()
    lo_all = listed.values.field("lo").to_numpy() if len(listed.values) else np.empty(0, np.int32)
    n_all = listed.values.field("n").to_numpy() if len(listed.values) else np.empty(0, np.int32)
    for i in range(len(bodies)):
        text = data[offsets[i]:offsets[i + 1]]
        if not listed[i].is_valid or at[i] == at[i + 1]:
            yield text, (np.empty(0, np.int64), np.empty(0, np.int64)), text.tobytes()
            continue
        lo = lo_all[at[i]:at[i + 1]].astype(np.int64)
        starts, ends = cover(lo, lo + n_all[at[i]:at[i + 1]] + size - 1)
        edges = np.concatenate([[0], np.stack([starts, ends], 1).ravel(), [len(text)]])
        kept = b"".join(text[edges[j]:edges[j + 1]].tobytes() for j in range(0, len(edges), 2))
        yield text, (starts, ends), kept


def keys(text: str, id: str) -> list[Column]:
    """k1 and k2: a key of a row's id and text, equal for equal rows only."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    i = F.coalesce(F.col(id).cast("string"), F.lit("null"))
    return [F.xxhash64(i, t).alias("k1"), F.xxhash64(t, F.lit(7), i).alias("k2")]


def keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(k1, k2, b) of each row: its key and its bytes."""
    return docs.select(*keys(text, id), utf8(text).alias("b"))


def with_spans(docs: DataFrame, text: str, id: str, min_bytes: int) -> DataFrame:
    """One row for each of docs: its columns in the struct `row`, its bytes `b`, and `spans`."""
    spans = repeated_spans(keyed(docs, text, id), min_bytes)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), utf8(text).alias("b"),
                       *keys(text, id))
    return rows.join(spans, ["k1", "k2"], "left").select("row", "b", "spans")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text",
                   min_bytes: int = 200) -> DataFrame:
    """Remove each byte covered by a `min_bytes` string that starts anywhere else as well.

    Returns one row per input row: the id, n_bytes, n_removed, n_spans (maximal removed runs),
    spans (their bounds in bytes), kept (the remaining bytes) and kept_sha256. A null text is
    empty; texts shorter than `min_bytes` stay as they are; of repeated rows all copies lose the
    text; a null id is a key like any other; other columns are not read.
    """
    kind = docs.schema[id].dataType
    pairs = with_spans(docs.select(id, text), text, id, min_bytes)
    types = {"id": None, "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
             "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
             "kept": pa.binary(), "kept_sha256": pa.string()}

    def cut(batches):
        for b in batches:
            if not b.num_rows:
                continue
            total, removed, count, spans, kept, digest = [], [], [], [], [], []
            for body, (starts, ends), rest in cut_spans(b.column(1), b.column(2), min_bytes):
                total.append(len(body))
                removed.append(len(body) - len(rest))
                count.append(len(starts))
                spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
                kept.append(rest)
                digest.append(hashlib.sha256(rest).hexdigest())
            yield batch({"id": b.column(0), "n_bytes": total, "n_removed": removed,
                         "n_spans": count, "spans": spans, "kept": kept, "kept_sha256": digest}, types)

    out = pairs.select(F.col("row").getField(id).alias("id"), "b", "spans").mapInArrow(
        cut, f"id {kind.simpleString()}, n_bytes long, n_removed long, n_spans long, "
             "spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string")
    return out.withColumnRenamed("id", id)


def strip_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  min_bytes: int = 200) -> DataFrame:
    """docs with the repeated bytes cut out of `text`; rows and columns stay.

    A character cut in two goes with the passage. `n_chars`, if there is one, is counted anew. A
    null text stays null, repeated rows all lose the text, an empty table stays empty.
    """
    spans = repeated_spans(keyed(docs, text, id), min_bytes)

    @F.arrow_udf(returnType="string")
    def rest_of(bodies: pa.Array, listed: pa.Array) -> pa.Array:
        rest = [k.decode("utf-8", "ignore") if len(s[0]) else None
                for _, s, k in cut_spans(bodies, listed, min_bytes)]
        give_back()
        return pa.array(rest, pa.string())

    # One struct holds the columns, so that no name of theirs can clash; texts without a passage
    # of the kind never leave Spark.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *keys(text, id))
    was = F.col("row").getField(text)
    body = F.when(F.col("spans").isNotNull(), was)
    found = rows.join(spans, ["k1", "k2"], "left").select("row", rest_of(utf8(body), "spans").alias("rest"))

    def column(c: str):
        if c == text:
            return F.coalesce("rest", was).alias(c)
        if c == "n_chars":
            changed = F.length("rest").cast(docs.schema[c].dataType)
            return F.coalesce(changed, F.col("row").getField(c)).alias(c)
        return F.col("row").getField(c).alias(c)

    return found.select(*[column(c) for c in docs.columns])
