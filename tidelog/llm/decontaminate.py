"""Benchmark decontamination as a prefix-filtered set join.

An item's windows (13 consecutive words; a shorter item is one window) are sets of word shingles.
A window occurs in a text only if all its shingles do, so a prefix of one shingle, the rarest, is
enough to find every text that may hold it. Pass one counts in how many documents each shingle of
the benchmark occurs; pass two looks the documents' shingles up among the windows' rarest ones,
checks by position and length that the window fits into the text there, and compares it word by
word.

The benchmark's windows go to the tasks in blocks of at most `block_words` words, a bound that is
checked: a larger benchmark is a larger number of blocks, each run against all documents.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WORDS, batch, flat, give_back, joined, lean, utf8

WINDOW = 13
SHINGLE = 5


class Block:
    """Windows of some items, by content, with their shingles."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, shingle: int):
        self.vocabulary: dict[bytes, int] = {}
        listed: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
                        for w in text.translate(WORDS).split())
            for i in range(max(len(ids) - window, 0) + 1 if ids else 0):
                listed[ids[i:i + window]].add(item)
        self.windows = [np.array(w, np.uint64) for w in listed]
        self.items = [sorted(v) for v in listed.values()]
        self.sizes = sorted({min(len(w), shingle) for w in self.windows})
        self.size_of = [min(len(w), shingle) for w in self.windows]
        self.keys = {s: np.unique(np.concatenate([
            shingles(w, s) for w, z in zip(self.windows, self.size_of) if z == s]))
            for s in self.sizes}

    def numbered(self, body: bytes) -> tuple[int, np.ndarray]:
        words = body.translate(WORDS).split()
        get = self.vocabulary.get
        return len(words), np.fromiter((get(w, 0) for w in words), np.uint64, len(words))

    def found(self, ids: np.ndarray, size: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text's shingles that are among the sorted keys, and which they are."""
        if len(ids) < size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        inside = np.flatnonzero(ids > 0)
        if size > 1 and len(inside):  # all words of the shingle are of the benchmark
            ok = np.concatenate([[0], np.cumsum(ids > 0)])
            inside = inside[inside + size <= len(ids)]
            inside = inside[ok[inside + size] - ok[inside] == size]
        if not len(inside):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        h = ids[inside]
        for k in range(1, size):
            h = joined(h, ids[inside + k])
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[at] == h
        return inside[hit], at[hit]

    def anchored(self, counts: dict[int, np.ndarray]) -> None:
        """Order each window's shingles by rarity and file it under the first."""
        chosen: dict[int, dict[int, list[tuple[int, int]]]] = {s: defaultdict(list) for s in self.sizes}
        for i, (w, s) in enumerate(zip(self.windows, self.size_of)):
            at = np.searchsorted(self.keys[s], shingles(w, s))
            p = int(np.lexsort((at, counts[s][at]))[0])
            chosen[s][int(at[p])].append((i, p))
        self.prefix = {s: {k: v for k, v in chosen[s].items()} for s in self.sizes}
        self.prefix_keys = {s: self.keys[s][sorted(chosen[s])] for s in self.sizes}
        self.prefix_at = {s: sorted(chosen[s]) for s in self.sizes}

    def hits(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans of the windows that occur, and their items."""
        spans, items = set(), set()
        for s in self.sizes:
            places, which = self.found(ids, s, self.prefix_keys[s])
            for place, k in zip(places.tolist(), which.tolist()):
                for window, p in self.prefix[s][self.prefix_at[s][k]]:
                    w, start = self.windows[window], place - p
                    if start < 0 or start + len(w) > len(ids):
                        continue
                    if np.array_equal(ids[start:start + len(w)], w):
                        spans.add((start, start + len(w)))
                        items.update(self.items[window])
        return sorted(spans), items


def shingles(ids: np.ndarray, size: int) -> np.ndarray:
    n = len(ids) - size + 1
    h = ids[:n]
    for k in range(1, size):
        h = joined(h, ids[k:k + n])
    return h


def blocks(benchmark: DataFrame, id: str, text: str, window: int, shingle: int,
           block_words: int):
    """The benchmark in blocks that fit a task: a block's words are bounded by `block_words`, or
    by one item if that is longer."""
    rows = benchmark.select(F.col(id).cast("string").alias("item"), utf8(text).alias("b")) \
        .where("item is not null").distinct()
    words = rows.agg(F.sum(F.length("b"))).first()[0] or 0
    number = max(1, -(-words // (2 * block_words)))
    part = F.pmod(F.xxhash64("item", "b"), F.lit(number))
    for k in range(number):
        listed = [(r["item"], bytes(r["b"])) for r in rows.where(part == k).collect()]
        yield Block(listed, window, shingle)


def counted(docs: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """In how many documents each shingle of the block occurs."""
    types = {"size": pa.int32(), "at": pa.int32(), "n": pa.int64()}

    def count(batches):
        sums = {s: np.zeros(len(block.keys[s]), np.int64) for s in block.sizes}
        for b in batches:
            data, offsets = flat(b.column(0))
            raw = data.tobytes()
            for i in range(b.num_rows):
                _, ids = block.numbered(raw[offsets[i]:offsets[i + 1]])
                for s in block.sizes:
                    sums[s][np.unique(block.found(ids, s, block.keys[s])[1])] += 1
        for s, total in sums.items():
            on = np.flatnonzero(total)
            yield batch({"size": np.full(len(on), s, np.int32), "at": on.astype(np.int32),
                         "n": total[on]}, types)

    found = {s: np.zeros(len(block.keys[s]), np.int64) for s in block.sizes}
    if block.sizes:
        totals = docs.mapInArrow(lean(count), "size int, at int, n long") \
            .groupBy("size", "at").agg(F.sum("n").alias("n"))
        for r in totals.collect():  # as many rows as the block has shingles
            found[r["size"]][r["at"]] = r["n"]
    return found


def places(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str,
           window: int, shingle: int, block_words: int) -> DataFrame:
    """(row, n_words, spans, items) of each document; row holds its columns."""
    bodies = docs.select(utf8(text).alias("b"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    found = []
    for block in blocks(benchmark, item, item_text, window, shingle, block_words):
        block.anchored(counted(bodies, block))
        found.append(searcher(block))
    body = utf8(F.col("row").getField(text))
    # All blocks see a row in one pass, and the row itself stays with Spark.
    rows = rows.select("row", F.array(*[search(body) for search in found]).alias("found"))
    return rows.select("row", F.col("found")[0]["n_words"].alias("n_words"),
                       F.flatten("found.spans").alias("spans"),
                       F.array_distinct(F.flatten("found.items")).alias("items"))


def searcher(block: Block):
    """An Arrow function from texts to (n_words, spans, items) by one block."""
    span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    @F.arrow_udf(returnType="struct<n_words: long, spans: array<struct<lo: long, hi: long>>, items: array<string>>")
    def search(bodies: pa.Array) -> pa.Array:
        data, offsets = flat(bodies)
        raw = data.tobytes()
        words, spans, items = [], [], []
        for i in range(len(bodies)):
            n, ids = block.numbered(raw[offsets[i]:offsets[i + 1]])
            hits, listed = block.hits(ids) if n else ([], set())
            words.append(n)
            spans.append([{"lo": a, "hi": z} for a, z in hits])
            items.append(sorted(listed))
        del raw, data
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
            names=["n_words", "spans", "items"])

    return search


def judged(found: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and the verdict, from the spans."""
    def grown(state, span):
        return F.struct(F.greatest(state["end"], span["hi"]).alias("end"),
                        (state["hit"] + F.greatest(F.lit(0).cast("long"),
                         span["hi"] - F.greatest(state["end"], span["lo"]))).alias("hit"))

    none = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    hit = F.aggregate(F.array_sort("spans"), none, grown, lambda state: state["hit"])
    return found.select(
        "row", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256")).withColumn(
        "contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, block_words: int = 2_000_000) -> DataFrame:
    """One row per document: the id, n_words, n_hit (words inside an occurrence of a window),
    n_items, items_sha256 (ids of the items found, sorted as strings) and contaminated (at least
    one word in twenty is hit).

    A null or empty text has no words and is clean. Items without words or without an id have no
    window; items repeated under one id count once; an empty benchmark leaves all clean. Repeated
    documents are judged alike; other columns are not read.
    """
    found = places(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), benchmark, "text",
                   item, item_text, window, shingle, block_words)
    out = judged(found.withColumn("row", F.struct(F.col("row.id").alias("id"))))
    return out.select(F.col("row.id").alias(id), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                      item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                      shingle: int = SHINGLE, block_words: int = 2_000_000) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Nulls, repeated rows and an empty benchmark as in `contamination`; no documents give none.
    """
    found = places(docs, benchmark, text, item, item_text, window, shingle, block_words)
    return judged(found).where("not contaminated").select("row.*")
