"""Best-fit packing of token pieces, after a reduction by dominance.

How pieces fit together depends on their lengths only, and there are at most `capacity` of them:
the plan is made on the histogram of lengths, whatever the number of documents. First come the
reductions of Martello and Toth: for the longest piece, a set with it that is at least as good as
any other set with it is fixed for good. What remains is packed best-fit, longest first; equal
lengths are treated together. The plan says which ranks of a length go where; the pieces then get
ranks within their length, in chunks, and look their places up.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import batch, lean, stored, utf8
from tidelog.llm.tokens import encoded

CHUNK = 5000  # pieces of a length that one task ranks, about


class Lengths:
    """A multiset of lengths with its distinct ones in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {w: n for w, n in counts.items() if n}
        self.order = sorted(self.count)

    def take(self, w: int, n: int) -> None:
        self.count[w] -= n
        if not self.count[w]:
            del self.count[w]
            self.order.pop(bisect.bisect_left(self.order, w))

    def most(self, limit: int, without: int) -> int | None:
        """The largest length up to limit, one of `without` being in use."""
        i = bisect.bisect_right(self.order, limit) - 1
        if i >= 0 and self.order[i] == without and self.count[without] < 2:
            i -= 1
        return self.order[i] if i >= 0 else None

    def smallest(self, n: int, without: int) -> list[int]:
        out: list[int] = []
        for w in self.order:
            out += [w] * min(n - len(out), self.count[w] - (w == without))
            if len(out) >= n:
                break
        return out

    def pairs(self, limit: int, without: int) -> list[tuple[int, int]]:
        """For each larger length of a pair up to limit, the best smaller one."""
        out = []
        for x in self.order:
            if x > limit or self.count[x] - (x == without) < 1:
                continue
            i = bisect.bisect_right(self.order, min(limit - x, x)) - 1
            while i >= 0:
                y = self.order[i]
                if self.count[y] - (y == without) - (y == x) >= 1:
                    out.append((x, y))
                    break
                i -= 1
        return out


def dominating(lengths: Lengths, w: int, capacity: int) -> list[int] | None:
    """Lengths that may be fixed together with w: no other set with w is better."""
    rest = capacity - w
    k = lengths.most(rest, w)
    if k is None:
        return []
    if k == rest:  # nothing fills the rest better than one piece that does so fully
        return [k]
    few = lengths.smallest(3, w)
    if len(few) < 2 or few[0] + few[1] > rest:  # no two fit, and k is the largest one
        return [k]
    if len(few) == 3 and sum(few) <= rest:
        return None
    pairs = lengths.pairs(rest, w)
    if max(x + y for x, y in pairs) <= k:  # any pair could stand where k stands
        return [k]
    x, y = max(pairs)
    if x == k and max(b for _, b in pairs) <= y:  # any one, any pair fits piece by piece
        return [x, y]
    return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, pieces of it)]) that hold all pieces."""
    lengths = Lengths(counts)
    done: list[tuple[int, list[tuple[int, int]], int]] = []  # number, pieces, room left

    def fix(number: int, pieces: list[int]) -> None:
        listed = [(p, pieces.count(p)) for p in sorted(set(pieces), reverse=True)]
        for p, n in listed:
            lengths.take(p, n * number)
        done.append((number, listed, capacity - sum(pieces)))

    below = capacity + 1
    while True:  # the longest first; one that cannot be reduced is passed over
        i = bisect.bisect_left(lengths.order, below) - 1
        if i < 0:
            break
        w = lengths.order[i]
        others = dominating(lengths, w, capacity)
        if others is None:
            below = w
            continue
        pieces = [w, *others]
        fix(min(lengths.count[p] // pieces.count(p) for p in pieces), pieces)

    room: dict[int, list[int]] = {}  # room left -> patterns
    sizes: list[int] = []

    def opened(at: int) -> None:
        left = done[at][2]
        if left:
            if left not in room:
                room[left] = []
                bisect.insort(sizes, left)
            room[left].append(at)

    for at in range(len(done)):
        opened(at)
    for w in sorted(lengths.count, reverse=True):
        n = lengths.count[w]
        while n:
            i = bisect.bisect_left(sizes, w)
            if i < len(sizes):
                left = sizes[i]
                at = room[left].pop()
                if not room[left]:
                    del room[left]
                    sizes.pop(i)
                number, pieces, _ = done[at]
            else:
                at, left, pieces, number = len(done), capacity, [], -(-n // (capacity // w))
                done.append((0, [], 0))
            each = left // w
            full = min(number, n // each)
            extra = min(n - full * each, each) if full < number else 0
            split = []
            if full:
                split.append((full, [*pieces, (w, each)], left - each * w))
            if extra:
                split.append((1, [*pieces, (w, extra)], left - extra * w))
            if number - full - bool(extra):
                split.append((number - full - bool(extra), pieces, left))
            n -= full * each + extra
            done[at] = split[0]
            opened(at)
            for more in split[1:]:
                done.append(more)
                opened(len(done) - 1)
    return [(number, pieces) for number, pieces, _ in done if number]


class Places:
    """The plan as arrays: where the pieces of a length go, by rank."""

    def __init__(self, patterns):
        rows, rank, base = [], {}, 0
        for number, pieces in patterns:
            offset = 0
            for w, each in pieces:
                first = rank.get(w, 0)
                rows.append((w << 44 | first, each, base, offset))
                rank[w] = first + number * each
                offset += w * each
            base += number
        rows.sort()
        self.key, self.each, self.base, self.offset = (
            np.array([r[i] for r in rows] or [0], np.int64) for i in range(4))
        self.sequences = base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length << 44 | rank
        at = np.searchsorted(self.key, key, "right") - 1
        nth, each = key - self.key[at], self.each[at]
        return self.base[at] + nth // each, self.offset[at] + nth % each * length


def pieces_of(docs: DataFrame, id: str, text: str, tokenizer: str, kind: str | None,
              end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each document's ids and the end id."""
    types = {"id": None, "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
             "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for b in batches:
            rows, at = [], []
            bodies = b.column(1)
            for i, ids in enumerate(encoded((bodies[j].as_buffer() for j in range(b.num_rows)), tokenizer, kind)):
                ids += end
                for p, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start:start + 4 * capacity]
                    rows.append((p, start // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
                    at.append(i)
            columns = list(zip(*rows)) if rows else [[]] * (len(types) - 1)
            yield batch({"id": b.column(0).take(pa.array(at, pa.int64())),
                         **dict(zip(list(types)[1:], columns))}, types)

    kind_sql = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), utf8(text).alias("b")).mapInArrow(
        lean(cut), f"id {kind_sql}, piece int, start long, length long, ids_crc32 long"
             + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text",
         kind: str | None = "words", end_id: int = 1, capacity: int = 4096,
         with_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of `capacity` tokens as it can.

    Returns one row per piece: the id, piece (from 0), start (ids of the document before it),
    length, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), sequence_id and
    offset (gapless from 0 in each sequence); with_ids adds the ids themselves. Only documents of
    more than `capacity` ids are cut. A null text is empty: its only id is the end id. Repeated
    rows are packed each. kind names how the tokenizer's words are cached (see tokens.Encoder).
    Other columns are not read.
    """
    pieces = stored(pieces_of(docs, id, text, tokenizer, kind, end_id, capacity, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in  # one row per length, `capacity` at most
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    chunks = max(1, sum(histogram.values()) // CHUNK)
    chunk = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(chunks)).alias("chunk")
    named = pieces.select("*", chunk)
    sizes = named.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                   "chunks")
    inside = Window.partitionBy("length", "chunk").orderBy("id", "piece")
    ranked = named.withColumn("nth", F.row_number().over(inside)).join(sizes, ["length", "chunk"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth") - 1)
    columns = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def put(batches):
        for b in batches:
            sequence, offset = places.of(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*columns, "sequence_id", "offset"])

    kinds = dict(pieces.dtypes)
    out = ranked.select(*columns, "rank").mapInArrow(
        put, ", ".join(f"{c} {kinds[c]}" for c in columns) + ", sequence_id long, offset long")
    return out.withColumnRenamed("id", id)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with_ids: the ids of each whole sequence as bytes."""
    types = {"sequence_id": pa.int64(), "ids": pa.binary()}

    def join(batches):
        for b in batches:
            yield batch({"sequence_id": b.column(0),
                         "ids": [b"".join(p["ids"] for p in parts) for parts in b.column(1).to_pylist()]}, types)

    parts = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.mapInArrow(join, "sequence_id long, ids binary")
