"""Token ids in files with keyed access through a minimal perfect hash.

A store is a folder of Parquet files that Spark writes, so a lost executor's files are written
anew. Each row is one shard, a range of keys in ascending order: the raw payload of ids, the keys,
the place of each document in the payload, and an index. The index is a minimal perfect hash of
the shard's keys (levels of bits: a key sits at the first level where no other key shares its
bit; its number is the count of bits before it), which gives a slot; the slot holds a fingerprint
of the key and the document's number. A lookup takes a constant number of steps; an unknown key
fails the fingerprint or, in the end, the stored key.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import MULTIPLY, SCRAMBLE, batch, utf8
from tidelog.llm.tokens import encoded

SHARD_IDS = 4_000_000  # ids of a shard, after which the next one begins
PART_BYTES = 32 << 20  # text of a range partition, about


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = (keys ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * MULTIPLY
    x ^= x >> np.uint64(32)
    x *= SCRAMBLE
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # one array of 0 and 1 per level
        self.before = []
        total = 0
        for bits in levels:
            self.before.append(total + np.concatenate([[0], np.cumsum(bits)[:-1]]))
            total += int(bits.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = 2 * len(keys) + 1
            at = (mixed(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            single = np.bincount(at, minlength=size) == 1
            levels.append(single.astype(np.uint8))
            keys = keys[~single[at]]
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of an unknown one any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        open_keys = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (mixed(keys[open_keys], level + 1) % np.uint64(len(bits))).astype(np.int64)
            on = bits[at] == 1
            out[open_keys[on]] = self.before[level][at[on]]
            open_keys = open_keys[~on]
            if not len(open_keys):
                break
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<I", len(self.levels)) + b"".join(struct.pack("<Q", len(x)) for x in self.levels)
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = struct.unpack_from("<I", raw)[0]
        sizes, at, levels = struct.unpack_from(f"<{n}Q", raw, 4), 4 + 8 * n, []
        for size in sizes:
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at))[:size])
            at += width
        return cls(levels)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 9001) >> np.uint64(32)).astype("<u4")


class Shard:
    """Read access to one row of a store."""

    def __init__(self, row: dict):
        self.hash = PerfectHash.from_bytes(row["hash"])
        self.prints = np.frombuffer(row["prints"], "<u4")
        self.first = np.frombuffer(row["first"], "<u4")  # slot -> number of the key's first document
        self.keys = np.frombuffer(row["keys"], "<u8")  # 64-bit key of each document, in order
        self.starts = np.frombuffer(row["starts"], "<u8")
        self.ids = np.frombuffer(row["payload"], row["dtype"])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of the first document of each key, or -1."""
        if not self.hash.size:
            return np.full(len(keys), -1, np.int64)
        slot = self.hash.find(keys)
        number = self.first[slot].astype(np.int64)
        ok = (slot >= 0) & (self.prints[slot] == fingerprint(keys))
        ok[ok] = self.keys[number[ok]] == keys[ok]
        return np.where(ok, number, -1)

    def document(self, number: int) -> np.ndarray:
        return self.ids[int(self.starts[number]):int(self.starts[number + 1])].astype("<u4")


ROW_SQL = ("part int, shard int, n_docs long, n_ids long, dtype string, payload binary, starts binary, "
           "keys binary, hash binary, prints binary, first binary")
ROW = {"part": pa.int32(), "shard": pa.int32(), "n_docs": pa.int64(), "n_ids": pa.int64(),
       "dtype": pa.string(), **dict.fromkeys(("payload", "starts", "keys", "hash", "prints", "first"), pa.binary())}


def key64(id: str):
    """The 64-bit key of an id; a null id is a key of its own."""
    return F.xxhash64(F.col(id).cast("string"), F.col(id).isNull())


def write_store(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text",
                kind: str | None = "bytes", end_id: int = 0, dtype: str = "<u2",
                shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of every document, and the end id, to a store in ascending order of the id.

    dtype is the width of the payload; ids that do not fit raise an error. Documents with one id
    lie side by side, in the order of a hash of their texts, and share an index entry; rows
    without an id come first. A null text is empty.
    """
    rows = docs.select(F.col(id).alias("id"), utf8(text).alias("b"))
    size = rows.agg(F.sum(F.length("b"))).first()[0] or 0
    tie = F.xxhash64("b").alias("tie")
    parts = rows.select("id", tie, key64("id").alias("key"), "b").repartitionByRange(
        max(1, -(-size // PART_BYTES)), "id", "tie").sortWithinPartitions("id", "tie")
    limit = np.iinfo(np.dtype(dtype)).max
    kind_sql = docs.schema[id].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names, keys, total = [], [], 0

        def shard():
            k = np.array(keys, np.uint64)
            _, at = np.unique(k, return_index=True)
            at = np.sort(at)
            phf = PerfectHash.build(k[at])
            slot = phf.find(k[at])
            first, prints = np.empty(len(at), "<u4"), np.empty(len(at), "<u4")
            first[slot], prints[slot] = at, fingerprint(k[at])
            starts = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype("<u8")
            row = batch({"part": [part], "shard": [number], "n_docs": [len(k)], "n_ids": [total],
                         "dtype": [dtype], "payload": [np.concatenate(held).tobytes()],
                         "starts": [starts.tobytes()], "keys": [k.astype("<u8").tobytes()],
                         "hash": [phf.to_bytes()], "prints": [prints.tobytes()], "first": [first.tobytes()]}, ROW)
            listed = pa.ListArray.from_arrays(pa.array([0, len(k)], pa.int32()), pa.concat_arrays(names))
            return pa.RecordBatch.from_arrays([*row.columns, listed], names=[*ROW, "ids"])

        for b in batches:
            bodies, key = b.column(3), b.column(2).to_numpy().view(np.uint64)
            begun = 0
            for i, raw in enumerate(encoded((bodies[j].as_buffer() for j in range(b.num_rows)), tokenizer, kind)):
                ids = np.frombuffer(raw + end, "<u4")
                if len(ids) and int(ids.max()) > limit:
                    raise ValueError(f"an id does not fit {dtype}")
                held.append(ids.astype(dtype))
                keys.append(key[i])
                total += len(ids)
                if total >= shard_ids:
                    names.append(b.column(0).slice(begun, i + 1 - begun))
                    yield shard()
                    held, names, keys, total, begun, number = [], [], [], 0, i + 1, number + 1
            if begun < b.num_rows:
                names.append(b.column(0).slice(begun))
        if held:
            yield shard()

    parts.select("id", "tie", "key", "b").mapInArrow(
        shards, f"{ROW_SQL}, ids array<{kind_sql}>").write.parquet(path)


def read_store(spark: SparkSession, path: str, id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every document of a store, each found through its shard's index: the id, start (ids of all
    documents before it), n_tokens and ids_crc32 (as little-endian unsigned 32-bit integers), and
    the ids themselves if asked for."""
    store = spark.read.parquet(path)
    kind_sql = store.schema["ids"].dataType.elementType.simpleString()
    types = {"part": pa.int32(), "shard": pa.int32(), "id": None, "at": pa.int64(), "n_tokens": pa.int64(),
             "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})

    def read(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in ROW}
                shard, names = Shard(row), b.column("ids")[r].values
                first = shard.find(shard.keys)
                if (first < 0).any():
                    raise ValueError("a key of the store is not in its index")
                new = np.concatenate([[True], first[1:] != first[:-1]])
                nth = np.arange(len(first)) - np.maximum.accumulate(np.where(new, np.arange(len(first)), 0))
                rows = []
                for number in (first + nth).tolist():
                    ids = shard.document(number).tobytes()
                    rows.append((int(shard.starts[number]), len(ids) // 4, zlib.crc32(ids), *([ids] if with_ids else [])))
                columns = list(zip(*rows)) if rows else [[]] * (len(types) - 3)
                yield batch({"part": np.full(len(first), row["part"], np.int32),
                             "shard": np.full(len(first), row["shard"], np.int32), "id": names,
                             **dict(zip(list(types)[3:], columns))}, types)

    docs = store.mapInArrow(read, f"part int, shard int, id {kind_sql}, at long, n_tokens long, ids_crc32 long"
                                  + (", ids binary" if with_ids else ""))
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    before = store.select("part", "shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    found = docs.join(before, ["part", "shard"])
    return found.select(F.col("id").alias(id), (F.col("before") + F.col("at")).alias("start"), "n_tokens",
                        "ids_crc32", *(["ids"] if with_ids else []))


def lookup(store_path: str, wanted: DataFrame, id: str = "doc_id") -> DataFrame:
    """The documents with the wanted ids: the id and its ids. An id that is not in the store has
    no row; one that several documents share has a row for each of them."""
    spark = wanted.sparkSession
    store = spark.read.parquet(store_path)
    kind_sql = wanted.schema[id].dataType.simpleString()
    # Where a key is, by the keys alone: the payload is read by the shards that are asked.
    own = store.select("part", "shard", F.explode("ids").alias("id"))
    asked = wanted.select(F.col(id).alias("id")).distinct()
    hits = own.join(asked, own["id"].eqNullSafe(asked["id"])).select("part", "shard", own["id"]).distinct()
    lists = hits.groupBy("part", "shard").agg(
        F.collect_list(F.struct("id", key64("id").alias("key"))).alias("asked"))
    types = {"id": None, "ids": pa.binary()}

    def read(batches):
        for b in batches:
            for r in range(b.num_rows):
                shard = Shard({c: b.column(c)[r].as_py() for c in ROW})
                listed = b.column("asked")[r].values
                keys = listed.field("key").to_numpy().view(np.uint64)
                take, ids = [], []
                for i, number in enumerate(shard.find(keys).tolist()):
                    while number >= 0 and number < len(shard.keys) and shard.keys[number] == keys[i]:
                        take.append(i)
                        ids.append(shard.document(number).tobytes())
                        number += 1
                yield batch({"id": listed.field("id").take(pa.array(take, pa.int64())), "ids": ids}, types)

    found = store.join(lists, ["part", "shard"]).mapInArrow(read, f"id {kind_sql}, ids binary")
    return found.withColumnRenamed("id", id)
