"""Phrases whose words keep together, found by best-first growth with bounds.

A phrase p with a occurrences scores floor(2000000 a / (l + r)) at its lowest-scoring cut into a
first part of l and a rest of r occurrences. Whatever is added behind p = w1..wk has at most a
occurrences and is cut behind w1 too, so no phrase that begins with p scores above

    bound(p) = floor(2000000 a / (f(w1) + a)).

The frontier holds the counted phrases whose continuations are not counted yet. Each round takes the
part of it with the greatest bounds, down to a threshold per language, and counts its
continuations; with them the phrases left of a contender that could contain it. A contender goes if
a phrase one word longer has 80 in 100 of its occurrences (a longer one that has them implies one
such in between). Once as many survive at the threshold as are asked for, no phrase outside can
reach them: the language is settled. Else the threshold falls and the next round opens more.

Counting starts with two scans of all texts that only narrow down: words with enough occurrences,
then pairs of such words by a 64-bit hash, which can only count too much. A third scan keeps the runs
of words whose pairs pass; every phrase that occurs often enough lies within them, and the counts that
decide are taken from the runs: equal phrases of a block are told by their 64-bit hash, and blocks and
tasks meet by text. The filters between scans have a fixed size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import LOWER, UPPER, batch, joined, lean, stored, utf8

LEAST = 30  # occurrences of a phrase
TOP = 2000  # phrases of a language, those of equal rank decided by count and text
SCALE = 2_000_000
NO_LANG = "und"
STEP = 2 << 20  # bytes of text that are split at a time
HELD = 1_200_000  # entries a task holds before it hands them on
RUN_BYTES = 32 << 20  # memory of the runs a task holds, about
SENT = 1 << 16  # rows of a batch handed on
W = ["w1", "w2", "w3", "w4"]
SPREAD = 64  # parts in which a language's phrases are ranked before they meet
FILTER_BITS = 1 << 26  # of each filter: 8 MiB, whatever the input
_BASE = 0x9E3779B97F4A7C15 | 1
_KINDS = np.zeros(256, np.uint8)  # 0 in a word, 1 blank, 2 end of a piece
_KINDS[[0x20, 0x09]] = 1
_KINDS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOW = np.arange(256, dtype=np.uint8)
_LOW[np.frombuffer(UPPER, np.uint8)] = np.frombuffer(LOWER, np.uint8)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, STEP + 1)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            line = np.full(size, base, np.uint64)
            line[0] = 1
            made.append(np.cumprod(line, dtype=np.uint64))
        _powers[:] = made
    return _powers[0], _powers[1]


def sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the bytes times their powers, up to each place, and the powers of the inverse."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    line = total[1:]
    line[:] = data
    line += np.uint64(1)
    line *= up[:len(data)]
    np.cumsum(line, out=line)
    return total, down


def sent(made: pa.RecordBatch):
    """A batch in parts of few rows, so that no side holds a large one."""
    for at in range(0, made.num_rows, SENT):
        yield made.slice(at, SENT)


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Of lowered texts end to end: each word's hash, start, end, and whether it follows the one
    before in the same piece."""
    kind = _KINDS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = kind == 0
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    total, down = sums(data)
    hashes = (total[ends] - total[starts]) * down[starts]
    del total
    hashes = joined(hashes, (ends - starts).astype(np.uint64))
    stops = np.flatnonzero((kind == 2) | edge[:-1])
    breaks = np.searchsorted(stops, starts, "right")
    follows = np.zeros(len(starts), bool)
    follows[1:] = breaks[1:] == breaks[:-1]
    return hashes, starts, ends, follows


def hashed(texts: list[bytes]) -> np.ndarray:
    """The hash of each of some words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    total, down = sums(data)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    return joined((total[ends] - total[starts]) * down[np.minimum(starts, len(down) - 1)], sizes.astype(np.uint64))


def blocks(batches):
    """(languages, which of them each text is of, lowered bytes, offsets) of some texts at a time.
    A long text is cut at ends of pieces, which no phrase crosses."""
    def made(held):
        names, which = np.unique(np.array([lang for lang, _ in held], object), return_inverse=True)
        sizes = [len(t) for _, t in held]
        data = _LOW[np.frombuffer(b"".join(t for _, t in held), np.uint8)]
        return list(names), which, data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    held, size = [], 0
    for b in batches:
        for lang, body in zip(b.column(0).to_pylist(), b.column(1)):
            raw, at = body.as_buffer(), 0
            while at < len(raw):
                end = min(len(raw), at + STEP)
                if end < len(raw):
                    stops = np.flatnonzero(_KINDS[np.frombuffer(raw[at:], np.uint8)[:STEP]] == 2)
                    if len(stops):
                        end = at + int(stops[-1]) + 1
                    else:
                        later = np.flatnonzero(_KINDS[np.frombuffer(raw[end:], np.uint8)] == 2)
                        end = end + int(later[0]) + 1 if len(later) else len(raw)
                held.append((lang, bytes(raw[at:end])))
                size += end - at
                at = end
                if size >= STEP:
                    yield made(held)
                    held, size = [], 0
    if held:
        yield made(held)


class Filter:
    """A Bloom filter of 64-bit keys, as bytes of a fixed size."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(keys: np.ndarray):
        shift = np.uint64(64 - FILTER_BITS.bit_length() + 1)
        for seed in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
            mixed = keys * np.uint64(seed)
            yield ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(_BASE)) >> shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for at in self.places(keys):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    @classmethod
    def of(cls, keys: DataFrame) -> DataFrame:
        """keys: one long column. Gives (slot, bits): the 64-bit words of the filter that are not 0."""
        def put(batches):
            for b in batches:
                key = b.column(0).to_numpy().view(np.uint64)
                at = np.unique(np.concatenate([np.empty(0, np.uint64), *cls.places(key)]))
                slot, first = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
                bits = np.uint64(1) << (at & np.uint64(63))
                bits = np.bitwise_or.reduceat(bits, first) if len(at) else bits
                yield batch({"slot": slot, "bits": bits.view(np.int64)}, {"slot": pa.int64(), "bits": pa.int64()})

        return keys.mapInArrow(lean(put), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))

    @classmethod
    def shipped(cls, keys: DataFrame):
        """The filter as a broadcast of FILTER_BITS / 8 bytes."""
        found = cls.of(keys).toArrow()
        line = np.zeros(FILTER_BITS // 64, np.uint64)
        line[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return keys.sparkSession.sparkContext.broadcast(line.view(np.uint8).tobytes())

    @classmethod
    def read(cls, shipped) -> Filter:
        return cls(np.frombuffer(shipped.value, np.uint8))


def seeds(names: list[str]) -> np.ndarray:
    return joined(hashed([n.encode() for n in names]), np.full(len(names), 77, np.uint64))


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, word, f): all occurrences of every word."""
    types = {"lang": pa.string(), "word": pa.binary(), "f": pa.int64()}

    def emit(held):
        return batch({"lang": [lang for lang, _ in held], "word": [w for _, w in held], "f": list(held.values())}, types)

    def count(batches):
        held: dict[tuple[str, bytes], int] = {}
        for names, which, data, offsets in blocks(batches):
            hashes, starts, ends, _ = words_of(data, offsets)
            of = which[np.searchsorted(offsets, starts, "right") - 1]
            keys = joined(hashes, seeds(names)[of])
            _, first, number = np.unique(keys, return_index=True, return_counts=True)
            raw = data.tobytes()
            for lang, s, e, n in zip(of[first].tolist(), starts[first].tolist(), ends[first].tolist(), number.tolist()):
                key = (names[lang], raw[s:e])
                held[key] = held.get(key, 0) + n
            if len(held) > HELD // 8:
                yield from sent(emit(held))
                held = {}
        if held:
            yield from sent(emit(held))

    found = texts.mapInArrow(lean(count), "lang string, word binary, f long")
    return found.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("f").alias("f"))


def chained(hashes: list[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """The key of phrases, given the hashes of their first, second .. words."""
    key = hashes[0]
    for more in hashes[1:]:
        key = joined(key, more)
    return joined(key, seed)


def phrase_keys(phrases: DataFrame, columns: list[str]) -> DataFrame:
    def key(batches):
        for b in batches:
            if b.num_rows:
                names, which = np.unique(np.array(b.column(0).to_pylist(), object), return_inverse=True)
                found = chained([hashed(c.to_pylist()) for c in b.columns[1:]], seeds(list(names))[which])
                yield batch({"key": found.view(np.int64)}, {"key": pa.int64()})

    return phrases.select("lang", *(F.col(c).cast("binary").alias(c) for c in columns)).mapInArrow(lean(key), "key long")


def pair_keys(hashes: np.ndarray, follows: np.ndarray, seed: np.ndarray, words: Filter) -> tuple[np.ndarray, np.ndarray]:
    """The words that follow another in their piece, both being often enough, and their pairs' keys."""
    often = words(joined(hashes, seed))
    at = np.flatnonzero(follows[1:] & often[1:] & often[:-1]) + 1
    return at, chained([hashes[at - 1], hashes[at]], seed[at])


def count_pairs(texts: DataFrame, words, least: int) -> DataFrame:
    """(key): hashes of pairs with at least that many occurrences."""
    types = {"key": pa.int64(), "n": pa.int64()}

    def count(batches):
        passes = Filter.read(words)
        held, size = [], 0

        def emit():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return batch({"key": keys.view(np.int64), "n": n.astype(np.int64)}, types)

        for names, which, data, offsets in blocks(batches):
            hashes, starts, _, follows = words_of(data, offsets)
            seed = seeds(names)[which[np.searchsorted(offsets, starts, "right") - 1]]
            held.append(pair_keys(hashes, follows, seed, passes)[1])
            size += len(held[-1])
            if size > HELD:
                yield from sent(emit())
                held, size = [], 0
        if held:
            yield from sent(emit())

    found = texts.mapInArrow(lean(count), "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key")


def find_runs(texts: DataFrame, words, pairs) -> DataFrame:
    """(lang, run, m): the longest stretches of words of which every two neighbours may be a pair
    with enough occurrences, joined by blanks, and how often each stands in the texts."""
    types = {"lang": pa.string(), "run": pa.binary(), "m": pa.int64()}

    def emit(held):
        return batch({"lang": [lang for lang, _ in held], "run": [r for _, r in held], "m": list(held.values())}, types)

    def find(batches):
        passes, paired = Filter.read(words), Filter.read(pairs)
        held: dict[tuple[str, bytes], int] = {}
        size = 0
        for names, which, data, offsets in blocks(batches):
            hashes, starts, ends, follows = words_of(data, offsets)
            of = which[np.searchsorted(offsets, starts, "right") - 1]
            at, keys = pair_keys(hashes, follows, seeds(names)[of], passes)
            kept = np.zeros(len(starts) + 1, bool)
            kept[at[paired(keys)]] = True
            opens = np.flatnonzero(kept[1:] & ~kept[:-1])
            closes = np.flatnonzero(kept[:-1] & ~kept[1:])
            raw = data.tobytes()
            for lang, s, e in zip(of[opens].tolist(), starts[opens].tolist(), ends[closes].tolist()):
                run = raw[s:e]
                if b"\t" in run or b"  " in run:
                    run = b" ".join(run.split())
                key = (names[lang], run)
                if key not in held:
                    size += len(run) + 200
                held[key] = held.get(key, 0) + 1
            if size > RUN_BYTES:
                yield from sent(emit(held))
                held, size = {}, 0
        if held:
            yield from sent(emit(held))

    found = texts.mapInArrow(lean(find), "lang string, run binary, m long")
    return found.groupBy("lang", F.col("run").cast("string").alias("run")).agg(F.sum("m").alias("m"))


def counted(runs: DataFrame, size: int, least: int, opened=None) -> DataFrame:
    """(lang, w1.., a): phrases of that many words in the runs with at least so many occurrences;
    with a filter only those of which the words but the last one may be in it."""
    types = {"lang": pa.string(), "phrase": pa.binary(), "m": pa.int64()}

    def count(batches):
        passes = None if opened is None else Filter.read(opened)
        held: dict[tuple[str, bytes], int] = {}

        def emit():
            return batch({"lang": [k[0] for k in held], "phrase": [k[1] for k in held], "m": list(held.values())}, types)

        for b in batches:
            times = b.column(2).to_numpy()
            done = 0
            for names, which, data, offsets in blocks([b.select([0, 1])]):
                hashes, starts, ends, _ = words_of(data, offsets)
                of = np.searchsorted(offsets, starts, "right") - 1
                n = len(starts) - size + 1
                if n > 0:
                    at = np.flatnonzero(of[:n] == of[size - 1:])
                    seed = seeds(names)[which]
                    if passes is not None:
                        at = at[passes(chained([hashes[at + k] for k in range(size - 1)], seed[of[at]]))]
                    keys = chained([hashes[at + k] for k in range(size)], seed[of[at]])
                    _, first, back = np.unique(keys, return_index=True, return_inverse=True)
                    total = np.zeros(len(first), np.int64)
                    np.add.at(total, back, times[done + of[at]])
                    raw, at = data.tobytes(), at[first]
                    for lang, s, e, m in zip(which[of[at]].tolist(), starts[at].tolist(),
                                             ends[at + size - 1].tolist(), total.tolist()):
                        key = (names[lang], raw[s:e])
                        held[key] = held.get(key, 0) + m
                done += len(offsets) - 1
                if len(held) > HELD // 8:
                    yield from sent(emit())
                    held = {}
        if held:
            yield from sent(emit())

    found = runs.select("lang", F.col("run").cast("binary"), "m").mapInArrow(lean(count), "lang string, phrase binary, m long")
    found = found.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("m").alias("a")).where(
        F.col("a") >= least)
    words = F.split("phrase", " ")
    return found.select("lang", *(words[k].alias(W[k]) for k in range(size)), "a")


def ratio(a: Column, below: Column) -> Column:
    """floor(SCALE a / below), exactly: the product may pass 64 bits."""
    whole = a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)")
    below = below.cast("decimal(20,0)")
    return ((whole - whole % below) / below).cast("long")


def lowest(phrases: DataFrame, cuts: list[tuple[Column, Column]]) -> DataFrame:
    """phrases with l, r and score of the lowest-scoring cut, the first of equal ones; and bound."""
    rated = F.array_min(F.array(*(
        F.struct(ratio(F.col("a"), left + right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
        for k, (left, right) in enumerate(cuts))))
    made = phrases.withColumn("cut", rated)
    return made.select("lang", *(c for c in W if c in phrases.columns), "a", "f1", F.col("cut.l").alias("l"),
                       F.col("cut.r").alias("r"), F.col("cut.score").alias("score"),
                       ratio(F.col("a"), F.col("f1") + F.col("a")).alias("bound"))


def renamed(table: DataFrame, names: list[str], count: str) -> DataFrame:
    """A table of phrases under other word columns, with its count only."""
    old = [c for c in W if c in table.columns]
    return table.select("lang", *(F.col(o).alias(n) for o, n in zip(old, names)), F.col("a").alias(count))


def rated(table: DataFrame, size: int, words: DataFrame, two: DataFrame | None, three: DataFrame | None) -> DataFrame:
    """Counted phrases of a size with their cuts; every part of a phrase is as frequent, so all joins find it."""
    def word(at, name):
        return words.select("lang", F.col("word").alias(at), F.col("f").alias(name))

    made = table.join(word("w1", "f1"), ["lang", "w1"]).join(word(W[size - 1], "fz"), ["lang", W[size - 1]])
    f1, fz = F.col("f1"), F.col("fz")
    if size == 2:
        return lowest(made, [(f1, fz)])
    if size == 3:
        made = made.join(renamed(two, ["w2", "w3"], "rest"), ["lang", "w2", "w3"])
        made = made.join(renamed(two, ["w1", "w2"], "first"), ["lang", "w1", "w2"])
        return lowest(made, [(f1, F.col("rest")), (F.col("first"), fz)])
    made = made.join(renamed(three, ["w2", "w3", "w4"], "rest"), ["lang", "w2", "w3", "w4"])
    made = made.join(renamed(three, ["w1", "w2", "w3"], "first"), ["lang", "w1", "w2", "w3"])
    made = made.join(renamed(two, ["w1", "w2"], "front"), ["lang", "w1", "w2"])
    made = made.join(renamed(two, ["w3", "w4"], "back"), ["lang", "w3", "w4"])
    return lowest(made, [(f1, F.col("rest")), (F.col("front"), F.col("back")), (F.col("first"), fz)])


def much(longer: Column, of: Column) -> Column:
    """100 longer >= 80 of, without a product that could pass 64 bits early."""
    return F.lit(5).cast("decimal(2,0)") * longer.cast("decimal(20,0)") >= F.lit(4).cast("decimal(2,0)") * of.cast("decimal(20,0)")


def left_of(contenders: DataFrame, shorter: DataFrame, size: int) -> DataFrame:
    """The phrases of `size` words (x, c1, ..) that could begin one containing a contender c1.. with
    most of its occurrences."""
    inner = W[:size - 1]
    need = contenders.groupBy("lang", *inner).agg(F.min("a").alias("need")).select(
        "lang", *(F.col(c).alias(n) for c, n in zip(inner, W[1:size])), "need")
    return shorter.join(need, ["lang", *W[1:size]]).where(much(F.col("a"), F.col("need"))).select("lang", *W[:size])


def dropped(table: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """table without the phrases that a phrase one word longer holds with most of their occurrences."""
    own = ["lang", *W[:size]]
    front = longer.select(*own, F.col("a").alias("longer"))
    back = longer.select("lang", *(F.col(c).alias(n) for c, n in zip(W[1:size + 1], W[:size])), F.col("a").alias("longer"))
    most = front.unionByName(back).groupBy(*own).agg(F.max("longer").alias("longer"))
    return table.join(most, own, "left").where(
        F.col("longer").isNull() | ~much(F.col("longer"), F.col("a"))).drop("longer")


def first_of(table: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows of each language with their rank. Ranked in parts first, so that only the
    first of each part meet in one task."""
    part = Window.partitionBy("lang", "part").orderBy(*order)
    parts = table.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).withColumn(
        "rank", F.row_number().over(part)).where(F.col("rank") <= most)
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= most).drop("part")


def union(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """Per language the first `top` phrases of two to four words by score, then count descending, then
    text: (lang, rank, phrase, a, l, r, n, score), n being all words of the language.

    Letters A-Z are lowered; a phrase lies between ends of pieces `[.,;:!?]` and line ends, and its
    words between blanks and tabs. A null language is `und`, a null text empty. Repeated rows count
    each. A language without a phrase of `least` occurrences has no row. Other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), utf8(text).alias("b"))
    every = stored(count_words(texts), "words")
    sizes = stored(every.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    words = stored(every.where(F.col("f") >= least), "often")
    often = Filter.shipped(phrase_keys(words, ["word"]))
    pairs = Filter.shipped(stored(count_pairs(texts, often, least), "pairs"))
    runs = stored(find_runs(texts, often, pairs), "runs")

    two = stored(rated(counted(runs, 2, least), 2, words, None, None), "two")
    three = stored(rated(counted(runs.limit(0), 3, least), 3, words, two, None), "three")
    four = stored(rated(counted(runs.limit(0), 4, least), 4, words, two, three), "four")
    open2, open3 = two.select("lang", "w1", "w2").limit(0), three.select("lang", *W[:3]).limit(0)
    settled = two.select("lang", F.col("score").alias("least")).limit(0)
    taken = 2 * top
    while True:
        # The threshold of each open language: that of its next best known phrases.
        known = union([two, three, four]).select("lang", "score", F.concat_ws(" ", *W).alias("phrase")).join(
            settled, "lang", "left_anti")
        best = first_of(known, [F.desc("score")], taken)
        least_of = stored(best.groupBy("lang").agg(
            F.when(F.count("*") >= taken, F.min("score")).otherwise(F.lit(-1)).alias("least")), "least")

        def above(table, column):
            return table.join(least_of, "lang").where(F.col(column) >= F.col("least")).drop("least")

        def grown(size, wanted, opened, table):
            """The table with the continuations of the wanted phrases that were not opened before."""
            part = ["lang", *W[:size - 1]]
            new = stored(wanted.select(*part).distinct().join(opened, part, "left_anti"), "open")
            opening = Filter.shipped(phrase_keys(new, part[1:]))
            more = counted(runs, size, least, opening).join(new, part, "left_semi")
            known = table.unionByName(rated(stored(more, "more"), size, words, two,
                                            three if size > 3 else None))
            return stored(opened.unionByName(new), "opened"), stored(known, f"known{size}")

        open2, three = grown(3, union([above(two, "bound"), left_of(above(two, "score"), two, 2)]), open2, three)
        tails = above(three, "bound").select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"))
        open2, three = grown(3, union([tails, left_of(above(three, "score"), two, 2)]), open2, three)
        open3, four = grown(4, union([above(three, "bound"), left_of(above(three, "score"), three, 3)]), open3, four)
        left = stored(union([dropped(above(two, "score"), three, 2), dropped(above(three, "score"), four, 3),
                             above(four, "score")]), "left")
        enough = left.groupBy("lang").agg(F.count("*").alias("k")).join(least_of, "lang", "right").where(
            (F.col("least") < 0) | (F.col("k") >= top)).select("lang", "least")
        settled = stored(settled.unionByName(enough), "settled")
        if two.join(settled, "lang", "left_anti").isEmpty():
            break
        taken *= 2

    survivors = union([dropped(two, three, 2), dropped(three, four, 3), four]).join(settled, "lang").where(
        F.col("score") >= F.col("least"))
    ranked = first_of(survivors.withColumn("phrase", F.concat_ws(" ", *W)),
                      [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
