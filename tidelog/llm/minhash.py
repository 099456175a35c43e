"""Near-duplicates by MinHash signatures, joined through an inverted index of coordinates.

Texts with equal shingle sets form one class at once; all that follows works on classes. A class
is posted under coordinates of its signature with their values, three coordinates to a posting: a
single value is shared by most texts that hold one common shingle, and lists by it would tie
together what has nothing in common. Classes that agree in a posting are candidates; of those,
pairs that agree in at least `matches` of all coordinates are compared by their full sets.

Listing all pairs of a posting list would square the size of its groups. Instead every list names
one member, the others are compared with it, and confirmed links merge their groups; lists whose
members are all in one group are skipped from then on. After two such turns, lists that still hold
several groups are searched in tiles: the members of all but the largest group ask, all members
answer. That is done list by list over a byte of each coordinate, and only members that agree with
one of another group are compared by their sets, again in tiles: most lists are shared by chance,
and joining groups by lists alone would in the end tie all classes together. At a similarity of 0.8
two classes share no posting with a probability of 3e-7 and fall short of the matches with one of
1e-7.
"""

from __future__ import annotations

import contextlib
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import batch, flat, give_back, joined, lean, stored, utf8

COORDINATES = 63
POSTED = 3  # coordinates of a posting
MATCHES = 30
_seeds = np.random.Generator(np.random.PCG64(20240501))
FACTORS = _seeds.integers(0, 2**64, COORDINATES, np.uint64, endpoint=False) | np.uint64(1)
TERMS = _seeds.integers(0, 2**64, COORDINATES, np.uint64, endpoint=False)
STEP = 4096  # shingles that are hashed at once
TURNS = 2  # rounds in which a list's members are compared with one of them
FEW = 500_000  # rows of numbers that may be broadcast
TILE, TILE_BYTES = 1000, 24 << 20  # sets on a side of a tile, and about their bytes
BUNDLE = 20_000  # members of lists that are searched at once
CELLS = 4 << 20  # coordinates that are compared at once
# What a stored table has shuffled is of no use behind it; else it stays until the driver happens to collect garbage.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shingle_set(body: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingles, as 64-bit hashes, of the words `[^\\x20\\x09-\\x0D]+` after
    lowering A-Z. A text of fewer words is one shingle; one without words has none."""
    w = body.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = min(words, len(h))
    n = len(h) - k + 1
    s = h[:n] + np.uint64(k)
    for i in range(1, k):
        s = joined(s, h[i:i + n])
    return np.unique(s)


def signature(s: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), STEP):
        x = np.multiply.outer(FACTORS, s[i:i + STEP])
        x += TERMS[:, None]
        np.minimum(low, x.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def keyed(docs: DataFrame, id: str, text: str) -> list:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    i = F.coalesce(F.col(id).cast("string"), F.lit("null"))
    return [F.xxhash64(i, t).alias("k1"), F.xxhash64(t, F.lit(7), i).alias("k2")]


def signed(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(k1, k2, id, n, c, sig) of each row: key, id, size of the set, its digest, signature."""
    types = {"k1": pa.int64(), "k2": pa.int64(), "id": None, "n": pa.int64(), "c": pa.binary(),
             "sig": pa.list_(pa.int32())}

    def sign(batches):
        for b in batches:
            data, offsets = flat(b.column(3))
            raw, size, digest, sig = data.tobytes(), [], [], []
            for i in range(b.num_rows):
                s = shingle_set(raw[offsets[i]:offsets[i + 1]], words)
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(signature(s))
            flat_sig = np.concatenate(sig) if sig else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, len(flat_sig) + 1, COORDINATES, dtype=np.int32)), pa.array(flat_sig))
            yield batch({"k1": b.column(0), "k2": b.column(1), "id": b.column(2), "n": size,
                         "c": digest, "sig": lists}, types)

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(*keyed(docs, id, text), F.col(id).alias("id"), utf8(text).alias("b"))
    return rows.mapInArrow(
        lean(sign), f"k1 long, k2 long, id {kind}, n long, c binary, sig array<int>")


def postings(classes: DataFrame) -> DataFrame:
    """(e, r, n): each class under the postings that other classes share."""
    def posting(i):
        return F.xxhash64(i, *[F.get("sig", i * POSTED + k) for k in range(POSTED)])

    numbers = F.sequence(F.lit(0), F.lit(COORDINATES // POSTED - 1))
    elements = classes.select("r", "n", F.explode(F.transform(numbers, posting)).alias("e"))
    shared = stored(elements.groupBy("e").agg(F.count("*").alias("f")).where("f > 1").select("e"), "shared-values")
    return stored(elements.join(shared, "e").select("e", "r", "n"), "postings")


def sketch() -> Column:
    """A byte of each coordinate: equal where the coordinates are, and by chance once in 256."""
    return F.transform("sig", lambda x: (F.pmod(x, F.lit(256)) - 128).cast("tinyint")).alias("sketch")


def full_sets(docs: DataFrame, classes: DataFrame, listed: DataFrame, id: str, text: str,
              words: int) -> DataFrame:
    """(r, sketch, shingles) of the classes that have postings."""
    types = {"r": pa.int64(), "sketch": pa.list_(pa.int8()), "shingles": pa.binary()}

    def make(batches):
        for b in batches:
            data, offsets = flat(b.column(2))
            raw = data.tobytes()
            sets = [shingle_set(raw[offsets[i]:offsets[i + 1]], words).tobytes() for i in range(b.num_rows)]
            yield batch({"r": b.column(0), "sketch": b.column(1), "shingles": sets}, types)

    wanted = classes.join(listed.select("r").distinct(), "r", "left_semi").select("r", sketch(), "at.*")
    texts = docs.select(*keyed(docs, id, text), utf8(text).alias("b"))
    found = texts.join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"])  # equal rows of the table
    return stored(found.select("r", "sketch", "b").mapInArrow(
        lean(make), "r long, sketch array<tinyint>, shingles binary"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, z) that agree in enough coordinates and whose sets are similar enough."""
    one = sets.select(F.col("r").alias("a"), F.col("sketch").alias("sketch_a"))
    two = sets.select(F.col("r").alias("z"), F.col("sketch").alias("sketch_z"))
    equal = F.aggregate(F.zip_with("sketch_a", "sketch_z", lambda x, y: (x == y).cast("int")),
                        F.lit(0), lambda s, x: s + x)
    close = stored(pairs.join(one, "a").join(two, "z").where(equal >= matches).select("a", "z"), "close")
    asked = stored(close.select("a", "z", F.explode(F.array("a", "z")).alias("r")), "asked")

    def compare(batches):
        for b in batches:
            kept = []
            for pair in b.column(2):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in pair.values)
                both = len(x) + len(y) - len(np.union1d(x, y))
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)],
                                             names=["a", "z"])

    pair = with_sets(asked, sets.select("r", "shingles")).groupBy("a", "z").agg(
        F.collect_list("shingles").alias("pair"))
    return pair.mapInArrow(lean(compare), "a long, z long")


def with_sets(asked: DataFrame, sets: DataFrame) -> DataFrame:
    """asked, a stored table, with the sets of its `r`. Few rows, by a count, go to where the sets are."""
    if asked.count() <= FEW:
        asked = F.broadcast(asked)
    return sets.join(asked, "r")


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups (r, g) after linked groups have become one, named by the smallest."""
    g = groups.select("r", "g")
    a = g.select(F.col("r").alias("a"), F.col("g").alias("x"))
    z = g.select(F.col("r").alias("z"), F.col("g").alias("y"))
    edges = links.join(a, "a").join(z, "z").where("x <> y").select("x", "y")
    both = stored(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    label = stored(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("l")), "labels")
    while True:
        near = both.join(label.select(F.col("x").alias("y"), "l"), "y").groupBy("x").agg(F.min("l").alias("m"))
        step = label.join(near, "x").select("x", F.least("l", "m").alias("l"), F.col("l").alias("was"))
        step = stored(step, "labels")
        jump = step.select(F.col("x").alias("l"), F.col("l").alias("ll"))
        label = stored(step.join(jump, "l").select("x", F.least("l", "ll").alias("l"), "was"), "labels")
        if label.where("l <> was").isEmpty():
            break
    named = label.select(F.col("x").alias("g"), "l")
    return stored(g.join(named, "g", "left").select("r", F.coalesce("l", "g").alias("g")), "groups")


def grouped(listed: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """(r, g): the group of each class that has postings."""
    groups = stored(listed.select("r").distinct().select("r", F.col("r").alias("g")), "groups")
    for turn in range(TURNS + 1):
        posts = stored(listed.join(groups, "r"), "grouped-postings")
        rank = F.xxhash64("r", F.lit(turn)) if turn == 0 else F.xxhash64("r", "e", F.lit(turn))
        shares = posts.groupBy("e", "g").agg(
            F.count("*").alias("c"), F.min(F.struct(rank.alias("rank"), "r", "n")).alias("p"))
        # From the second turn on a list's largest group speaks for it, so that the few members of
        # other groups are compared and not the many.
        size = F.lit(0) if turn == 0 else -F.col("c")
        heads = shares.groupBy("e").agg(
            F.count("*").alias("groups"), F.sum("c").alias("all"),
            F.min(F.struct(size.alias("size"), "p.rank", "p.r", "p.n", "g")).alias("p"))
        # The first turn has compared both members of a list of two.
        live = stored(heads.where("groups > 1").where(F.col("all") > (1 if turn == 0 else 2)).select(
            "e", F.col("p.r").alias("r2"), F.col("p.n").alias("n2"), F.col("p.g").alias("g2")), "heads")
        if live.isEmpty():
            return groups
        if turn == TURNS:
            links = rest(groups, posts.join(live.select("e"), "e"), sets, matches, percent)
        else:  # sizes alone rule out a pair whose smaller set is less than the share of the larger
            across = posts.join(live, "e").where("g <> g2")
            pairs = across.where(f"100 * least(n, n2) >= {percent} * greatest(n, n2)").select(
                F.least("r", "r2").alias("a"), F.greatest("r", "r2").alias("z")).distinct()
            links = confirmed(pairs, sets, matches, percent)
        groups = merged(groups, stored(links, "links"))
    return groups


def tiled(member: DataFrame, key: str, side: Column) -> DataFrame:
    """Members (key, r, n, g) of the keys that hold several groups, dealt over tiles (key, i, j) of
    about `side` members a side.

    All members are dealt over the rows of a key's tiles; those of all but its largest group are
    `few` and dealt over the columns too, where they ask.
    """
    parts = member.groupBy(key, "g").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    whole = parts.groupBy(key).agg(
        F.sum("c").alias("all"), F.sum("n").alias("n"), F.count("*").alias("groups"),
        F.max(F.struct("c", "g")).alias("top")).where("groups > 1")
    whole = stored(whole.select(key, F.col("top.g").alias("top"), F.ceil(F.col("all") / side).alias("rows"),
                                F.ceil((F.col("all") - F.col("top.c")) / side).alias("cols")), "tiles")
    put = member.join(whole, key).withColumn("few", F.col("g") != F.col("top"))

    def spread(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    targets = put.select(key, "r", "n", "g", "few", F.lit(False).alias("asks"),
                         F.pmod(F.xxhash64("r"), F.col("rows")).alias("i"), spread("cols").alias("j"))
    asking = put.where("few").select(key, "r", "n", "g", "few", F.lit(True).alias("asks"), spread("rows").alias("i"),
                                     F.pmod(F.xxhash64("r", F.lit(1)), F.col("cols")).alias("j"))
    return stored(targets.unionByName(asking), "asked")


def near_in(sketches: np.ndarray, r: np.ndarray, n: np.ndarray, g: np.ndarray, few: np.ndarray,
            asks: np.ndarray, matches: int, percent: int) -> list[tuple[int, int]]:
    """(member, member that names it) of a tile's members that agree in enough coordinates with one
    of another group; groups that are tied together by such pairs have one name."""
    rows, cols = np.flatnonzero(~asks), np.flatnonzero(asks)
    if not len(rows) or not len(cols):
        return []
    met = np.zeros(len(r), bool)
    number = np.unique(g, return_inverse=True)[1]
    over = list(range(int(number.max()) + 1))

    def top(x: int) -> int:
        while over[x] != x:
            over[x] = x = over[over[x]]
        return x

    step = max(1, CELLS // (len(rows) * COORDINATES))
    for at in range(0, len(cols), step):
        c = cols[at:at + step]
        ok = g[rows] != g[c, None]
        ok &= ~(few[rows] & (r[rows] < r[c, None]))  # two that ask meet once
        ok &= 100 * np.minimum(n[rows], n[c, None]) >= percent * np.maximum(n[rows], n[c, None])
        i, k = np.nonzero(ok)
        near = np.zeros(len(i), bool)
        for p in range(0, len(i), CELLS // COORDINATES):
            q = slice(p, p + CELLS // COORDINATES)
            near[q] = np.count_nonzero(sketches[c[i[q]]] == sketches[rows[k[q]]], axis=1) >= matches
        x, y = c[i[near]], rows[k[near]]
        met[x] = met[y] = True
        for one, two in np.unique(np.stack([number[x], number[y]], axis=1), axis=0).tolist():
            over[top(one)] = top(two)
    named: dict[int, int] = {}
    return [(int(r[m]), named.setdefault(top(number[m]), int(r[m]))) for m in np.flatnonzero(met)]


def near_members(posts: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links (a, z) from each member of a list that is near to one of another group to the member
    that names its like; every such pair of members is tied together by them."""
    tiles = tiled(posts, "e", F.lit(TILE))
    spark = tiles.sparkSession
    bundles = max(tiles.count() // BUNDLE + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tiles = with_sets(tiles, sets.select("r", "sketch")).withColumn(
        "bundle", F.pmod(F.xxhash64("e", "i", "j"), F.lit(bundles)))

    def search(bundle: pa.Table) -> pa.Table:
        t = bundle.combine_chunks()
        e, i, j, r, n, g, few, asks = (
            t.column(c).to_numpy() for c in ("e", "i", "j", "r", "n", "g", "few", "asks"))
        sketches = t.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        order = np.lexsort((j, i, e))
        edges = np.flatnonzero((np.diff(e[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        found = []
        for own in np.split(order, edges):
            found += near_in(sketches[own], r[own], n[own], g[own], few[own], asks[own], matches, percent)
        give_back()
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()),
                         "z": pa.array([x[1] for x in found], pa.int64())})

    return tiles.groupBy("bundle").applyInArrow(search, "a long, z long").distinct()


def rest(groups: DataFrame, posts: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links (a, z) between the groups whose members still share a list, of posts (e, r, n, g).

    Groups with members near to each other form a neighbourhood. Of those members, all but the ones
    of its largest group are compared with all of other groups, in tiles of a bounded number of sets.
    """
    links = stored(near_members(posts, sets, matches, percent), "near")
    near = merged(groups, links).select("r", F.col("g").alias("near"))
    sizes = posts.select("r", "n").distinct()
    member = links.select(F.col("a").alias("r")).distinct().join(groups, "r").join(near, "r").join(sizes, "r")
    side = F.least(F.lit(TILE), F.greatest(F.lit(16), F.floor(F.lit(TILE_BYTES) * F.col("all") / (F.col("n") * 8 + 1))))
    tiles = with_sets(tiled(stored(member, "members"), "near", side).drop("n"), sets)

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        found = []
        asks = tile["asks"].to_numpy()
        rows, cols = tile[~asks], tile[asks]
        if len(rows) and len(cols):
            whose = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
            asked = [np.frombuffer(x, np.uint64) for x in cols["shingles"]]
            size = np.array([len(x) for x in whose])
            known, ids = np.unique(np.concatenate(whose), return_inverse=True)
            ends = np.cumsum(size)
            own_sketch, g, r = np.stack(rows["sketch"].to_list()), rows["g"].to_numpy(), rows["r"].to_numpy()
            few = rows["few"].to_numpy()
            mark = np.zeros(len(known) + 1, bool)
            for s, x, y, own in zip(cols["sketch"], cols["r"], cols["g"], asked):
                near = (g != y) & ~(few & (r < x)) & (100 * np.minimum(size, len(own)) >= percent * np.maximum(size, len(own)))
                near[near] = (own_sketch[near] == np.asarray(s)).sum(axis=1) >= matches
                at = np.flatnonzero(near)
                if not len(at):
                    continue
                place = np.searchsorted(known, own)
                place = place[known[np.minimum(place, len(known) - 1)] == own]
                mark[place] = True
                if 4 * len(at) > len(size):
                    both = np.add.reduceat(mark[ids], ends - size, dtype=np.int64)[at]
                else:
                    both = np.array([mark[ids[ends[k] - size[k]:ends[k]]].sum() for k in at])
                mark[place] = False
                ok = 100 * both >= percent * (size[at] + len(own) - both)
                found += [(min(x, z), max(x, z)) for z in r[at[ok]].tolist()]
        give_back()
        return pd.DataFrame(found, columns=["a", "z"], dtype="int64")

    return tiles.groupBy("near", "i", "j").applyInPandas(compare, "a long, z long")


@contextlib.contextmanager
def sweeping(spark: SparkSession):
    """Shuffle files go at the end of each job inside."""
    was = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SWEEP) if was is None else spark.conf.set(SWEEP, was)


def components(docs: DataFrame, id: str, text: str, words: int, percent: int,
               matches: int) -> DataFrame:
    """(k1, k2, id, n, component_id, keeper) of each row; keeper is the key of the row that stays."""
    with sweeping(docs.sparkSession):
        rows, of_class = named_classes(docs, id, text, words, percent, matches)
    found = rows.where("n > 0").select("k1", "k2", "id", "n", "c").join(of_class, "c").select(
        "k1", "k2", "id", "n", "component_id",
        F.struct("keeper.k1", "keeper.k2").alias("keeper"))
    alone = rows.where("n = 0").select("k1", "k2", "id", "n", F.col("id").alias("component_id"),
                                       F.struct("k1", "k2").alias("keeper"))
    return found.unionByName(alone)


def named_classes(docs: DataFrame, id: str, text: str, words: int, percent: int,
                  matches: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (c, component_id, keeper) of each class."""
    rows = stored(signed(docs, id, text, words), "signatures")
    classes = rows.where("n > 0").groupBy("c", "n").agg(
        F.min("id").alias("id"), F.min(F.struct("k1", "k2")).alias("at"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("k1"), F.col("k2"))).alias("first"),
        F.first("sig").alias("sig"))
    classes = stored(classes.withColumn("r", F.monotonically_increasing_id()), "classes")
    listed = postings(classes)
    sets = full_sets(docs, classes, listed, id, text, words)
    groups = grouped(listed, sets, matches, percent)
    member = classes.join(groups, "r", "left").select(
        "c", "id", "first", F.coalesce("g", "r").alias("g"))
    named = stored(member.groupBy("g").agg(F.min("id").alias("component_id"),
                                           F.min("first").alias("keeper")), "components")
    of_class = stored(member.select("c", "g").join(named, "g").select("c", "component_id", "keeper"), "class-components")
    return rows, of_class


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 80, matches: int = MATCHES) -> DataFrame:
    """One row per document: the id, n_shingles, component_id (the smallest id reachable over
    links) and kept (the id is that one).

    Two texts are linked if 100 * common shingles >= percent * all shingles. A null text or one
    without words has an empty set and is linked with nothing; its component is its own id. Rows
    without an id take part, but name a component only if none of its rows has one. Repeated rows
    are in one component. Other columns are not read.
    """
    found = components(docs.select(id, text), id, text, words, percent, matches)
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5,
             percent: int = 80, matches: int = MATCHES) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Documents without words all stay.
    """
    found = components(docs.select(id, text), id, text, words, percent, matches)
    stay = stored(found.where("keeper.k1 = k1 and keeper.k2 = k2").groupBy("k1", "k2").agg(
        F.max("n").alias("n")), "stay")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *keyed(docs, id, text))
    kept = rows.join(stay, ["k1", "k2"])
    # Equal rows of the table: the first of them. Those without words are kept apart.
    apart = F.when(F.col("n") == 0, F.monotonically_increasing_id()).otherwise(0)
    return kept.withColumn("apart", apart).dropDuplicates(["k1", "k2", "apart"]).select("row.*")
