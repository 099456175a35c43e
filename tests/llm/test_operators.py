"""Each operator against brute force, with nulls, empty and repeated rows, ties, clashing columns."""

import collections
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog import session
from tidelog.llm import (
    chat, decontaminate, divergence, html_text, licenses, minhash, packing, repeats, sharding, token_files, tokens,
)

DOCS = "doc_id long, text string"


def texts(seed, vocabulary, sizes, base, edits, n, near=0.7):
    """Documents of which many are edited copies of a few."""
    r = random.Random(seed)
    make = lambda k: [r.choice(vocabulary) for _ in range(k)]
    bases = [make(r.choice(sizes)) for _ in range(base)]
    out = [(None, None), (1, ""), (2, "  \n"), (None, "Hello World"), (3, "hello  world")]
    for i in range(4, n):
        w = list(r.choice(bases)) if r.random() < near else make(60)
        for _ in range(r.choice(edits)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        out.append((i, r.choice([" ", "\n", "  "]).join(w)))
    return out + out[8:11]


def frame(spark, rows):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit("x") for c in ("row", "b", "id", "n", "k1", "spans", "kept", "rest", "shard", "lang")})


def test_sharding(spark, compare):
    rows = texts(1, ["aa", "b", "cé"], [3, 40], 9, [0, 0, 1], 300)
    got = sharding.assign(frame(spark, rows), shards=5).collect()
    assert sorted((g.doc_id is None, g.doc_id or 0, g.size, g.text_crc32) for g in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    sums, slots, shard_of = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for g in got:
        sums[g.shard] += g.size
        slots[g.shard].append(g.slot)
        shard_of[g.text_crc32].add(g.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in shard_of.values())
    assert max(sums.values()) - min(sums.values()) <= 60
    assert sharding.assign(frame(spark, rows).where("false")).count() == 0


def test_differencing_beats_greedy():
    r = random.Random(3)
    sizes = [r.randint(1, 10**6) for _ in range(400)]
    place = sharding.partition(sizes, 7)
    sums = np.bincount(place, weights=sizes, minlength=7)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() < 200


def test_plan_holds_every_piece():
    r = random.Random(2)
    for _ in range(150):
        capacity = r.choice([10, 30, 100, 4096])
        counts = collections.Counter(r.randint(1, max(1, capacity // r.choice([1, 1, 2, 5])))
                                     for _ in range(r.randint(1, 300)))
        held = collections.Counter()
        for number, pieces in packing.plan(counts, capacity):
            assert sum(w * k for w, k in pieces) <= capacity
            for w, k in pieces:
                held[w] += number * k
        assert held == counts


@pytest.mark.parametrize("sizes,best", [([6, 4, 5, 5], 2), ([7, 3, 6, 4, 2, 8], 3), ([9, 9, 1, 1, 5, 3, 2], 3), ([6, 6, 6], 3)])
def test_plan_is_best(sizes, best):
    assert sum(n for n, _ in packing.plan(collections.Counter(sizes), 10)) == best


ODD = ["don't", "'RE're", "..'s 23'll", "a  b \n c", "ßĲ ﬁ", "日本", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "   ", "\t", "x\u0301y", "ª²½", "\x1c z", " ", "\n\n\n"]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_cached_tokens_equal_the_library(name, kind):
    r = random.Random(4)
    listed = ["".join(r.choice(ODD + [" ", "Foo", "é", "7"]) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    path = public_tokenizers.path(name)
    tool = Tokenizer.from_file(path)
    want = [np.array(tool.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in listed]
    assert tokens.Encoder(path, kind).encode(listed) == tokens.Encoder(path, None).encode(listed) == want


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_known_parts_are_looked_up_once(name, kind):
    looked = []

    class Part(str):
        def __hash__(self):
            looked.append(self)
            return super().__hash__()

    tool = tokens.Encoder(public_tokenizers.path(name), kind)
    listed = ["the cat and the dog, the end. " * 20, "a dog and a cat"]
    known = tool.encode(listed)
    cut = tool.parts
    tool.parts = lambda text: [Part(p) for p in cut(text)]
    assert tool.encode(listed) == known
    assert len(looked) == sum(len(cut(t)) for t in listed)


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_dropped_parts_are_encoded_again(monkeypatch, name, kind):
    monkeypatch.setattr(tokens, "MOST_KEPT", 30)
    monkeypatch.setattr(tokens, "MOST_CHARS", 2000)
    r = random.Random(5)
    path = public_tokenizers.path(name)
    tool, plain = tokens.Encoder(path, kind), tokens.Encoder(path, None)
    for _ in range(60):
        listed = [" ".join(r.choice(["the", "of", "x" * r.randint(1, 300), f"w{r.randint(0, 90)}"])
                           for _ in range(r.randint(0, 12))) for _ in range(4)]
        assert tool.encode(listed) == plain.encode(listed)
        assert len(tool.number) <= 30 and tool.chars <= 2000 and len(tool.starts) == len(tool.number) + 1
    assert set(tool.parts(" the of")[1:]) <= set(tool.number)  # met again and again


TOKENS = [(None, None), (3, ""), (2, "Hello world don't <|endoftext|>"), (7, "x y " * 3000), (5, "日本 語"),
          (7, "dup"), (2, "Hello world don't <|endoftext|>"), (None, "n"), *((i, o) for i, o in enumerate(ODD, 20))]


def library(name, end):
    tool = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: tool.encode(t or "", add_special_tokens=False).ids + [end]


def test_packing(spark):
    path, ids = public_tokenizers.path("word_bpe_49k.json"), library("word_bpe_49k.json", 1)
    packed = packing.pack(frame(spark, TOKENS), path, capacity=64, with_ids=True)
    want = collections.Counter()
    for d, t in TOKENS:
        full = ids(t)
        for p in range(0, len(full), 64):
            part = full[p:p + 64]
            want[(d, p // 64, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = packed.collect()
    assert collections.Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    places = collections.defaultdict(list)
    for g in got:
        places[g.sequence_id].append((g.offset, g.length))
    for parts in places.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
        assert sum(n for _, n in parts) <= 64
    assert len(places) == -(-sum(g.length for g in got) // 64)
    whole = packing.sequences(packed).collect()
    assert sum(len(w.ids) // 4 for w in whole) == sum(g.length for g in got) and len(whole) == len(places)
    assert packing.pack(frame(spark, TOKENS).where("false"), path).count() == 0


def test_token_files(spark):
    path, ids = public_tokenizers.path("byte_bpe_50k.json"), library("byte_bpe_50k.json", 0)
    store = session.scratch(spark, "store")
    token_files.write_store(frame(spark, TOKENS), store, path, shard_ids=50)
    got = token_files.read_store(spark, store).orderBy("start").collect()
    order = [g.doc_id if g.doc_id is not None else -1 for g in got]
    assert order == sorted(order)
    at = 0
    for g in got:
        assert g.start == at
        at += g.n_tokens
    assert sorted((g.doc_id or -1, g.n_tokens, g.ids_crc32) for g in got) == sorted(
        (d or -1, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t in TOKENS)
    asked = spark.createDataFrame([(2,), (7,), (None,), (999,)], "doc_id long")
    found = token_files.lookup(store, asked).collect()
    assert sorted((f.doc_id or -1, list(np.frombuffer(f.ids, "<u4"))) for f in found) == sorted(
        (d or -1, ids(t)) for d, t in TOKENS if d in (2, 7, None))
    empty = session.scratch(spark, "store")
    token_files.write_store(frame(spark, TOKENS).where("false"), empty, path)
    assert token_files.read_store(spark, empty).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    phf = token_files.PerfectHash.from_bytes(token_files.PerfectHash.build(keys).to_bytes())
    assert sorted(phf.find(keys).tolist()) == list(range(len(keys)))


def test_licenses(spark):
    r = random.Random(6)
    parts = ["GNU General Public License", "Apache License, Version 2.0", "CC-BY", "CC BY-NC 4.0", "MIT", "License",
             "gnu general", "public license", "é", "the", "Permission is hereby granted, free of charge, to any person "
             "obtaining a copy of this software and associated documentation files"]
    rows = [(None, None), (1, "")] + [(i, r.choice([" ", "\n"]).join(r.choice(parts) for _ in range(r.randint(1, 9))))
                                      for i in range(2, 150)]
    rows += rows[5:7]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    assert sorted(((g.doc_id, g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) for g in got), key=repr) == \
        sorted(((d, *brute.phrases(t, licenses.PHRASES)) for d, t in rows), key=repr)
    for g in got:
        labels = set(filter(None, g.labels.split(",")))
        assert set(filter(None, g.base_labels.split(","))) <= labels and (g.score > 0) == bool(labels)
    assert licenses.scan_licenses(frame(spark, rows).where("false")).count() == 0


def test_mit_text_is_labelled(spark):
    text = dict(zip(("l", "t", "k"), next(t for t in licenses.TEMPLATES if t[0] == "mit-text")))["t"]
    rows = [(1, "intro " + text.replace("associated", "related") + " end"), (2, text.replace("granted", "given"))]
    got = {g.doc_id: (g.labels, g.score) for g in licenses.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1][0] == "mit-text" and 0.9 < got[1][1] < 1 and got[2] == ("", 0.0)


def test_quality_counts(spark):
    r = random.Random(7)
    rows = [(None, None), (1, ""), (2, "\x0b \x1c\n\n"), (3, "a " * 5000)]
    for i in range(4, 150):
        rows.append((i, "".join(r.choice(["the ", "The\n", "é#", "x|y ", "\n", "of and to in ", "日 "])
                                for _ in range(r.randint(0, 60)))))
    rows += rows[6:8]
    got = divergence.score(frame(spark, rows)).collect()
    mine = sorted(((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed)
                   for g in got), key=repr)
    assert mine == sorted(((d, *brute.quality(t)) for d, t in rows), key=repr)
    assert not any(g.kept and g.base_failed for g in got)
    assert divergence.keep_good(frame(spark, rows)).count() == sum(g.kept for g in got)
    assert divergence.score(frame(spark, rows).where("false")).count() == 0


def test_quality_tells_junk(spark):
    """Against the labels: nearly all good documents stay, most of the junk goes."""
    sf = "/root/testdata/sf0.01"
    found = divergence.score(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = found.where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, junk = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.25 * len(junk)


def test_copies_do_not_move_references(spark):
    """With one junk text in a third of the rows every document is judged as without its copies."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    judged = {r.doc_id: (r.kept, r.js_class, r.js_common) for r in divergence.score(docs).collect()}
    sound = {r.doc_id for r in divergence.score(docs).where("not base_failed").collect()}
    english = {r.doc_id for r in docs.where("lang = 'en'").collect()}
    junk = max((d for d in sound & english if not judged[d][0]), key=lambda d: judged[d][2])
    copies = docs.where(F.col("doc_id") == junk).crossJoin(spark.range(1, 1 + len(judged) // 2).toDF("i")).select(
        (-F.col("i")).alias("doc_id"), "text", "lang")
    many = docs.unionByName(copies)
    again = {r.doc_id: (r.kept, r.js_class, r.js_common) for r in divergence.score(many).collect()}
    assert {d: x for d, x in again.items() if d >= 0} == judged
    assert {x for d, x in again.items() if d < 0} == {judged[junk]}
    assert divergence.keep_good(many).count() == sum(x[0] for x in judged.values())


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_contamination(spark, compare, block_words):
    r = random.Random(5)
    vocabulary = ["a", "b", "the", "Of", "é", "zü", "x1", "9", *(f"w{i}" for i in range(40))]
    make = lambda n: r.choice([" ", "\n", ", "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(i, make(r.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(8)]
    items += [(100, None), (101, "!!"), (None, "a"), (3, "w1 w2 w3")]
    docs = [(None, "a b"), (1, None), (2, "")]
    for i in range(3, 50):
        text = make(r.randint(1, 90))
        docs.append((i, f"{text} {r.choice(items[:8])[1].upper()} {make(3)}" if r.random() < 0.6 else text))
    docs += docs[5:8]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    want = brute.contamination(docs, items)
    assert compare(decontaminate.contamination(frame(spark, docs), bench, block_words=block_words)) == want
    kept = decontaminate.drop_contaminated(frame(spark, docs), bench, block_words=block_words)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(w[0] or -1 for w in want if not w[5])
    assert kept.columns == frame(spark, docs).columns


def test_contamination_of_empty_tables(spark):
    docs = frame(spark, [(1, "a b")])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.contamination(docs, none).collect()] == [False]
    assert decontaminate.contamination(docs.where("false"), none).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><!-- ad --><div class="ad">Buy now.</div>
<article><h1>Title &amp;  more</h1><p>First <b>bold</b>&nbsp;text.<br>Next.<p>Second &#233; &copy</p><aside>Also read</aside>
<form><p>Sign up</p></form></article><div id="comments"><p>Nice article, I have read it with great pleasure today.</p></div>
<div style="display: none">Hidden</div><footer>&copy; me</footer>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", "<nav>x"), (3, "w", "<nav>x"), (4, "z", "<p>" + "Words of a text. " * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(((r.page_id or -1, r.text, r.n_chars) for r in html_text.extract(pages).collect()))
    long = " ".join("Words of a text.".split() * 20)
    want = "Title & more\nFirst bold text. Next.\nSecond é ©"
    assert got == [(-1, "", 0), (1, want, len(want)), (2, "", 0), (3, "", 0), (3, "", 0), (4, long, len(long))]
    assert html_text.extract(pages.where("false")).count() == 0


LONG = "Words of a text. " * 20


@pytest.mark.parametrize("page", [
    "<p>{}</p><script>for(var i=0;i<n;i++){{f(i)}}</script><p>{}</p>",
    "<p>{}</p><style>a<b{{}}</STYLE ><p>{}</p>",
    "<p>{}</p><textarea>a<b \"c</textarea><p>{}</p>",
    "<head><title>a<b</title></head><body><p>{}</p><iframe>a<b</iframe><p>{}</p>",
    "<head><title>T</title><meta name=a><p>{}</p><div>{}</div>",
    "<head><template><p>T</p></template><script>if(a<b)c</script><style>a<b{{}}</style><div>{}</div><p>{}</p>",
    "<script><!-- w('<script>x</script>') --></script><p>{}</p><script><!-- x<y </script><p>{}</p>",
    "<head><title>T<body><p>{}</p><p>{}</p><script>a<b",
])
def test_text_behind_raw_elements(page):
    assert html_text.main_text(page.format(LONG, LONG)) == f"{LONG.strip()}\n{LONG.strip()}"


def test_cut_is_least():
    r = random.Random(8)
    for _ in range(200):
        n = r.randint(1, 7)
        source, sink = ([r.randint(0, 9) for _ in range(n)] for _ in range(2))
        edges = [(a, b, r.randint(0, 6)) for a in range(n) for b in range(a) if r.random() < 0.5]

        def cost(side):
            return (sum(sink[i] if side[i] else source[i] for i in range(n))
                    + sum(c for a, b, c in edges if side[a] != side[b]))

        least = min(cost([m >> i & 1 for i in range(n)]) for m in range(2**n))
        assert cost(html_text.flow(source, sink, edges)) == least


def test_near_duplicates(spark, compare):
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "é", "Ab", "aB"]
    docs = texts(5, vocabulary, [1, 2, 5, 30, 120], 12, [0, 0, 1, 2, 5, 9], 260)
    want = brute.near(docs)
    assert compare(minhash.near_duplicates(frame(spark, docs), words=2)) == want
    kept = minhash.keep_one(frame(spark, docs), words=2)
    assert kept.columns == frame(spark, docs).columns
    # One of each component; of those without words, all.
    named = {w[2] for w in want if w[1]}
    assert kept.count() == len(named) + sum(1 for w in want if not w[1])
    assert minhash.near_duplicates(frame(spark, docs).where("false")).count() == 0


def test_family_of_partial_links(spark, compare):
    """Edited copies of one text, many of them linked with few others: the tiles decide."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    docs = []
    for i in range(160):
        w = list(base)
        for k in r.sample(range(100), r.choice([2, 5, 8, 10, 12])):
            w[k] = f"x{r.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    assert compare(minhash.near_duplicates(spark.createDataFrame(docs, DOCS), words=2)) == brute.near(docs)


def test_lists_shared_by_chance(spark, compare, monkeypatch):
    """Texts with a common part share lists and are not alike: their sets are not moved."""
    r = random.Random(3)
    common = " ".join(f"c{i}" for i in range(45))
    docs = [(i, f"{common} " + " ".join(f"x{r.randrange(10**6)}" for _ in range(75))) for i in range(120)]
    docs += [(500 + i, docs[i][1] + " end") for i in range(3)]
    moved, move = [], minhash.with_sets

    def counted(asked, sets):
        if "shingles" in sets.columns:
            moved.append(asked.count())
        return move(asked, sets)

    monkeypatch.setattr(minhash, "with_sets", counted)
    assert compare(minhash.near_duplicates(spark.createDataFrame(docs, DOCS), words=2)) == brute.near(docs)
    assert 6 <= sum(moved) <= 12  # once or twice the three pairs


def test_family_over_many_tiles(spark, compare, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 7)
    monkeypatch.setattr(minhash, "BUNDLE", 50)
    r = random.Random(10)
    docs = []
    for i in range(60):
        w = [f"b{k}" for k in range(80)]
        for k in r.sample(range(80), r.choice([3, 5, 7, 9])):
            w[k] = f"x{r.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    assert compare(minhash.near_duplicates(spark.createDataFrame(docs, DOCS), words=2)) == brute.near(docs)
    assert spark.conf.get(minhash.SWEEP, None) != "true"


def test_near_members_of_a_tile(monkeypatch):
    monkeypatch.setattr(minhash, "CELLS", 300)
    rng = np.random.default_rng(4)
    for _ in range(60):
        m = int(rng.integers(2, 25))
        base = rng.integers(-128, 128, (3, minhash.COORDINATES))
        sketches = np.where(rng.random((m, minhash.COORDINATES)) < 0.6, base[rng.integers(0, 3, m)],
                            rng.integers(-128, 128, (m, minhash.COORDINATES))).astype(np.int8)
        r, n = rng.permutation(m) + 100, rng.integers(60, 101, m)
        g = rng.integers(0, 5, m)
        few = g != np.bincount(g).argmax()
        row = np.concatenate([np.arange(m), np.flatnonzero(few)])  # all answer, the few ask as well
        asks = np.arange(len(row)) >= m
        got = minhash.near_in(sketches[row], r[row], n[row], g[row], few[row], asks, 20, 80)
        pairs = [(a, z) for a in range(m) for z in range(a) if g[a] != g[z]
                 and 100 * min(n[a], n[z]) >= 80 * max(n[a], n[z]) and (sketches[a] == sketches[z]).sum() >= 20]
        assert {a for a, _ in got} == {int(r[x]) for p in pairs for x in p}
        name = {a: z for a, z in got}
        tied = [{int(g[x]) for x in range(m) if name.get(int(r[x])) == z} for z in set(name.values())]
        assert all(name[int(r[a])] == name[int(r[z])] for a, z in pairs)
        assert sum(map(len, tied)) == len(set().union(*tied))  # a group has one name


CHATS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
         (None, None, None, None), (None, 3, "assistant", "<\\s> [\\\\INST] <s"), (-8, 1, "assistant", "\\<s>"),
         (-8, 1, "assistant", "\\<s>"), (-8, 0, "as</s>", ""), *((5, t, "user", f"t{t}") for t in range(40, 0, -1))]


def test_chat_round_trip(spark, compare):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn int, role string, text string").withColumn("tree", F.lit(1))
    got = chat.digests(rows)
    assert compare(got, *got.columns[:5]) == brute.chats(CHATS)
    assert chat.digests(rows.where("false")).count() == 0


def test_reply_tree(spark):
    said = [("t", 1, None, "user", "q", None), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 5.0),
            ("t", 4, 2, "user", "more", 9.0), ("u", 1, 99, "user", "solo", None)]
    tree = spark.createDataFrame(said, "tree string, node int, parent int, role string, text string, score double")
    got = [(r.tree, r.leaf, r.formatted) for r in chat.formatted(chat.conversations(tree, 2)).orderBy("tree", "rank").collect()]
    assert got == [("t", 3, "<s>[INST]user[/INST]q</s>[INST]assistant[/INST]b</s>"),
                   ("t", 4, "<s>[INST]user[/INST]q</s>[INST]assistant[/INST]a</s>[INST]user[/INST]more</s>"),
                   ("u", 1, "<s>[INST]user[/INST]solo</s>")]
    circle = spark.createDataFrame([("c", 1, 2, "u", "x", 0.0), ("c", 2, 1, "u", "y", 0.0)], tree.schema)
    with pytest.raises(ValueError, match="circle"):
        chat.conversations(circle)


def test_repeats(spark, compare):
    vocabulary = ["".join(random.Random(i).choice("abcdeéfü") for _ in range(1 + i % 8)) for i in range(300)]
    rows = texts(3, vocabulary, [30, 120, 300], 8, [0, 0, 1, 3, 8], 70)
    rows += [(300, "a" * 1000), (301, "ab" * 300 + "a" * 250), (None, "x" * 300)]
    want = brute.repeats(rows)
    got = repeats.remove_repeats(frame(spark, rows))
    assert compare(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    stripped = repeats.strip_repeats(frame(spark, rows))
    assert stripped.columns == frame(spark, rows).columns and stripped.count() == len(rows)
    assert sum(len((r.text or "").encode()) for r in stripped.collect()) <= sum(w[1] - w[2] for w in want)
    assert repeats.remove_repeats(frame(spark, rows).where("false")).count() == 0


def test_quality_without_languages_and_of_no_rows(spark):
    docs = spark.createDataFrame([(1, "a " * 40), (2, None)], "doc_id int, text string")
    assert {r.doc_id for r in divergence.score(docs).collect()} == {1, 2}
    assert set(divergence.keep_good(docs).columns) == {"doc_id", "text"}
    assert divergence.keep_good(docs.where("false")).collect() == []


def test_stripping_keeps_odd_rows_and_columns(spark):
    passage = "".join(f"w{i} " for i in range(80))
    docs = spark.createDataFrame(
        [(1, "a" + passage, "x"), (2, "b" + passage, "y"), (3, None, "z"), (4, "", "z"), (5, "short", "z")],
        "doc_id int, text string, spans string")
    got = {r.doc_id: (r.text, r.spans) for r in repeats.strip_repeats(docs).collect()}
    assert got == {1: ("a", "x"), 2: ("b", "y"), 3: (None, "z"), 4: ("", "z"), 5: ("short", "z")}
    assert repeats.strip_repeats(docs.where("false")).collect() == []
