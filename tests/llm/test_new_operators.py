"""Token counts at prefixes, repair of conversations, and collocations against brute force."""

import random
import time

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidelog.llm import collocations, html_text, prefix_tokens, queries, repair

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["<s>", "</s>", "日本", "𐍈", "é", "\n", "\t", " ", "  ", "▁", "\0", "a\r", "hello", "HELLO wor", "ing", "  " * 9,
         "!!", "x_y", "_", "._", "123456", "aaaaaaa", "<0x0A>", "http://", ",", "(x)", "don't", "​"]


@pytest.fixture(scope="module")
def library():
    tool = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(tool.encode(text or ""))


def test_counts_of_all_prefixes(library):
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(500)]
    texts += ["", "ab" * 40000, "x" * 70000 + "日本" * 9]
    for text, found in zip(texts, prefix_tokens.PrefixCounter(MODEL).prefixes(texts)):
        total = np.cumsum(found, dtype=int)
        assert len(total) == len(text)
        for i in range(1, len(text) + 1) if len(text) < 500 else (65535, 65536, 65540, len(text)):
            assert total[i - 1] == library(text[:i])


def test_token_counts(spark, library):
    rows = [(1, None), (2, ""), (None, "Hello world"), (3, "  a  b\n"), (3, "  a  b\n"), (4, "word " * 5000), (5, "日本 </s>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("id", "b", "prefix", "n_tokens", "lang")})
    got = prefix_tokens.prefix_counts(docs, MODEL).collect()
    assert sorted((g.doc_id or -1, g.n_bytes, g.n_tokens, g.over_limit) for g in got) == sorted(
        (d or -1, len((t or "").encode()), library(t), library(t) > 4096) for d, t in rows)
    assert prefix_tokens.prefix_counts(docs.where("false"), MODEL).count() == 0


def test_budgets_are_answered_from_the_stored_counts(spark, library):
    text = "The unbelievable   story, of 12345 naïve\nwords 日本!"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    counted = prefix_tokens.prefix_counts(docs, MODEL)
    asked = counted.withColumn("at", F.explode(F.sequence(F.lit(-1), F.lit(len(text) + 2)))).withColumn(
        "at", F.when(F.col("at") <= len(text) + 1, F.col("at")))
    got = {(r.doc_id, r["at"]): r.n_before for r in prefix_tokens.tokens_before(asked, "at").collect()}
    assert all(n == (None if at is None else library(text[:max(0, at)] if doc == 1 else ""))
               for (doc, at), n in got.items())
    for r in prefix_tokens.longest_within(asked, "at").collect():
        own = text if r.doc_id == 1 else ""
        best = None if r["at"] is None else max([i for i in range(len(own) + 1) if library(own[:i]) <= r["at"]], default=0)
        assert r.n_fit == best


def conversations(seed, n):
    r = random.Random(seed)
    out = [(None, None, None, None), (None, 1, "user", "a."), (-1, 2, "", "x."), (-1, None, "tool", "y")]
    for conv in range(n):
        for turn in range(r.choice([1, 2, 5, 9])):
            text = r.choice(["Yes.", "no", " \t", "", None, f"text {turn}!", "Why?  ", "same."])
            out.append((conv, r.choice([turn, turn, turn, turn + 1, None]),
                        r.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), text))
    out += [(-5, t, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", "no", f"{t}.", f"{t}"])) for t in range(300)]
    return out + out[5:15]


COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("block", [1, 3, 512])
def test_repair(spark, compare, block):
    rows = conversations(block, 150)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("conv", "m", "said", "first", "block", "kind")})
    got = repair.repair(repair.damaged(table), block_rows=block)
    assert got.columns == COLUMNS
    assert compare(got) == brute.repairs(rows)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damaged(none)).count() == 0


def test_registered_repair(spark, compare):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = queries.queries()["op12_conversation_repair"](spark, SF)
    assert compare(got, "conv_id", *COLUMNS[1:]) == brute.repairs(rows)


def test_registered_token_counts(spark, library, compare):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.queries()["op11_prefix_token_counts"](spark, SF)
    assert compare(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(
        ((r.doc_id, len((r.text or "").encode()), library(r.text), library(r.text) > 4096) for r in rows), key=repr)


def phrases(seed, n):
    r = random.Random(seed)
    vocabulary = ["a", "b", "C", "dé", "日", "e" * 9, "f\0", "g"]
    fixed = ["x y z", "x y z w", "b c d", "g  g\tg"]
    out = [(None, None), ("en", ""), ("en", "  \t "), ("xx", "a b. a b"), (None, "x y z " * 40)]
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.4 else r.choice(vocabulary) for _ in range(r.randint(1, 40))]
        out.append((r.choice(["en", "fr", None]), "".join(p + r.choice([" ", " ", "  ", "\t", ". ", "\n"]) for p in parts)))
    return out + out[6:12]


@pytest.mark.parametrize("least,top", [(3, 5), (5, 1), (2, 2000), (30, 12)])
def test_collocations(spark, compare, least, top):
    rows = phrases(least, 60)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {c: F.lit("x") for c in ("w1", "a", "l", "run", "score", "phrase", "part", "b")})
    got = collocations.collocations(docs, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert compare(got) == sorted(brute.collocations(rows, least, top), key=repr)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0


def test_long_texts_are_cut_at_ends_of_pieces(spark, compare):
    text = ("one two three " * 9 + "\n") * 30_000  # over STEP, and one piece over it
    rows = [("en", text), ("en", "four five " * 300_000)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), top=4)
    assert compare(got) == sorted(brute.collocations(rows, top=4), key=repr)


def test_scores_are_exact_beyond_64_bits(spark):
    many = 9_000_000_000_000_000_000 // 2
    got = spark.createDataFrame([(many, many + 1)], "a long, b long").select(
        collocations.ratio(F.col("a"), F.col("b")).alias("s")).first().s
    assert got == 2_000_000 * many // (many + 1)


WORDS = "The committee met again on Tuesday and agreed on the plan for the coming year. " * 3


@pytest.mark.parametrize("page,want", [
    (f'<body><div class="content has-sidebar"><p>{WORDS}</p></div></body>', WORDS),
    (f'<div class="post no-comments"><p>{WORDS}</p></div>', WORDS),
    (f'<div id="page" class="search-enabled"><p>{WORDS}</p></div>', WORDS),
    (f'<div class="widget"><p>{WORDS}</p></div>', WORDS),  # a name around all there is
    (f'<article><header class="entry-header"><h1>A title</h1></header><p>{WORDS}</p></article>'
     f'<div class="comments"><article class="comment"><p>{WORDS}</p></article></div>', f"A title\n{WORDS}"),
    ("<h1>Note</h1><p>The meeting is at nine.</p>", "Note\nThe meeting is at nine."),
    (f'<form id="f"><div id="main-nav"><a href=x>Home</a></div><p>{WORDS}</p>'
     f'<div class="site-footer">(c) us</div></form>', WORDS),
])
def test_names_are_evidence(page, want):
    assert html_text.main_text(page) == "\n".join(x.strip() for x in want.split("\n"))


@pytest.mark.parametrize("page", [
    '<a "' * 250_000, '<a "' * 250_000 + ">", "<div>" * 100_000 + "x", "<div><p>a b c" * 60_000,
    "<div>" * 50_000 + "</p>" * 100_000, "<a '\"> " * 150_000, "<p " + "a" * 1_000_000 + ">x",
    "<style><body>" * 80_000, "<" * 1_000_000, "<!" * 500_000,
])
def test_long_odd_pages_take_linear_time(page):
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 20  # quadratic ones took minutes
