"""Quality rules: how far a text's characters and common words are from its language's.

Two passes over the texts. The first adds up, for each language, the histograms of character
classes and of common words over all distinct texts that pass the base rules, so that copies do
not pull the reference to themselves: only hashes and histograms are shuffled. What is left is one
row of numbers for each of the listed languages and one for all others. The second compares each
text with its language by the Jensen-Shannon distance (base 2, 0 to 1).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batch, flat, give_back, joined, lean, utf8

# Frequent words of the languages that have a reference of their own.
COMMON = {
    "en": "the of and to in is that it for was with as on be at by this are from or an not have",
    "fr": "de la le et les des en un du une que est pour qui dans sur par au avec il ne pas se",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "es": "de la que el en y los se del las por un para con no una su al lo como es o este",
}
OTHER = "other"
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
# Character classes, told from the first byte of a character; the rest of its bytes count nowhere.
CLASSES = (
    SPACES, SYMBOLS, bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b".,;:",
    b"!?", b"()[]{}", b"'\"`", b"-_/\\", b"+=~^@", bytes([*range(0, 9), *range(14, 32), 127]),
    bytes([0xC2, 0xC3]), bytes(range(0xC4, 0xCA)), bytes(range(0xCA, 0xE0)),
    bytes(range(0xE0, 0xF0)), bytes(range(0xF0, 0x100)),
)
CLASS_OF = np.zeros((256, len(CLASSES)), np.int64)
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c), _i] = 1
WORDS_OF = sorted({w for words in COMMON.values() for w in words.split()})
SLOT = {w.encode(): i for i, w in enumerate(WORDS_OF)}
ONE = 1_000_000  # a document's share of a class, in whole numbers: sums do not depend on order

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(body: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The five base counts, the histogram of classes and that of common words (last: others)."""
    raw = body.tobytes()
    classes = np.bincount(body, minlength=256) @ CLASS_OF
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    common = np.zeros(len(SLOT) + 1, np.int64)
    repeated = 0
    if n:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
        counts = np.bincount(ids.astype(np.int64))
        for w, k in number.items():
            slot = SLOT.get(w.lower())
            if slot is not None:
                common[slot] += counts[k]
        common[-1] = n - common.sum()
        if n > 8:
            r = joined(ids[:-1], ids[1:])
            r = joined(r[:-2], r[2:])
            r = joined(r[:-4], r[4:])
            order = np.argsort(r, kind="stable")
            same = r[order[1:]] == r[order[:-1]]
            if same.any():
                twice = np.concatenate([order[1:][same], order[:-1][same]])
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, np.unique(twice), 1)
                np.subtract.at(edge, np.unique(twice) + 8, 1)
                repeated = int((np.cumsum(edge)[:-1] > 0).sum())
    return ([n, int(classes.sum() - classes[0]), int(classes[1]), len(lines) - len(set(lines)),
             repeated], classes, common)


def failed(counts: list[int]) -> bool:
    """The base rules: too few words, or too many inside repeated 8-word windows."""
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def distance(p: np.ndarray, q: np.ndarray) -> float:
    p, q = p / max(p.sum(), 1), q / max(q.sum(), 1)
    m = (p + q) / 2
    total = 0.0
    for x in (p, q):
        on = x > 0
        total += float((x[on] * np.log2(x[on] / m[on])).sum()) / 2
    return float(np.sqrt(min(max(total, 0.0), 1.0)))


def language(value: str | None) -> str:
    return value if value in COMMON else OTHER


def tagged(docs: DataFrame, lang: str | None) -> Column:
    """The language as text; null if the table has no such column."""
    return F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")


def references(docs: DataFrame, text: str, lang: str | None) -> dict[str, tuple]:
    """Histograms of each listed language, over all distinct texts that pass the base rules."""
    width = len(CLASSES) + len(SLOT) + 1
    types = {"lang": pa.string(), "h": pa.binary(), "shares": pa.binary()}

    def measure(batches):
        for b in batches:
            data, offsets = flat(b.column(0))
            langs, rows = b.column(1).to_pylist(), {}
            for i in range(b.num_rows):
                body = data[offsets[i]:offsets[i + 1]]
                key = language(langs[i]), hashlib.blake2b(body, digest_size=16).digest()
                if key in rows:
                    continue
                counts, classes, common = measured(body)
                if not failed(counts):
                    both = [h * ONE // max(int(h.sum()), 1) for h in (classes, common)]
                    shares = np.concatenate(both)
                    at = np.flatnonzero(shares)
                    rows[key] = at.astype("u1").tobytes() + shares[at].astype("<u4").tobytes()
            yield batch({"lang": [k[0] for k in rows], "h": [k[1] for k in rows],
                         "shares": list(rows.values())}, types)

    def add(batches):
        sums = {k: np.zeros(width, np.int64) for k in (*COMMON, OTHER)}
        for b in batches:
            for k, shares in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = len(shares) // 5  # one byte of a slot and four of its share
                sums[k][np.frombuffer(shares, "u1", n)] += np.frombuffer(shares, "<u4", n, n)
        for k, v in sums.items():
            yield batch({"lang": [k] * width, "slot": np.arange(width), "n": v},
                        {"lang": pa.string(), "slot": pa.int64(), "n": pa.int64()})

    parts = docs.select(utf8(text).alias("b"), tagged(docs, lang).alias("lang"))
    each = parts.mapInArrow(lean(measure), "lang string, h binary, shares binary").groupBy("lang", "h").agg(
        F.first("shares").alias("shares"))
    total = each.select("lang", "shares").mapInArrow(add, "lang string, slot long, n long").groupBy(
        "lang", "slot").agg(F.sum("n").alias("n"))
    sums = {k: np.zeros(width, np.float64) for k in (*COMMON, OTHER)}
    for row in total.collect():  # five languages by `width` numbers
        sums[row["lang"]][row["slot"]] = row["n"]
    everything = sum(sums.values())
    return {k: ((v if v.sum() else everything)[:len(CLASSES)], (v if v.sum() else everything)[len(CLASSES):])
            for k, v in sums.items()}


class Rules:
    """Thresholds of the verdict.

    max_class, max_common: the largest distances a kept document of great length may have.
    slack_class, slack_common: added over the square root of its characters or words, since a
    short text strays further by chance. min_chars, min_words: below these the histogram is too
    thin to judge and that distance is not used.
    """

    def __init__(self, max_class: float = 0.18, max_common: float = 0.24, slack_class: float = 1.2,
                 slack_common: float = 0.6, min_chars: int = 100, min_words: int = 60):
        self.max_class, self.max_common = max_class, max_common
        self.slack_class, self.slack_common = slack_class, slack_common
        self.min_chars, self.min_words = min_chars, min_words

    def judge(self, counts, classes, common, reference) -> tuple[float, float, bool]:
        a = w = 0.0
        good, chars, words = not failed(counts), int(classes.sum()), counts[0]
        if reference[0].sum() and chars >= self.min_chars:
            a = distance(classes, reference[0])
            good &= a <= self.max_class + self.slack_class / chars ** 0.5
        if reference[1].sum() and words >= self.min_words:
            w = distance(common, reference[1])
            good &= w <= self.max_common + self.slack_common / words ** 0.5
        return a, w, bool(good)


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str | None = "lang",
          rules: Rules | None = None) -> DataFrame:
    """One row per document: the id, the five counts, base_failed, kept, js_class and js_common.

    A null text is empty and fails the base rules. A null or unlisted language is compared with
    all such documents together, and a language without any sound document with the whole corpus.
    A distance whose histogram is too thin is 0. Repeated rows are judged alike; other columns
    are not read.
    """
    rules = rules or Rules()
    found = references(docs, text, lang)
    types = {"id": None, **dict.fromkeys(COUNTS, pa.int64()), "base_failed": pa.bool_(),
             "kept": pa.bool_(), "js_class": pa.float64(), "js_common": pa.float64()}

    def judge(batches):
        for b in batches:
            data, offsets = flat(b.column(1))
            langs, rows = b.column(2).to_pylist(), []
            for i in range(b.num_rows):
                counts, classes, common = measured(data[offsets[i]:offsets[i + 1]])
                a, w, kept = rules.judge(counts, classes, common, found[language(langs[i])])
                rows.append((*counts, failed(counts), kept, a, w))
            columns = list(zip(*rows)) if rows else [[]] * (len(types) - 1)
            yield batch({"id": b.column(0), **dict(zip(list(types)[1:], columns))}, types)

    kind = docs.schema[id].dataType.simpleString()
    out = docs.select(F.col(id).alias("id"), utf8(text).alias("b"),
                      tagged(docs, lang).alias("lang")).mapInArrow(
        lean(judge), f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", base_failed boolean, kept boolean, js_class double, js_common double")
    return out.withColumnRenamed("id", id)


def keep_good(docs: DataFrame, text: str = "text", lang: str | None = "lang",
              rules: Rules | None = None) -> DataFrame:
    """The documents that pass, with all their columns.

    Nulls and repeated rows are judged as by `score`; an empty table stays empty. The rows stay
    with Spark: just texts and languages go to Python, and a verdict comes back.
    """
    rules = rules or Rules()
    found = references(docs, text, lang)

    @F.arrow_udf(returnType="boolean")
    def passes(texts: pa.Array, tags: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        langs = tags.to_pylist()
        kept = [rules.judge(*measured(data[offsets[i]:offsets[i + 1]]), found[language(langs[i])])[2]
                for i in range(len(texts))]
        give_back()
        return pa.array(kept, pa.bool_())

    return docs.where(passes(utf8(text), tagged(docs, lang)))
