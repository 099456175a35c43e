"""License scan over a positional index of rare licence words.

The templates (licence names and phrases of licence texts) are one small inverted index: word ->
(template, position). Pass one counts in how many documents each of its words occurs. Pass two
takes, for every template, its words of highest IDF as probes: each place of a probe in a text
puts the template at one relative position, positions named by several probes are merged, and
there the other words are compared. A phrase counts where all its words stand; a longer template
where enough of them do and its mandatory key phrase stands as a whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WORDS, batch, flat, utf8

# Phrases whose every place counts.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Longer templates: label, text, and the key phrase that has to stand in it word by word.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public "
                   "license as published by the free software foundation", "redistribute it and or modify it"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this "
                 "software and associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted", "permission to use copy modify and or distribute"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)
PROBES = 3  # words of highest IDF of a longer template that put it into place


class Index:
    """Templates as numbered words; counts: in how many of all documents each word occurs."""

    def __init__(self, phrases=None, templates=TEMPLATES, least: float = 0.8):
        phrases = PHRASES if phrases is None else phrases
        self.number: dict[bytes, int] = {}
        self.least = least
        self.entries = []  # label, word numbers, key (place, length), base or not
        for phrase, label in phrases.items():
            ids = self.ids(phrase)
            self.entries.append((label, ids, (0, len(ids)), True))
        for label, text, key in templates:
            ids, k = self.ids(text), self.ids(key)
            at = next(i for i in range(len(ids)) if ids[i:i + len(k)] == k)
            self.entries.append((label, ids, (at, len(k)), False))

    def ids(self, text: str) -> list[int]:
        return [self.number.setdefault(w, len(self.number) + 1) for w in text.encode().translate(WORDS).split()]

    def weigh(self, counts: np.ndarray, documents: int) -> None:
        self.idf = np.array([0.0, *(math.log((documents + 1) / (c + 1)) for c in counts)])
        self.plans = []
        for label, ids, key, base in self.entries:
            # Places by falling IDF; a phrase needs one, since all its words have to stand.
            order = sorted(range(len(ids)), key=lambda i: (-self.idf[ids[i]], i))
            # A probe of the key phrase is a must: with its rarest word no place is missed.
            inside = [i for i in order if key[0] <= i < sum(key)]
            probes = inside[:1] + ([] if base else [i for i in order if i != inside[0]][:PROBES - 1])
            self.plans.append((label, np.array(ids, np.int32), key, base, probes))
        self.anchors = {ids[p] for _, ids, _, _, probes in self.plans for p in probes[:1]}

    def scan(self, body: bytes) -> tuple[int, list[tuple[int, int, str]], dict[str, float]]:
        """Words of the text, places (start, words, label) of phrases, best share per template."""
        words = body.translate(WORDS).split()
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        places, shares = [], {}
        if not ids.any():
            return len(words), places, shares
        seen = set(np.unique(ids).tolist())
        for label, t, (at, size), base, probes in self.plans:
            if int(t[probes[0]]) not in seen:
                continue
            start = np.unique(np.concatenate([np.flatnonzero(ids == t[p]) - p for p in probes]))
            if base:
                start = start[(start >= 0) & (start + len(t) <= len(ids))]
            inside = start[(start + at >= 0) & (start + at + size <= len(ids))]
            if not len(inside):
                continue
            place = inside[:, None] + np.arange(len(t))
            same = (place >= 0) & (place < len(ids))
            same &= ids[np.clip(place, 0, len(ids) - 1)] == t
            whole = same[:, at:at + size].all(axis=1)
            if base:
                places += [(int(s), len(t), label) for s in inside[whole]]
            elif whole.any():
                share = float(same[whole].mean(axis=1).max())
                if share >= self.least:
                    shares[label] = share
        return len(words), places, shares


def counted(docs: DataFrame, index: Index) -> tuple[np.ndarray, int]:
    """Documents of each template word, and documents in all."""
    number = index.number
    types = {"at": pa.int32(), "n": pa.int64()}

    def count(batches):
        total = np.zeros(len(number) + 1, np.int64)
        for b in batches:
            data, offsets = flat(b.column(0))
            raw = data.tobytes()
            total[0] += b.num_rows
            for i in range(b.num_rows):
                for w in set(raw[offsets[i]:offsets[i + 1]].translate(WORDS).split()).intersection(number):
                    total[number[w]] += 1
        yield batch({"at": np.arange(len(total), dtype=np.int32), "n": total}, types)

    sums = np.zeros(len(number) + 1, np.int64)
    for r in docs.select("b").mapInArrow(count, "at int, n long").groupBy("at").agg(
            F.sum("n").alias("n")).collect():  # one row per template word
        sums[r["at"]] = r["n"]
    return sums[1:], int(sums[0])


def scan_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  index: Index | None = None) -> DataFrame:
    """One row per document: the id, n_words, n_base (all places of a base phrase), first_word and
    last_word (their smallest and largest start, else null), base_labels, labels (the templates'
    too; both distinct, sorted, comma-joined), score and places (start, words, label).

    score is the greatest share of a label's words found in place: 1 for a phrase, 0 without a
    label. A null text is empty; repeated rows are scanned alike; other columns are not read.
    """
    index = index or Index()
    rows = docs.select(F.col(id).alias("id"), utf8(text).alias("b"))
    index.weigh(*counted(rows, index))
    types = {"id": None, "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(),
             "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(),
             "score": pa.float64(),
             "places": pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("label", pa.string())]))}

    def scan(batches):
        for b in batches:
            data, offsets = flat(b.column(1))
            raw, out = data.tobytes(), []
            for i in range(b.num_rows):
                n, places, shares = index.scan(raw[offsets[i]:offsets[i + 1]])
                base = {p[2] for p in places}
                starts = [p[0] for p in places]
                out.append((n, len(places), min(starts, default=None), max(starts, default=None),
                            ",".join(sorted(base)), ",".join(sorted(base | set(shares))),
                            1.0 if base else max(shares.values(), default=0.0),
                            [dict(zip(("start", "words", "label"), p)) for p in sorted(places)]))
            columns = list(zip(*out)) if out else [[]] * (len(types) - 1)
            yield batch({"id": b.column(0), **dict(zip(list(types)[1:], columns))}, types)

    kind = docs.schema[id].dataType.simpleString()
    out = rows.mapInArrow(scan, f"id {kind}, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double, "
                                "places array<struct<start: long, words: long, label: string>>")
    return out.withColumnRenamed("id", id)
