"""Token counts at every prefix of a text, by dynamic programming over its last token.

The tokenizer is a byte-pair model of the sentencepiece library: of all neighbours whose union is a
piece, the union with the best score is made first, the leftmost of equal ones. Two facts follow
from the order of merges alone. The tokens of a prefix that ends where a token ends are the first
tokens of the whole; and a sequence of tokens is the encoding of its text if and only if each two
neighbours are the encoding of theirs. So every prefix has one last token that may follow the last
token of the prefix before it, and

    count(prefix) = count(prefix without its last token) + 1

gives the exact count of each prefix in one pass, without encoding any of them. A text falls apart
where no piece of the vocabulary reaches across: in front of a blank and around characters that are
no pieces. The counts of short parts are kept by the worker, for words come again.

Stored is one signed byte per code point: the count there less the count one code point before.
Its running sum answers what a cut costs and where a budget ends; no text is encoded again.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batch, utf8

BLANK = "▁"
MOST_KEPT = 300_000  # parts of one generation of a worker's cache; it holds two
STEP = 4 << 20  # bytes of texts that are split at a time
LONGEST_KEPT = 64  # code points of a part that is kept
MOST_PAIRS = 500_000  # pairs of tokens whose order a worker remembers
LIMIT = 4096
_WORD = re.compile(r"[^\W_]")
_loaded: dict[str, PrefixCounter] = {}


class PrefixCounter:
    """Counts of a sentencepiece byte-pair model. Raises ValueError for a model that changes texts
    in other ways than writing blanks as pieces, or has pieces of the user's own."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        trained, normal = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (trained.model_type != 2 or trained.treat_whitespace_as_suffix or normal.precompiled_charsmap
                or normal.remove_extra_whitespaces or not normal.escape_whitespaces or kinds & {4, 5}):
            raise ValueError("the model is no plain byte-pair model")
        self.score = {p.piece: p.score for p in model.pieces if p.type == 1}
        self.fallback = trained.byte_fallback
        self.dummy = normal.add_dummy_prefix
        self.longest = max(map(len, self.score))
        known = {c for piece in self.score for c in piece}
        if not known <= set(self.score) or any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError("the pieces of the model reach over words")
        ascii = [chr(c) for c in range(33, 127)] + list("\t\n\r\x0b\x0c")
        alone = [c for c in ascii if c not in known]
        # Marks that no piece has behind a letter or digit: a text falls apart between the two.
        inside = {y for piece in self.score for x, y in zip(piece, piece[1:]) if _WORD.match(x)}
        marks = [c for c in ascii if c in known and c not in inside and not _WORD.match(c) and c != "_"]
        marks, alone = ("".join(map(re.escape, c)) for c in (marks, alone))
        free, sign = (rf"(?:_|[^{BLANK}{alone}{more}\w])" for more in (marks, ""))
        self.parts = re.compile(
            rf"[{alone}]|{BLANK}*+{sign}*+(?:[^\W_]++(?:{free}{sign}*+)?+)*+").findall
        self.follows: dict[tuple[str, str], bool] = {}
        self.kept: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text: best union first, the leftmost of equal ones."""
        held, get, none = list(text), self.score.get, -float("inf")
        scores = [get(x + y, none) for x, y in zip(held, held[1:])]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            held[i:i + 2] = [held[i] + held[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(held[i - 1] + held[i], none)
            if i < len(scores):
                scores[i] = get(held[i] + held[i + 1], none)
        return held

    def may_follow(self, pair: tuple[str, str]) -> bool:
        if len(self.follows) > MOST_PAIRS:
            self.follows.clear()
        found = self.follows[pair] = self.merged(pair[0] + pair[1]) == [t for t in pair if t]
        return found

    def extend(self, part: str, last: list[str], count: list[int]) -> None:
        """Add last token and count of each further prefix of a part to those known."""
        longest, score, known, learn = self.longest, self.score, self.follows.get, self.may_follow
        done = len(last) - 1
        for end in range(done + 1, len(part) + 1):
            for size in range(1, min(end, longest) + 1):
                token = part[end - size:end]
                if token in score or size == 1:
                    pair = (last[-size], token)
                    follows = known(pair)
                    if follows or follows is None and learn(pair):
                        break
            else:
                raise ValueError("a prefix has no last token")
            weight = 1
            if size == 1 and self.fallback and token not in score:
                weight = len(token.encode("utf-8", "surrogatepass"))
            last.append(token)
            count.append(count[-size] + weight)

    def changes(self, part: str) -> bytes:
        """One signed byte per code point: the count of the prefix that ends there less the count
        of the one before. A long part is taken in steps that keep what a piece can reach."""
        out, last, count = [], [""], [0]
        for at in range(0, len(part), 1 << 16):
            reach = min(at, self.longest)
            last, count = last[-reach - 1:], [c - count[-1] for c in count[-reach - 1:]]
            self.extend(part[at - reach:at + (1 << 16)], last, count)
            out.append(np.diff(np.array(count[reach:], np.int64)).astype(np.int8).tobytes())
        return b"".join(out)

    def learn(self, parts: list[str]) -> None:
        """Keep the changes of new parts; in order, each goes on where it leaves the one before."""
        before, last, count = "", [""], [0]
        for part in sorted(parts):
            same = 0
            for x, y in zip(before, part):
                if x != y:
                    break
                same += 1
            del last[same + 1:], count[same + 1:]
            self.extend(part, last, count)
            self.kept[part] = bytes([y - x & 255 for x, y in zip(count, count[1:])])
            before = part

    def prefixes(self, texts: list[str]) -> list[np.ndarray]:
        """The change of the count at every code point of some whole texts."""
        split = [self.parts((BLANK if self.dummy else "") + t.replace(" ", BLANK)) if t else [] for t in texts]
        new, long = set(), {}
        for parts in split:
            new.update(parts)
        new = [p for p in new if p not in self.kept]
        for part in new:
            if len(part) > LONGEST_KEPT:
                long[part] = self.changes(part)
            elif part in self.older:
                self.kept[part] = self.older[part]
        self.learn([p for p in new if p not in long and p not in self.kept])
        out = []
        for parts in split:
            look = (lambda p: long[p] if p in long else self.kept[p]) if long else self.kept.__getitem__
            found = np.frombuffer(b"".join(map(look, parts)), np.int8)
            if self.dummy and len(found):  # the blank in front belongs to the first code point
                found = found[1:].copy()
                found[0] += 1
            out.append(found)
        if len(self.kept) > MOST_KEPT:
            self.older, self.kept = self.kept, {"": b""}
        return out


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a model: loaded once."""
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def prefix_counts(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text",
                  limit: int = LIMIT) -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), n_chars, n_tokens, over_limit (n_tokens > limit) and
    `prefix`, a signed byte per code point whose running sum is the count of each prefix.

    A null or empty text has no tokens. Repeated rows are counted each; a null id stays null.
    Strings that name control pieces are plain text. Other columns are not read. No shuffle.
    """
    types = {"id": None, "n_bytes": pa.int64(), "n_chars": pa.int64(), "n_tokens": pa.int64(),
             "prefix": pa.binary()}

    def count(batches):
        tool = counter(model)
        for b in batches:
            rows, held, sizes = [], [], []
            for i, body in enumerate(b.column(1), 1):
                raw = body.as_buffer()
                held.append(bytes(raw).decode("utf-8", "replace"))
                sizes.append(len(raw))
                if sum(sizes) >= STEP or i == b.num_rows:
                    rows += [(n, len(p), int(p.sum(dtype=np.int64)), p.tobytes())
                             for n, p in zip(sizes, tool.prefixes(held))]
                    held, sizes = [], []
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield batch({"id": b.column(0), **dict(zip(list(types)[1:], columns))}, types)

    kind = docs.schema[id].dataType.simpleString()
    made = docs.select(F.col(id).alias("id"), utf8(text).alias("b")).mapInArrow(
        count, f"id {kind}, n_bytes long, n_chars long, n_tokens long, prefix binary")
    return made.select(F.col("id").alias(id), "n_bytes", "n_chars", "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"), "prefix")


def _answered(counted: DataFrame, asked: str, name: str, answer) -> DataFrame:
    columns = [c for c in counted.columns if c != name]
    schema = counted.select(*columns).schema.add(name, "long")

    def look(batches):
        for b in batches:
            found = [None if q is None or p is None else answer(np.frombuffer(p, np.int8), q)
                     for p, q in zip(b.column("prefix").to_pylist(), b.column(asked).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(found, pa.int64())],
                                             names=[*columns, name])

    return counted.mapInArrow(look, schema)


def tokens_before(counted: DataFrame, at: str, name: str = "n_before") -> DataFrame:
    """counted with the exact token count of each row's first `at` code points, from the stored
    prefixes. `at` beyond the text counts all of it, below 0 nothing; null gives null."""
    return _answered(counted, at, name, lambda p, n: int(p[:max(0, n)].sum(dtype=np.int64)))


def longest_within(counted: DataFrame, budget: str, name: str = "n_fit") -> DataFrame:
    """counted with the code points of the longest prefix of at most `budget` tokens, from the
    stored prefixes. A longer prefix may have fewer tokens: the longest counts. A budget below 0
    gives 0, null gives null."""
    def longest(p, most):
        fits = np.flatnonzero(np.cumsum(p, dtype=np.int64) <= most)
        return int(fits[-1]) + 1 if len(fits) else 0

    return _answered(counted, budget, name, longest)
