"""Token ids of whole texts by the tokenizers library, with a cache of words.

A text of plain characters falls apart at places where the library's own rules always cut it too,
whatever stands around; each distinct part is encoded by the library and looked up while the worker
keeps it. Any other text, and one that may hold a special string, goes to the library as a whole, which
treats both as it does by default.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

# Of these characters it is certain how they are normalised, lowered and told apart as white space.
_ODD = re.compile("[^\t\n\r -~\xa1-\xac\xae-ɏ]")

_L = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-ɏ"
_U = r"A-Z\xc0-\xd6\xd8-\xde"
_N = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_APOSTROPHE = "'(?:s|t|re|ve|m|ll|d)"
# Inside a part between blanks the library cuts between letters, digits and all other characters.
_CUT = {
    "words": re.compile(rf"{_APOSTROPHE}|[{_L}]+|[{_N}]|[^ \t\n\r{_L}{_N}]+").findall,
    "bytes": None,  # its parts are words already
}
# Bytes as the models of both files write them: printable ones as they are, the others from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}


def _written(text: str) -> str:
    return text.encode().decode("latin-1").translate(_WRITTEN)


def _words(text: str) -> list[str]:
    """Lower-cased words; white space is dropped, and no token reaches over it."""
    return text.lower().split()


_PIECES = re.compile(rf"{_APOSTROPHE}| ?[{_L}{_U}]+| ?[{_N}]+| ?[^ \t\n\r{_L}{_U}{_N}]+"
                     r"|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]").findall

# A blank goes with the word behind it; other white space stands alone, but for its last one.
_PARTS = {"words": _words, "bytes": _PIECES}
_TRIED = ["don't", "'RE23're", "..'s", "é9²", "\x7f!", "zzzqx", "a_b-c", "\x02"]
MOST_KEPT = 300_000  # parts of a worker's cache, after which those met once since the last time are dropped
MOST_CHARS = 8 << 20  # characters of its parts, likewise
MOST_WORDS = 300_000  # words of parts, of one generation; a worker holds two
LONGEST_KEPT = 64  # characters of a part, or word, that is kept
_loaded: dict[str, Encoder] = {}


class Numbers(dict):
    """The number of each part; a new one gets the next."""

    def __init__(self, parts: list[str] = ()):
        super().__init__(zip(parts, range(len(parts))))
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number

    def of(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))


class Encoder:
    """kind "words" for a lower-casing BPE of words, "bytes" for a byte-level BPE, None to send
    every text to the library as a whole."""

    def __init__(self, path: str, kind: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _PARTS[kind] if kind else None
        self.number = Numbers()
        self.ids, self.starts = array("I"), array("q", [0])  # ids of all parts, and where those of each begin
        self.met = np.zeros(0, np.int64)  # how often each part was met
        self.chars = 0
        # Texts with what may be a special string go to the library, which knows them.
        special = os.path.commonprefix([t.content for t in self.tokenizer.get_added_tokens_decoder().values()])
        self.special = re.match("[^A-Za-z]*", special)[0]
        self.any_special = bool(self.tokenizer.get_added_tokens_decoder())
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        if kind:
            self.cut, self.model = _CUT[kind], self.tokenizer.model
            tried = [p for text in _TRIED for p in self.parts(text)]
            found = [self.number.of([p]) for p in tried]
            self.learn()
            if self.put_together(found) != self.library(tried):
                raise ValueError(f"the tokenizer does not cut texts like one of kind {kind!r}")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(texts)
        split, whole = {}, []
        for i, text in enumerate(texts):
            if self.parts is None or self.any_special and self.special in text or _ODD.search(text):
                whole.append(i)
            else:
                split[i] = self.number.of(self.parts(text))
        if whole:
            for i, ids in zip(whole, self.library([texts[i] for i in whole])):
                out[i] = ids
        if split:
            self.learn()
            for i, ids in zip(split, self.put_together(list(split.values()))):
                out[i] = ids
            if len(self.number) > MOST_KEPT or self.chars > MOST_CHARS:
                self.drop()
        return out

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def learn(self) -> None:
        """Keep the ids of new parts, put together from those of their words."""
        parts, self.number.new = self.number.new, []
        self.chars += sum(map(len, parts))
        keep, begin, tokenize = self.ids, self.starts, self.model.tokenize
        if self.cut is None:
            for written in _written("\0".join(parts)).split(_WRITTEN[0]) if parts else ():
                keep.fromlist([t.id for t in tokenize(written)])
                begin.append(len(keep))
            return
        if len(self.words) > MOST_WORDS:
            self.older_words, self.words = self.words, {}
        words, older, cut = self.words, self.older_words, self.cut
        for part in parts:
            for word in cut(part):
                ids = words.get(word)
                if ids is None:
                    ids = older.get(word)
                    if ids is None:
                        ids = array("I", [t.id for t in tokenize(_written(word))]).tobytes()
                    if len(word) <= LONGEST_KEPT:
                        words[word] = ids
                keep.frombytes(ids)
            begin.append(len(keep))

    def put_together(self, found: list[np.ndarray]) -> list[bytes]:
        """The ids of texts, each given as the numbers of its parts."""
        at = np.concatenate(found)
        met = np.bincount(at, minlength=len(self.number))
        met[:len(self.met)] += self.met
        self.met = met
        flat, bounds = self.gathered(at)
        bounds = bounds[np.cumsum([0, *map(len, found)])].tolist()
        return [flat[a:z].tobytes() for a, z in zip(bounds, bounds[1:])]

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts by number, one behind the other, and where each begins."""
        ids, starts = np.frombuffer(self.ids, "<u4"), np.frombuffer(self.starts, np.int64)
        first = starts[at]
        length = starts[at + 1] - first
        bounds = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(first - bounds[:-1], length)
        place += np.arange(len(place))
        return ids[place], bounds

    def drop(self) -> None:
        """Of the cache, keep the parts met again and again, at most half of what it may hold."""
        parts = list(self.number)  # in the order of their numbers
        most = np.sort(np.argsort(-self.met, kind="stable")[:MOST_KEPT // 2])
        at = [n for n in most[self.met[most] > 1].tolist() if len(parts[n]) <= LONGEST_KEPT]
        ids, starts = self.gathered(np.array(at, np.int64))
        self.ids, self.starts = array("I", ids.tobytes()), array("q", starts.tobytes())
        self.number.clear()
        parts = [parts[n] for n in at]
        self.number = Numbers(parts)
        self.met = np.zeros(len(parts), np.int64)
        self.chars = sum(map(len, parts))


def encoder(path: str, kind: str | None) -> Encoder:
    """The worker's encoder for a file: loaded once."""
    key = f"{kind}:{path}"
    if key not in _loaded:
        _loaded[key] = Encoder(path, kind)
    return _loaded[key]


def encoded(bodies, path: str, kind: str | None, most: int = 1 << 20):
    """Ids of each text of an iterable of UTF-8 bytes, some at a time."""
    tool, held, size = encoder(path, kind), [], 0
    for body in bodies:
        held.append(bytes(body).decode("utf-8", "replace"))
        size += len(body)
        if size >= most or len(held) >= 500:
            yield from tool.encode(held)
            held, size = [], 0
    if held:
        yield from tool.encode(held)
