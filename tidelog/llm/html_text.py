"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes a row of text blocks. A block's evidence (what it stands in, its length, the share
of it that is links) is its capacity to the content side or to the boilerplate side; neighbouring
blocks, and neighbours within one parent, are joined with a capacity that falls with their
distance in the DOM. The minimum cut is the labelling with the least disagreement.

Names of classes and ids are evidence, not verdicts: a name counts as a whole, or by the noun at its
end (`site-footer`, but not `has-sidebar`), and one that wraps nearly all prose of a page says
nothing about it. A page on which nothing is marked as content keeps its prose. Every step is linear
in the length of a page but for the cut itself.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batch

_TEXT = re.compile(r"[^<]+")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")  # once a quote is left open
_ATTRIBUTE = re.compile(r"""(?<![^\s=/"'>])([^\s=/"'>]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
# Elements by what they mean for a block.
_SKIPPED = frozenset("script style template noscript title svg math iframe object textarea select".split())
# What stands in these is no markup up to their own closing tag.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I | re.A)
        for t in "script style title textarea iframe noscript".split()}
_BODY = re.compile(r"<body(?=[\s/>])", re.I | re.A)
_SCRIPT = re.compile(r"<!---*>|-->|<!--|<script(?=[\s/>])|</script(?=[\s/>])[^>]*>?", re.I | re.A)
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTENT = frozenset("article main".split())
_BOILER = frozenset("nav footer aside menu dialog button".split())
_CONTENT_NAMES = frozenset("article content post entry story main body-text".split())
_BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer header login masthead menu modal nav navbar navigation newsletter notice "
    "notification pagination pager popup promo promoted related replies reply search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar topbar widget".split())
_NEGATED = frozenset("has no not with without is enabled disabled".split())
_PLACES = frozenset("area bar block box container content inner item items left links list right section slot wrap "
                    "wrapper".split())
_NAME = re.compile(r"[^a-z0-9]+")
# What an element says of itself.
SURE_BOILER, NAMED_BOILER, HEADER, HOLDS_CONTENT = "b", "n", "h", "c"
WRAPS = 90  # per cent of a page's prose, from which a name says nothing

# Capacities, in thousandths.
MARKED_CONTENT, MARKED_BOILER = 4000, 6000
PER_CHAR, MOST_CHARS, LINKS, BARE = 10, 400, 4000, 1000
ADJACENT, SIBLING = 1500, 500


class Block:
    __slots__ = ("at", "parts", "link")

    def __init__(self, at):
        self.at, self.parts, self.link = at, [], 0


def named(value: str) -> str:
    """What the names in a class, id or role say."""
    found = ""
    for name in value.split():
        words = [w for w in _NAME.split(name) if w]
        if not words or len(words) > 1 and _NEGATED & set(words):
            continue
        boiler = words[-1] in _BOILER_NAMES or words[0] in _BOILER_NAMES and _PLACES.issuperset(words[1:])
        if boiler:
            if words[-1] != "header":
                return NAMED_BOILER
            found = HEADER
        elif not found and (name in _CONTENT_NAMES or words[-1] in _CONTENT_NAMES):
            found = HOLDS_CONTENT
    return found


def mark(tag: str, attributes: str) -> str:
    """What an element says of what stands in it; nothing in most cases."""
    if tag in _BOILER:
        return SURE_BOILER
    found = ""
    if attributes and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role"):
                said = named(value)
                if said == NAMED_BOILER:
                    return said
                found = found or said
            elif name == "style" and re.search(r"display\s*:\s*none", value):
                return SURE_BOILER
            elif name == "aria-hidden" and value == "true":
                return SURE_BOILER
        if re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes):
            return SURE_BOILER
    if tag == "form":
        return NAMED_BOILER
    if tag == "header":
        return HEADER
    return HOLDS_CONTENT if tag in _CONTENT else found


def behind(page: str, tag: str, at: int, open_ended: set[str]) -> int:
    """The place behind the closing tag of a raw element whose text begins at `at`.

    As in HTML, a script inside a comment of a script closes with its own tag. An element that is
    never closed ends where the body begins, or with the page; that it is not is remembered.
    """
    depth = 0  # 1 inside a comment, 2 inside a script in it
    for m in _SCRIPT.finditer(page, at) if tag == "script" and tag not in open_ended else ():
        token = m.group()
        if token[:2] == "</":
            if depth < 2:
                return m.end()
            depth = 1
        elif token[-1] == ">":
            depth = 0
        elif token == "<!--":
            depth = max(depth, 1)
        elif depth:
            depth = 2
    m = None if tag in open_ended else _RAW[tag].search(page, at)
    if m:
        return m.end()
    open_ended.add(tag)
    m = _BODY.search(page, at)
    return m.start() if m else len(page)


class Page:
    """Text blocks in page order, and of each block element its parent, depth and mark by number."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        self.parent, self.depth, self.said = [0], [0], [""]
        self.read(page)

    def read(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]  # tag, number
        opened: Counter = Counter()
        now: Block | None = None
        links = at = 0
        skip, tags, open_ended = "", _TAG, set()
        last_end = page.rfind(">")  # behind it no tag is complete
        while at < len(page):
            m, tag = _TEXT.match(page, at), None
            if m is None:
                m = _COMMENT.match(page, at)
                if m:
                    at = m.end()
                    continue
                m = tags.match(page, at) if at < last_end else None
                if m is None and tags is _TAG and at < last_end and _LOOSE_TAG.match(page, at):
                    tags = _LOOSE_TAG
                    m = tags.match(page, at)
                if m:
                    tag = m.group(2)
            if tag is None:
                token = m.group() if m else "<"
                at = m.end() if m else at + 1
                if skip:
                    continue
                if now is None:
                    if not token.strip():
                        continue
                    now = Block(stack[-1][1])
                    self.blocks.append(now)
                now.parts.append(token)
                if links:
                    now.link += len(token.strip())
                continue
            at, tag, closing = m.end(), tag.lower(), m.group(1)
            if tag in _RAW and not closing and skip not in ("svg", "math"):
                if not m.group(3).endswith("/"):
                    at = behind(page, tag, at, open_ended)
                continue
            if skip:
                if closing and tag == skip:
                    skip = ""
                continue
            if tag in _SKIPPED:
                if not closing and not m.group(3).endswith("/"):
                    skip = tag
                continue
            if tag == "a":
                links = max(0, links - 1) if closing else links + 1
            if tag == "br":
                if now is not None:
                    now.parts.append(" ")
                continue
            if tag not in _BLOCKS:
                continue
            now, links = None, 0
            if closing:
                while opened[tag]:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == tag:
                        break
            elif tag not in _VOID:
                if stack[-1][0] == "p" or stack[-1][0] == tag and tag in (
                        "li", "option", "dt", "dd", "tr", "td", "th"):
                    opened[stack.pop()[0]] -= 1
                stack.append((tag, len(self.parent)))
                opened[tag] += 1
                above = stack[-2][1]
                self.parent.append(above)
                self.depth.append(self.depth[above] + 1)
                self.said.append(mark(tag, m.group(3)))

    def marks(self, prose: dict[int, int]) -> list[int]:
        """Of each element 1 if it holds content, -1 if boilerplate, else 0, given the characters
        outside links that stand in it. What stands in boilerplate is boilerplate."""
        inside = [0] * len(self.parent)
        sure = [False] * len(self.parent)
        for i in range(1, len(inside)):
            sure[i] = sure[self.parent[i]] or self.said[i] == SURE_BOILER
        for i, n in prose.items():
            inside[i] += n * (not sure[i])
        for i in range(len(inside) - 1, 0, -1):
            inside[self.parent[i]] += inside[i]
        out = [0] * len(inside)
        for i in range(1, len(out)):
            said, above = self.said[i], out[self.parent[i]]
            if said == NAMED_BOILER and 100 * inside[i] >= WRAPS * inside[0] > 0:
                said = ""
            if above < 0 or said in (SURE_BOILER, NAMED_BOILER) or said == HEADER and above == 0:
                out[i] = -1
            else:
                out[i] = 1 if said == HOLDS_CONTENT else above
        return out

    def apart(self, a: int, b: int) -> int:
        """Steps between two elements. Over all neighbours in page order each step is taken twice."""
        steps = 0
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            steps += 1
        return steps


def flow(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source side of a minimum cut (the largest such side)."""
    n = len(source)
    extra = [a - b for a, b in zip(source, sink)]  # what is left after source -> node -> sink
    links: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, c in edges:
        links[a].append(len(to))
        to.append(b)
        room.append(c)
        links[b].append(len(to))
        to.append(a)
        room.append(c)
    while True:  # Dinic: levels from all nodes with something to give, then paths along them
        level = [0 if x > 0 else -1 for x in extra]
        queue, reached = deque(i for i in range(n) if extra[i] > 0), False
        while queue:
            i = queue.popleft()
            for e in links[i]:
                j = to[e]
                if room[e] and level[j] < 0:
                    level[j] = level[i] + 1
                    reached |= extra[j] < 0
                    queue.append(j)
        if not reached:
            break
        nxt = [0] * n
        for start in range(n):
            while extra[start] > 0:
                path, i = [], start
                while True:
                    if i != start and extra[i] < 0:
                        break
                    while nxt[i] < len(links[i]):
                        e = links[i][nxt[i]]
                        if room[e] and level[to[e]] == level[i] + 1:
                            break
                        nxt[i] += 1
                    else:
                        if not path:
                            break
                        level[i] = -2
                        i = to[path.pop() ^ 1]
                        continue
                    path.append(e)
                    i = to[e]
                if not path:
                    break
                push = min(extra[start], -extra[i], *(room[e] for e in path))
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                extra[start] -= push
                extra[i] += push
    # Whatever can still reach the sink side is boilerplate, the rest content.
    lost = [x < 0 for x in extra]
    queue = deque(i for i in range(n) if lost[i])
    while queue:
        i = queue.popleft()
        for e in links[i]:
            j = to[e]
            if room[e ^ 1] and not lost[j]:
                lost[j] = True
                queue.append(j)
    return [not x for x in lost]


def main_text(page: str) -> str:
    """The blocks labelled content, one per line, white space in each turned into one space."""
    read, listed, prose = Page(page), [], Counter()
    for b in read.blocks:
        text = " ".join(html.unescape("".join(b.parts)).split())
        if text:
            share = min(1.0, b.link / len(text))
            listed.append((b.at, text, share))
            prose[b.at] += int(len(text) * (1 - share))
    if not listed:
        return ""
    marks = read.marks(prose)
    bare = BARE if any(marks[at] > 0 for at, _, _ in listed) else 0
    source, sink, edges = [], [], []
    last: dict[int, int] = {}
    for i, (at, text, share) in enumerate(listed):
        inside = marks[at]
        words = int(min(len(text), MOST_CHARS) * PER_CHAR * (1 - share))
        source.append(words * (inside >= 0) + (MARKED_CONTENT if inside > 0 else 0))
        sink.append(bare + int(LINKS * share) + (MARKED_BOILER if inside < 0 else 0))
        if i:
            edges.append((i - 1, i, ADJACENT // (1 + read.apart(listed[i - 1][0], at))))
        parent = read.parent[at] if at else -1
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    content = flow(source, sink, edges)
    return "\n".join(text for (_, text, _), kept in zip(listed, content) if kept)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: the id, the url, text (empty if there is none) and n_chars.

    A null page is empty. Pages that are cut off are read as far as they go. Repeated rows are
    read alike; other columns are not read.
    """
    types = {"id": None, "url": None, "text": pa.string(), "n_chars": pa.int64()}

    def read(batches):
        for b in batches:
            texts = [main_text(b.column(2)[i].as_py() or "") for i in range(b.num_rows)]
            yield batch({"id": b.column(0), "url": b.column(1), "text": texts,
                         "n_chars": [len(t) for t in texts]}, types)

    kinds = [pages.schema[c].dataType.simpleString() for c in (id, url)]
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(page).cast("string").alias("html"))
    out = rows.mapInArrow(read, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.select(F.col("id").alias(id), F.col("url").alias(url), "text", "n_chars")
