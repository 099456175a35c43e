"""Brute-force versions of the operators, for small tables."""

import collections
import hashlib
import re
import zlib

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def repeats(rows, size=200):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[s:s + size] for _, b in bodies for s in range(len(b) - size + 1))
    out = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if count[b[s:s + size]] > 1:
                gone[s:s + size] = b"\1" * size
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for p, q in zip(b"\0" + gone, gone) if q and not p)
        out.append((i, len(b), sum(gone), spans, sha(kept)))
    return sorted(out, key=repr)


def contamination(docs, items, size=13):
    windows = []
    for item, text in items:
        w = words(text)
        if w and item is not None:
            windows += [(str(item), w[k:k + size]) for k in range(max(1, len(w) - size + 1))]
    out = []
    for doc, text in docs:
        w, found = words(text), set()
        hit = [0] * len(w)
        for item, x in windows:
            for k in range(len(w) - len(x) + 1):
                if w[k:k + len(x)] == x:
                    found.add(item)
                    hit[k:k + len(x)] = [1] * len(x)
        n = sum(hit)
        out.append((doc, len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)))
    return sorted(out, key=repr)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(docs, k=2, percent=80):
    sets, up = [shingles(t, k) for _, t in docs], list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted([(d, len(sets[i]), least.get(top(i)), d == least.get(top(i)))
                   for i, (d, _) in enumerate(docs)], key=repr)


def quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = [0] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            hit[i:i + 8] = [1] * 8
    n, r = len(w), sum(hit)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), r,
            n < 20 or 100 * r > 30 * n)


def phrases(text, listed):
    w, starts, labels = words(text), [], set()
    for phrase, label in listed.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def chats(rows):
    by = collections.defaultdict(list)
    for conv, *turn in rows:
        by[conv].append(turn)
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
        loss = "".join(t or "" for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha(said), len(loss), sha(loss)))
    return sorted(out, key=repr)


def damage(rows):
    """(conv, turn, role, text) after the damage of the repair contract, in order."""
    by = collections.OrderedDict()
    said = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * (kind != 0) * (1 + (kind == 3)))
    for listed in by.values():
        listed.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return by


def repairs(rows):
    white = " \t\n\x0b\x0c\r"
    step = lambda q, x: {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, x))
    out = []
    for conv, listed in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in listed:
            body = text.rstrip(white)
            faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-")
            seen.add((role, text))
        best = {0: (0, "", ())}
        inserts = lambda best: [(q2, (c + 5, e + "I", k + (w + ":",))) for q, (c, e, k) in best.items()
                                for x, w in (("u", "user"), ("a", "assistant")) if (q2 := step(q, x)) is not None]

        def closed(best):
            for _ in range(3):
                for q, way in inserts(best):
                    best[q] = min(best.get(q, way), way)
            return best

        for (_, role, text), fault in zip(listed, faults):
            after = {}
            for q, (c, e, k) in closed(best).items():
                ways = [(q, (c + 2, e + "D", k))]
                if fault in "t-":
                    more = 5 * (fault == "t")
                    if step(q, role[:1]) is not None:
                        ways.append((step(q, role[:1]), (c + more, e + "K", k + (f"{role}:{text}",))))
                    ways += [(step(q, x), (c + 1 + more, e + "R", k + (f"{w}:{text}",)))
                             for x, w in (("u", "user"), ("a", "assistant")) if step(q, x) is not None]
                for q2, way in ways:
                    after[q2] = min(after.get(q2, way), way)
            best = after
        assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in k)) for q, (_, _, k) in best.items() if q in (0, 3))
        cost, audit, kept = min(way for q, way in closed(best).items() if q in (0, 3))
        turns = [t for t, _, _ in listed if t is not None]
        initials = [r[:1] for _, r, _ in listed]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"),
                    faults.count("d"), faults.count("t"),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
                    cost, audit, sha("\n".join(kept))))
    return sorted(out, key=repr)


def collocations(rows, least=30, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    many = [p for p, a in f.items() if len(p) > 2 and a >= least]
    gone = {(p[0], *p[i:i + k]) for p in many for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1)
            if 100 * f[p] >= 80 * f[(p[0], *p[i:i + k])]}
    by = collections.defaultdict(list)
    for p in many:
        if p not in gone:
            lang, w, a = p[0], p[1:], f[p]
            score, _, l, r = min((2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k,
                                  f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
            by[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, found in by.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))
