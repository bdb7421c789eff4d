"""Plain-Python versions of the operators, for small fixtures."""

import re
from collections import defaultdict
from hashlib import sha256

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(text):
    return sha256(text.encode()).hexdigest()


def decontamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        if not words:
            continue
        n = min(13, len(words))
        for i in range(len(words) - n + 1):
            windows[tuple(words[i:i + n])] |= {str(item)} if item is not None else set()
    out = []
    for doc, text in docs:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                got = windows.get(tuple(words[i:i + n]))
                if got is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc, len(words), len(hit), len(found), digest(",".join(sorted(found))),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def repeats(texts, length):
    """Per text: removed spans in bytes."""
    data = [(t or "").encode() for t in texts]
    count = defaultdict(int)
    for d in data:
        for i in range(len(d) - length + 1):
            count[d[i:i + length]] += 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans, start = [], None
        for i, g in enumerate(gone + [False]):
            if g and start is None:
                start = i
            elif not g and start is not None:
                spans.append((start, i))
                start = None
        out.append((len(d), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def shingles(text, k):
    words = SPACE_WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near(a, b, percent=80):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def near_duplicates(docs, k):
    """docs sorted by distinct id: (id, size, component, kept)."""
    sets = [shingles(t, k) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if near(sets[i], sets[j])]
    comp = components(len(docs), links)
    return [(d, len(s), docs[c][0], c == i) for i, ((d, _), s, c) in enumerate(zip(docs, sets, comp))]


def lines(docs, k=8, percent=80):
    """docs sorted by distinct id: text without repeated lines, lines, removed.
    A line of fewer than k characters has one shingle, its whole text."""
    every = [(i, no, line.strip(" \t\r")) for i, (_, t) in enumerate(docs) if t is not None
             for no, line in enumerate(t.split("\n"))]
    every = [x for x in every if x[2]]
    distinct = list(dict.fromkeys(line for *_, line in every))
    sets = [frozenset(x[i:i + k] for i in range(max(1, len(x) - k + 1))) for x in distinct]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if near(sets[i], sets[j], percent)]
    comp = dict(zip(distinct, components(len(sets), links)))
    seen, gone = set(), set()
    for i, no, line in every:
        if comp[line] in seen:
            gone.add((i, no))
        seen.add(comp[line])
    out = []
    for i, (d, t) in enumerate(docs):
        if t is None:
            out.append((d, None, 0, 0))
            continue
        parts = t.split("\n")
        left = [x for no, x in enumerate(parts) if (i, no) not in gone]
        out.append((d, "\n".join(left), len(parts), len(parts) - len(left)))
    return out


def cosine_links(rows, cosine=0.98):
    """rows (id, vector, label) with distinct ids: id → (links, component)."""
    from math import isfinite, sqrt
    ids = sorted(r[0] for r in rows)
    at = {d: i for i, d in enumerate(ids)}

    def usable(v, label):
        return label is not None and v and all(x is not None and isfinite(x) for x in v) and any(x != 0 for x in v)

    links = []
    good = [r for r in rows if usable(r[1], r[2])]
    for n, (a, x, k) in enumerate(good):
        for b, y, m in good[:n]:
            if k == m and len(x) == len(y):
                dot = sum(p * q for p, q in zip(x, y))
                if dot / (sqrt(sum(p * p for p in x)) * sqrt(sum(q * q for q in y))) >= cosine:
                    links.append((at[a], at[b]))
    comp = components(len(ids), links)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {d: (count[i], ids[comp[i]]) for i, d in enumerate(ids)}
