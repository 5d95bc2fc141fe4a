"""Plain restatements of the operators, over lists of rows in memory."""

import hashlib
import re

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())


def substrings(docs, size=13):
    words = [SPACE.findall((t or "").encode()) for _, t in docs]
    least = {}
    for (d, _), w in zip(docs, words, strict=True):
        if d is not None:
            for i in range(len(w) - size + 1):
                k = tuple(w[i : i + size])
                least[k] = min(d, least.get(k, d))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = set()
        if d is not None:
            for i in range(len(w) - size + 1):
                if least[tuple(w[i : i + size])] < d:
                    gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def near(docs, share=80, size=2):
    sets = []
    for _, t in docs:
        w = SPACE.findall(lower(t))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    ids = [d for d, _ in docs]
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        met = {}
        for x in s:
            for j in by[x]:
                if j < i:
                    met[j] = met.get(j, 0) + 1
        for j, both in met.items():
            if 100 * both >= share * (len(s) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        least[r] = min(d, least.get(r, d))
    return [(d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, d in enumerate(ids)]


def licenses(docs, phrases):
    out = []
    for d, t in docs:
        w = ALNUM.findall(lower(t))
        places, labels = [], set()
        for phrase, label in phrases:
            p = phrase.encode().split()
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
        out.append((d, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return out


def leaks(docs, items):
    """BM25 of every item for every passage, over plain words."""
    import math

    words = lambda t: ALNUM.findall(lower(t))
    runs = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    known = [(i, t, words(t)) for i, t in items if words(t)]
    mean = sum(len(w) for _, _, w in known) / max(1, len(known))
    df = {}
    for _, _, w in known:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = set()
    for item, text, w in known:
        weight = {}
        for x in set(w):
            f = w.count(x)
            weight[x] = math.log(1 + (len(known) - df[x] + 0.5) / (df[x] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(w) / mean))
        sentences = [words(x) for x in re.split(r"(?<=[.?!])\s+", text) if words(x)]
        last = max(len(sentences[-1]) if len(sentences) > 1 else 0, min(5, len(w)))
        question, answer, least = (w[:-last], w[-last:], 1) if len(w) - last >= 5 else (w, w, 2)
        step = 1
        while step < len(w):
            step *= 2
        for doc, body in docs:
            h = words(body)
            for lo in range(0, max(1, len(h) - step), step):
                part = h[lo : lo + 2 * step]
                if sum(v for x, v in weight.items() if x in part) / sum(weight.values()) < 0.5 - 1e-9:
                    continue
                good = True
                for side, small in ((question, 2), (answer, least)):
                    if len(side) < 5:
                        good &= side == part if not runs(part, 5) else False
                        continue
                    size = min(5, max(small, (len(side) + 1) // 6))
                    of = runs(side, size)
                    good &= len(of & runs(part, size)) >= 0.8 * len(of)
                if good:
                    out.add((doc, item))
    return out
