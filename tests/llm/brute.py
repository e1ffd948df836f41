"""Plain versions of the operators for small inputs, and texts for the tests."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORDS = [a + b for a in "ba ke lo mi nu ra se ti vo zu".split() for b in "n r st l m ck".split()]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, text) rows with nulls, blanks, repeats, copies, near copies, shared passages, a long text, and repeated rows."""
    rows = [(i, prose(i, 40 + 13 * i % 90)) for i in range(30)]
    passage = prose(777, 60)
    rows += [(100 + i, f"{prose(200 + i, 30)}\n{passage}\t {prose(300 + i, 20)}") for i in range(5)]
    base = prose(5, 120).split()
    for i in range(6):
        w = list(base)
        w[10 + 15 * i] = "changed"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "one two three"), (305, "one  two\nthree"), (306, "é" * 300 + " " + "ñandú " * 80)]
    rows += [(310, "again " * 400), (311, "again " * 400), (320, prose(9, 6000)), (321, prose(9, 6000) + " tail"), (7, rows[7][1]), (None, rows[3][1]), (None, None)]
    return rows


def kept_words(rows, length=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - length + 1):
            if i is not None:
                key = tuple(w[k : k + length])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def kept_bytes(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k : k + length] for b in raws for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, raws):
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_classes(rows, threshold=0.8, weigh=None):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(p and q and len(p & q) / len(p | q) >= threshold for p in sets[a] for q in sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def contaminated(docs, items, n=5, threshold=0.8):
    sizes = {min(n, len(tokens(t))) for _, t in items} | {n}
    grams = lambda t, of: {" ".join(w[k : k + m]) for w in [tokens(t)] for m in of(len(w)) for k in range(len(w) - m + 1) if m}
    found, by_item = set(), defaultdict(set)
    for i, t in items:
        if i is not None:
            by_item[i] |= grams(t, lambda size: {min(n, size)})
    for d, t in docs:
        g = grams(t, lambda size: sizes)
        for i, s in by_item.items():
            if d is not None and s and len(s & g) >= threshold * len(s) - 1e-9:
                found.add((d, i, len(s), len(s & g)))
    return found
