"""Plain versions of the operators, pair by pair."""

import hashlib
import re
from collections import Counter, defaultdict

WS = re.compile(r"[\x20\x09-\x0D]+")


def split(text):
    return [w for w in WS.split(text or "") if w]


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[WS.sub("", t or "")].append((-len(t or ""), d))
    out = []
    for k, g in groups.items():
        g.sort()
        for i, (_, d) in enumerate(g):
            out.append((d, g[0][1], len(g), i == 0, hashlib.sha256(k.encode()).hexdigest()))
    return Counter(out)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, n=4):
    w = split(lower(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(rows, n=4, percent=85):
    sets = {d: shingle_set(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(rows, window=13):
    ws = [(d, split(t)) for d, t in rows]
    least = {}
    for d, w in ws:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(least.get(k, d), d)
    out = Counter()
    for d, w in ws:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def boilerplate(rows, sites):
    seen = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if k := re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line):
                seen[k].add(s or "")
    out = Counter()
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(seen.get(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x), ())) < sites]
        out[d, len(lines), len(lines) - len(stay), "\n".join(stay)] += 1
    return out
