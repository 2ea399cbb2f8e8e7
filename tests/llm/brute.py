"""Plain versions of the operators over lists of (doc_id, text), for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def words(text):
    return WORD.findall((text or "").encode())


def window_dedup(docs, size=20):
    seen, out = set(), []
    for i, text in sorted(docs):
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - size + 1):
            key = tuple(own[k : k + size])
            if key in seen:
                gone[k : k + size] = [True] * size
            seen.add(key)
        out.append((i, len(own), sum(gone), sha(b" ".join(w for w, g in zip(own, gone) if not g))))
    return out


def byte_dedup(docs, size=100):
    seen, out = set(), []
    for i, text in sorted(docs):
        own = (text or "").encode()
        gone = bytearray(len(own))
        for k in range(len(own) - size + 1):
            key = own[k : k + size]
            if key in seen:
                gone[k : k + size] = b"\1" * size
            seen.add(key)
        out.append((i, len(own), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(own, gone) if not g))))
    return out


class Union(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def shingles(text, size):
    own = words((text or "").encode().lower().decode())
    return {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if len(own) >= size else {tuple(own)} - {()}


def jaccard(docs, size=3, percent=90):
    sets, holders, parts = {i: shingles(t, size) for i, t in docs}, collections.defaultdict(list), Union()
    for i in sorted(sets):
        for j, n in collections.Counter(j for g in sets[i] for j in holders[g]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                parts.link(i, j)
        for g in sets[i]:
            holders[g].append(i)
    return [(i, len(sets[i]), parts.root(i)) for i in sorted(sets)]


def mixture(rows, weights=(3, 1, 2)):
    """(doc_id, size, taken) of rows (doc_id, text, source), by going through the epochs word by word."""
    size = {i: len(words(t)) for i, t, _ in rows}
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in names}
    target, open_ = {s: 0.0 for s in names}, set(names)
    left = 1.5 * sum(total.values())
    while open_ and left > 1e-9:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        for s in share:
            target[s] += share[s]
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * total[s]:
                left += target[s] - 2 * total[s]
                target[s] = 2.0 * total[s]
                open_.discard(s)
    taken = collections.Counter()
    for s in names:
        rest = int(round(target[s], 6))
        order = sorted((i for i, _, x in rows if x == s), key=lambda i: hashlib.md5(f"{i}:mix-1".encode()).hexdigest())
        while rest > 0 and total[s]:
            for i in order:
                n = min(size[i], rest)
                taken[i] += n
                rest -= n
    return [(i, size[i], target[s], taken[i]) for i, _, s in sorted(rows, key=lambda r: r[0])]
