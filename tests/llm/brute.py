"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def closure(ids, links):
    """The smallest id reachable from each id."""
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows):
    prints = {i: simhash(t) for i, t in rows}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    return prints, closure(ids, links)


def best_two_fit(lengths, capacity):
    """Bins, filled one by one."""
    left, bins = Counter(lengths), []
    while left:
        out, gap = [], capacity
        while fits := [x for x in left if x <= gap]:
            x = max(fits)
            out.append(x)
            gap -= x
            left[x] -= 1
            left += Counter()
        room = out[-1] + gap
        pairs = [(a + b, a, b) for a in left for b in left if b <= a and a + b <= room and (a != b or left[a] > 1)]
        if pairs and max(pairs)[0] > out[-1]:
            _, a, b = max(pairs)
            left[out.pop()] += 1
            out += [a, b]
            left.subtract([a, b])
            left += Counter()
        bins.append(sorted(out, reverse=True))
    return bins


def statistics(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def kneser_ney(train):
    """Known counts and the log10 probability function of texts, learned from ``train``."""
    from math import log10

    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    count = Counter(x for t in train for x in tokens(t))
    pairs = Counter(p for t in train for p in zip(["<s>", *tokens(t)], tokens(t)))

    def discounts(values):
        n = Counter(min(v, 5) for v in values)
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3))]

    left = Counter(b for _, b in pairs)
    d, e = discounts(pairs.values()), discounts(left.values())
    V, N, types = len(count), sum(count.values()), len(pairs)
    spare = sum(e[min(x, 3)] for x in left.values())
    follow, total = defaultdict(float), Counter()
    for (a, _), n in pairs.items():
        follow[a] += d[min(n, 3)]
        total[a] += n

    def lower(w):
        return (max(left[w] - e[min(left[w], 3)], 0) + spare / (V + 1)) / types if types else 1 / (V + 1)

    def chance(a, b):
        if not total[a]:
            return lower(b)
        return (max(pairs[a, b] - d[min(pairs[a, b], 3)], 0) + follow[a] * lower(b)) / total[a]

    def scores(t):
        ts = tokens(t)
        base = sum(log10((count[x] + 1) / (N + V + 1)) for x in ts)
        return len(ts), sum(count[x] > 0 for x in ts), base, sum(log10(chance(a, b)) for a, b in zip(["<s>", *ts], ts))

    return N, scores
