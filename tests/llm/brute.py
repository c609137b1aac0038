"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import math
import re
import zlib

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text, size=5):
    w = words(text)
    if not w:
        return []
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)]


def near(rows):
    """{position: (n, smallest id reachable)} by comparing all pairs."""
    sets = [set(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (len(sets[i]), min(ids) if ids else None)
    return out


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = ("assign", "access", "hex", "markov")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def digest_text(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def crc(value):
    return zlib.crc32(str("" if value is None else value).encode())


def contained(text, items):
    """{item: best weighted similarity} over all windows of the item's length."""
    s, out = shingles(text), {}
    for item, words_ in items:
        t = collections.Counter(shingles(words_))
        n = sum(t.values())
        if not n or not s or item is None:
            continue
        width = min(n, len(s))
        for i in range(len(s) - width + 1):
            w = collections.Counter(s[i : i + width])
            least = sum((w & t).values())
            most = sum((w | t).values())
            if 100 * least >= 75 * most:
                out[item] = max(out.get(item, 0), least / most)
    return out


def base_scores(rows):
    """[(held out, tokens, known, N, base score)]"""
    end = ("end",)
    said = [[*words(t), end] for _, t in rows]
    out_of = [crc(i) % 7 == 2 for i, _ in rows]
    count = collections.Counter(w for s, h in zip(said, out_of, strict=True) if not h for w in s)
    n, v = sum(count.values()), len(count)
    score = lambda s: sum(math.log10((count[w] + 1) / (n + v + 1)) for w in s)
    return [(h, len(s), sum(count[w] > 0 for w in s), n, score(s)) for s, h in zip(said, out_of, strict=True)]


def backoff_scores(rows, share, discount=0.5):
    """log10 probability of each text by walking the automaton token by token."""
    end = ("end",)
    said = [[*words(t), end] for _, t in rows]
    learned = [s for s, (i, _) in zip(said, rows, strict=True) if crc(i) % 7 != 2]
    c1 = collections.Counter(w for s in learned for w in s)
    n, v = sum(c1.values()), len(c1)
    least = max(1, math.ceil(share * n))
    frequent = {w for w, c in c1.items() if c >= least}
    grams = {
        k: collections.Counter(tuple(s[i : i + k]) for s in learned for i in range(len(s) - k + 1) if set(s[i : i + k]) <= frequent)
        for k in (2, 3)
    }
    kept = {k: {g: c for g, c in grams[k].items() if c >= max(2, least)} for k in (2, 3)}
    p1 = lambda w: (c1[w] + 1) / (n + v + 1)
    arcs = collections.defaultdict(dict)
    for (a, b), c in kept[2].items():
        arcs[(a,)][b] = (c - discount) / c1[a]
    for (a, b, w), c in kept[3].items():
        arcs[(a, b)][w] = (c - discount) / kept[2][(a, b)]
    fail = {}
    for state in sorted(arcs, key=len):
        left = 1 - sum(arcs[state].values())
        below = 1 - sum(prob(arcs, fail, p1, state[1:], w) for w in arcs[state])
        fail[state] = max(left, 1e-12) / max(below, 1e-12)
    out = []
    for s in said:
        state, total = (), 0.0
        for w in s:
            total += math.log10(prob(arcs, fail, p1, state, w))
            state = (*state, w)[-2:]
            while state and state not in arcs:
                state = state[1:]
        out.append(total)
    return out


def prob(arcs, fail, p1, state, w):
    weight = 1.0
    while state:
        if state in arcs:
            if w in arcs[state]:
                return weight * arcs[state][w]
            weight *= fail[state]
        state = state[1:]
    return weight * p1(w)
