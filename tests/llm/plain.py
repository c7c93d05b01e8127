"""Plain Python versions that the operators are compared with."""

import itertools
import re

ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(t):
    return ALNUM_WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, k):
    w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components_of(docs, k):
    up = {i: i for i, _ in docs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    sets = {i: shingles(t, k) for i, t in docs}
    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            p, q = find(a), find(b)
            up[max(p, q)] = min(p, q)
    return {i: find(i) for i in up}, {i: len(s) for i, s in sets.items()}


def lines_without_repeats(docs, min_words=20, long_line=50):
    """{id: lines left} for rows (id, text) with distinct ids, by positions and sets instead of hashes."""
    lines = {i: t.split("\n") for i, t in docs}
    words = lambda x: x.count(" ") + 1
    places = {}
    for i, ls in lines.items():
        for at in range(len(ls) - 1):
            places.setdefault((ls[at], ls[at + 1]), []).append((i, at))
    shared = {p for where in places.values() if len(where) > 1 for p in where}
    live = set()
    for i, ls in lines.items():
        at = 0
        while at < len(ls):
            end = at
            while (i, end) in shared:
                end += 1
            if end > at and sum(words(x) for x in ls[at:end + 1]) >= min_words:
                live |= {(i, k) for k in range(at, end)}
            at = end + 1
    pair = lambda i, at: (lines[i][at], lines[i][at + 1]) if (i, at) in live else None
    one = {}
    for d in (-1, 1):
        around = {}
        for i, at in live:
            around.setdefault(pair(i, at), set()).add(pair(i, at + d))
        one[d] = {p for p, s in around.items() if len(s) == 1 and None not in s}
    chunks = {}
    for i, at in sorted(live):
        if pair(i, at - 1) and pair(i, at) in one[-1] and pair(i, at - 1) in one[1]:
            continue
        end = at
        while pair(i, end + 1) and pair(i, end + 1) in one[-1] and pair(i, end) in one[1]:
            end += 1
        first = at + (pair(i, at) in one[-1])
        last = end + 1 - (pair(i, end) in one[1])
        if first <= last:
            chunks.setdefault(tuple(pair(i, k) for k in range(at, end + 1)), []).append((i, first, last))
    gone, held = set(), set()
    for where in chunks.values():
        for k, (i, a, b) in enumerate(sorted(where)):
            if len(where) > 1:
                (gone if k else held).update((i, x) for x in range(a, b + 1))
    gone -= held
    seen = set()
    for i in sorted(lines):
        for at, x in enumerate(lines[i]):
            if words(x) >= long_line:
                if x in seen:
                    gone.add((i, at))
                seen.add(x)
    return {i: [x for at, x in enumerate(ls) if (i, at) not in gone] for i, ls in lines.items()}
