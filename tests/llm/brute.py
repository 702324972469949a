"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


FORMS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def personal(text):
    found = sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(FORMS) for m in re.finditer(p, text) if ok(m.group()))
    return ",".join(f"{FORMS[i][0]}:{a}:{b}" for a, i, b in found)


def secrets(text, rules):
    found = []
    for i, r in enumerate(rules):
        for m in re.finditer(f"(?:{r.head})({r.tail}+)", text):
            if len(m[1]) >= r.least:
                found.append((m.start(), i, m.end()))
    return ",".join(f"{rules[i].kind}:{a}:{b}" for a, i, b in sorted(found))


def figures(text):
    words = SPACE.findall(text)
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(threes)
    covered = {j for i, t in enumerate(threes) if times[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def contamination(texts, items, n=13):
    windows = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall(lower(text or ""))
        size = min(n, len(words))
        for i in range(len(words) - size + 1):
            if size:
                windows[tuple(words[i : i + size])].add(str(item))
    out = []
    for text in texts:
        words, hit, found = PLAIN.findall(lower(text or "")), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= own
        out.append((len(words), len(hit), sorted(found)))
    return out


def shingles(text, k):
    words = lower(text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def near(docs, k, percent=80):
    """doc_id -> (size of its set, smallest doc_id reachable); docs are pairs."""
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(docs, length):
    """doc_id -> (stretches, kept bytes); docs are pairs (doc_id, bytes) with distinct ids."""
    seen, out = set(), {}
    for i, data in sorted(docs):
        marked = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                marked[s : s + length] = b"\1" * length
            seen.add(window)
        stretches = [m.span() for m in re.finditer(b"\1+", bytes(marked))]
        out[i] = (stretches, bytes(x for x, gone in zip(data, marked, strict=True) if not gone))
    return out


def pieces(vocabulary, word):
    at = count = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return -1
        at, count = end, count + 1
    return count


def best_fit(sizes, capacities, opened):
    """Bins as lists of sizes, placed one by one in descending order; among equal rooms, the one that is so for longest."""
    sizes = sorted(sizes, reverse=True)
    bins = []  # capacity, contents, when the room last changed
    for i, size in enumerate(sizes):
        fits = [b for b in bins if b[0] - sum(b[1]) >= size]
        if fits:
            best = min(fits, key=lambda b: (b[0] - sum(b[1]), b[2]))
        else:
            left = sum(1 for x in sizes[i:] if x == size)
            best = [opened(size, left, sum(x for x in sizes[i:] if x < size), capacities), [], i]
            bins.append(best)
        best[1].append(size)
        best[2] = i
    return sorted((min(c for c in capacities if c >= sum(b[1])), tuple(b[1])) for b in bins)
