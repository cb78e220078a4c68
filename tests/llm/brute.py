"""Plain results of the operators' definitions, for small inputs."""

import hashlib
import math
import re
from collections import Counter
from fractions import Fraction

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_sets(docs, n=5):
    out = []
    for _, text in docs:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
        words = WORD.findall(raw)
        whole = {tuple(words)} if words else set()
        out.append(whole if len(words) < n else {tuple(words[k : k + n]) for k in range(len(words) - n + 1)})
    return out


def jaccard_components(docs, percent=80):
    """``(id, set size, smallest id reached)`` per row; rows are told apart by their place."""
    sets, parent = shingle_sets(docs), list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [
        (key, len(sets[i]), None if key is None else least[root(i)]) for i, (key, _) in enumerate(docs)
    ]


def without_repeats(docs, length):
    """``(id, bytes, removed, spans, kept)`` per row."""
    raw = [(key, (text or "").encode()) for key, text in docs]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for key, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def without_later_lines(docs, min_words):
    """Texts without runs of lines that also start earlier; documents in order, each once."""
    lines = [text.split("\n") for _, text in docs]
    out = []
    for d, own in enumerate(lines):
        gone = set()
        for i in range(len(own)):
            longest = 0
            for e in range(d + 1):
                for j in range(len(lines[e]) if e < d else i):
                    k = 0
                    while i + k < len(own) and j + k < len(lines[e]) and own[i + k] == lines[e][j + k]:
                        k += 1
                    longest = max(longest, k)
            if sum(len(x.split(" ")) if x.strip(" ") else 0 for x in own[i : i + longest]) >= min_words:
                gone.update(range(i, i + longest))
        out.append("\n".join(x for i, x in enumerate(own) if i not in gone))
    return out


def top(vectors, asked, k, score):
    """``(query, rank, id, score)``; vectors are ``(id, components)``, each row once."""
    rows = sorted(set((i, tuple(v)) for i, v in vectors))
    out = []
    for q, v in rows:
        if asked(q):
            found = sorted((-score(v, w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def shares(children, budget):
    """Budget per child ``(weight, capacity)`` by filling all at one level until it is spent."""
    got, open_ = {}, dict(children)
    budget = min(budget, sum(c for w, c in children.values() if w > 0))
    open_ = {k: v for k, v in open_.items() if v[0] > 0}
    while open_:
        level = budget / sum(w for w, _ in open_.values())
        short = [k for k, (w, c) in open_.items() if c <= level * w]
        if not short:
            return got | {k: level * w for k, (w, _) in open_.items()}
        for k in short:
            got[k] = open_.pop(k)[1]
            budget -= got[k]
    return got


def feistel(x, rows, seed, half_bits, round_keys, prime):
    upper_bits, lower_bits = half_bits(rows)
    while True:
        upper, lower = x >> lower_bits, x & ((1 << lower_bits) - 1)
        for i, (factor, plus) in enumerate(round_keys(seed)):
            source, bits = (lower, upper_bits) if i % 2 == 0 else (upper, lower_bits)
            t = (source * factor + plus) % prime
            mixed = ((t * t) % prime >> 3) & ((1 << bits) - 1)
            if i % 2 == 0:
                upper ^= mixed
            else:
                lower ^= mixed
        x = upper << lower_bits | lower
        if x < rows:
            return x


def alignments(docs, encode, first, second):
    """``(id, n_a, n_b, groups, n_best, count_sum, links)`` per row, from whole texts and loops.

    ``encode`` gives the ids of a text in both vocabularies, ``first`` and ``second`` map ids to bytes.
    """
    rows, held = [], Counter()
    for key, text in docs:
        a, b = encode(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(first[i] for i in a) != raw or b"".join(second[i] for i in b) != raw:
            a, b = [], []
        spans = []
        for ids, known in ((a, first), (b, second)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(known[i]), i))
                at += len(known[i])
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if max(x[0], y[0]) < min(x[1], y[1])]
        shared = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, low = [], 0
        for high in shared:
            groups.append("|".join(",".join(str(x[2]) for x in own if low <= x[0] < high) for own in spans))
            low = high
        held.update(set(links))
        rows.append((key, len(a), len(b), groups, links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return [
        (key, n_a, n_b, groups, sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), links)
        for key, n_a, n_b, groups, links in rows
    ]


BENCHMARK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def benchmark_words(text):
    return BENCHMARK_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def benchmark_hits(docs, items, width):
    """``(id, words, hit positions, sorted items)`` per row."""
    windows = []
    for item, text in items:
        words = benchmark_words(text)
        size = min(width, len(words))
        windows += [(item, words[k : k + size]) for k in range(len(words) - size + 1) if size]
    out = []
    for key, text in docs:
        words, hit, found = benchmark_words(text), set(), set()
        for item, window in windows:
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(item)
        out.append((key, len(words), sorted(hit), sorted({str(i) for i in found if i is not None})))
    return out


def lloyd(vectors, k, rounds, scale, seed):
    """``(id, cluster, distance)`` per usable row and the centroids, with whole numbers alone."""
    kept = [
        (key, [math.floor(Fraction(x) * scale) for x in v]) for key, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), q) for key, q in kept if key is not None]
    centroids = [q for _, q in sorted(named)[:k]]

    def nearest(q):
        return min((sum((x - y) ** 2 for x, y in zip(q, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, q in kept:
            members.setdefault(nearest(q)[1], []).append(q)
        for i, own in members.items():
            centroids[i] = [sum(column) // len(own) for column in zip(*own)]
    return [(key, *nearest(q)[::-1]) for key, q in kept], centroids
