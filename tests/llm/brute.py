"""The operators once more, one row or pair after another, without Spark."""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(points, bits=2):
    """Smallest index reachable, for each point."""
    root = list(range(len(points)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= bits:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(points))]


def drop_lines(rows):
    """rows: (doc_id, text) -> (doc_id, n_lines, n_dropped, text)."""
    last = 2**63 - 1
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            doc_ = last if doc is None else doc
            first[key(line)] = min(first.get(key(line), doc_), doc_)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        doc_ = last if doc is None else doc
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == doc_]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def remove_repeats(rows, size=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = [False] * len(words)
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            repeated[i : i + 8] = [True] * 8
    lines = [x for x in text.split("\n") if WORD.search(x)]
    counts = (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        sum(repeated),
    )
    return (*counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0])


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    n, chars, symbols, _, repeats, _ = base_counts(text)
    upper = len(re.findall("[A-ZÀ-Þ]", text))
    upper += len(re.findall("×", text)) - len(re.findall("×", text))
    per = 100 / max(n, 1)
    return np.array(
        [
            math.log(max(chars, 1) / max(n, 1)),
            math.log1p(symbols * per),
            math.log1p(100 * upper / max(chars, 1)),
            math.log1p(len(re.findall(r"[.,;:!?]", text)) * per),
            math.log1p(repeats * per),
            math.asin(math.sqrt(sum(len(w) <= 3 for w in words) / max(n, 1))),
        ]
    )


def quality(rows, floors, share, steps, cutoff, smallest, half, chi):
    """rows: (doc_id, text, lang, source) -> (base_failed, kept, distance) of each."""
    base = [base_counts(r[1]) for r in rows]
    x = np.array([statistics(r[1]) for r in rows])
    good = [i for i, b in enumerate(base) if not b[5]]
    groups, pools, rest = defaultdict(list), defaultdict(list), []
    for i in good:
        groups[(0, rows[i][2], rows[i][3])].append(i)
    for name in [g for g, m in groups.items() if len(m) < smallest]:
        pools[(1, name[1])] += groups.pop(name)
    for name in [g for g, m in pools.items() if len(m) < smallest]:
        rest += pools.pop(name)
    sets = [(m, m) for m in (*groups.values(), *pools.values())]
    if len(rest) >= smallest:
        sets.append((rest, rest))
    elif len(good) >= smallest:
        # Too few: judged by all rows.
        sets.append((rest, good))
    floor = np.diag(np.array(floors) ** 2)
    distance = np.full(len(rows), np.nan)
    for members, of in sets:
        y = x[of]

        def square(mean, cov, y=y):
            d = y - mean
            return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov + floor), d).clip(0)

        def nearest(d2):
            bins = np.floor(np.log2(1 + d2) * 64)
            return np.sort(bins)[math.ceil(share * len(bins)) - 1], bins

        def quantile(column, q):
            return (np.sort(np.floor(column * 512))[math.ceil(q * len(column)) - 1] + 0.5) / 512

        def step(mean, cov):
            last, bins = nearest(square(mean, cov))
            near = y[bins <= last]
            return near.mean(axis=0), np.cov(near.T, bias=True)

        def log_det(estimate):
            return np.linalg.slogdet(estimate[1] + floor)[1]

        found = []
        for q in (0.5, 0.25, 0.75):
            estimate = (
                np.array([quantile(c, q) for c in y.T]),
                np.diag([((quantile(c, 0.75) - quantile(c, 0.25)) / 1.349) ** 2 for c in y.T]),
            )
            for _ in range(steps):
                estimate = step(*estimate)
            found.append(estimate)
        best = min(found, key=log_det)
        for _ in range(12):
            after = step(*best)
            if not log_det(after) < log_det(best) - 1e-9:
                break
            best = after
        last, _ = nearest(square(*best))
        scale = max(1.0, (2 ** ((last + 1) / 64) - 1) / chi)
        n = np.array([base[i][0] for i in members])
        distance[members] = square(*best, x[members]) / scale * n / (n + half)
    return [(b[5], not b[5] and not d > cutoff, d) for b, d in zip(base, distance)]


def _unit(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def copies(rows, seed, weights=None, epochs=1.0):
    """rows: (doc_id, text, source) -> Counter of (doc_id, text, copy)."""
    chars = Counter()
    for _, text, source in rows:
        chars[source] += max(1, len(text or ""))
    weights = weights if weights is not None else dict.fromkeys(chars, 1.0)
    every = sum(weights.get(s, 0.0) for s in chars)
    out = Counter()
    for doc, text, source in rows:
        name = f"text {hashlib.md5((text or '').encode()).hexdigest()}" if doc is None else doc
        rate = weights.get(source, 0) / every * sum(chars.values()) * epochs / chars[source]
        parts = max(1, math.ceil(rate / 16))
        n = 0
        for part in range(parts):
            u = _unit(f"{seed}:n:{part}:{name}") / 2**52
            total = term = math.exp(-rate / parts)
            j = 0
            while total <= u and j < 99:
                j += 1
                term *= rate / parts / j
                total += term
                n += 1
        for c in range(n):
            out[(doc, text, c)] += 1
    return out


def best_fit(lengths, window):
    """Rooms left, by trying every open sequence."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(window - length)
    return sorted(rooms)
