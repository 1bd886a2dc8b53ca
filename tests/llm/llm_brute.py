"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def covered(n, window, hit):
    mark = [False] * n
    for i in range(n - window + 1):
        if hit(i):
            mark[i : i + window] = [True] * window
    return mark


def repeated_bytes(docs, window=200):
    """(id, n_bytes, n_removed, n_spans, kept) per row of (id, text)."""
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = collections.Counter(b[i : i + window] for _, b in texts for i in range(len(b) - window + 1))
    out = []
    for d, b in texts:
        mark = covered(len(b), window, lambda i, b=b: seen[b[i : i + window]] > 1)
        spans = sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark))
        out.append((d, len(b), sum(mark), spans, bytes(x for x, m in zip(b, mark, strict=True) if not m)))
    return out


def repeated_words(docs, window=50):
    """(id, n_words, n_removed, kept) per row of (id, text)."""
    texts = [(d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in texts:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in texts:
        mark = covered(len(w), window, lambda i, d=d, w=w: d is not None and first[tuple(w[i : i + window])] < d)
        out.append((d, len(w), sum(mark), " ".join(x for x, m in zip(w, mark, strict=True) if not m)))
    return out


def fingerprint(text, shingle=3):
    import xxhash

    words = WORD.findall(fold(text or ""))
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance=3):
    """For each fingerprint the set of places that links reach."""
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(p) for p in prints]


def near_duplicates(docs, shingle=3, distance=3):
    prints = [fingerprint(t, shingle) for _, t in docs]
    roots = groups(prints, distance)
    least = {}
    for (d, _), r in zip(docs, roots, strict=True):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(docs, prints, roots, strict=True)]


def plain_words(text):
    text = "".join(c for c in fold(text or "") if not c.isascii() or c.isalnum() or WORD.match(c) is None)
    return WORD.findall(text)


def leaks(docs, items, similarity=0.8):
    """(id, item, start, words, similarity) of the best window of each document and item."""
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    items = [(i, grams(plain_words(t))) for i, t in items]
    out = []
    for d, t in docs:
        own = grams(plain_words(t))
        for i, item in items:
            n, counts, best = len(item), collections.Counter(item), None
            if not n or not set(own) & set(item):
                continue
            for p in range(len(own) - n + 1):
                shared = sum((collections.Counter(own[p : p + n]) & counts).values())
                score = shared / (2 * n - shared)
                if score >= similarity - 1e-12 and (best is None or score > best[1]):
                    best = p, score
            if best:
                out.append((d, i, best[0], n + 4, round(best[1], 9)))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    mark = covered(len(words), 5, lambda i: seen[tuple(words[i : i + 5])] > 1)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), sum(mark)
