"""Phrase collocations against counting in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from yardline.llm import collocations as C


def brute(rows, words=5, at_least=100, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, words + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {g: n for g, n in counts.items() if n >= at_least}
    out = []
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        inside = (a <= n for (x, q), n in often.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
        if not any(inside):
            cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], totals[lang]))
    ranked, seen = [], Counter()
    for lang, s, a, p, left, right, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], p.decode(), -a, left, right, n, -s))
    return ranked


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["of", "the", "The", "a", "é", "new york", "x y z", "to be or not to be", "q\tr", "ü v"]) if rng.random() < 0.6 else f"w{int(rng.expovariate(0.05))}"
    rows = []
    for _ in range(n):
        text = "".join(word() + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " "]) for _ in range(rng.randrange(1, 120)))
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return [*rows, rows[0], rows[0], (None, "en"), ("", None), (" .,; ", "de"), ("one", "fr"), ("b " * 30_000, "hot"), ("same line of words here\n" * 500, "hot")]


@pytest.mark.parametrize(("size", "burst", "bits"), [(C.MOST, C.BURST, C.SCREEN_BITS), (50, 4, 12), (300, 20, 7)])
def test_collocations(spark, size, burst, bits):
    """Also with tries that burst and spill all the time, and screens that let nearly all through."""
    rows = corpus(1)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, phrase string, N int")
    for at_least in (100, 12):
        got = [tuple(r) for r in C.collocations(docs, at_least=at_least, size=size, burst=burst, bits=bits).collect()]
        assert sorted(got) == sorted(brute(rows, at_least=at_least)) and got
    if size == 50:
        got = [tuple(r) for r in C.collocations(docs, at_least=12, top=3, words=3).collect()]
        assert sorted(got) == sorted(brute(rows, 3, 12, 3))


def listed(task):
    return sorted((r["lang"], r["words"], p, n) for b in task.end() for r in b.to_pylist() for p, n in zip(r["phrases"].split("\n"), r["counts"], strict=True))


def test_texts_larger_than_a_part(spark, monkeypatch):
    rows = corpus(2, 40)
    whole = C.Counting(3, 5, None, C.MOST)
    import pyarrow as pa

    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] or "und" for r in rows])], names=["text", "lang"])
    whole.add(batch)
    want = listed(whole)
    for part in (1, 7, 64, 1000):
        monkeypatch.setattr(C, "PART", part)
        if part < 64 and any(len(r[0] or "") > 20_000 for r in rows):
            rows_small = [r for r in rows if len(r[0] or "") < 20_000]
            batch_small = pa.record_batch([pa.array([r[0] for r in rows_small]), pa.array([r[1] or "und" for r in rows_small])], names=["text", "lang"])
            cut = C.Counting(3, 5, None, C.MOST)
            cut.add(batch_small)
            monkeypatch.setattr(C, "PART", 4 << 20)
            one = C.Counting(3, 5, None, C.MOST)
            one.add(batch_small)
            assert listed(cut) == listed(one)
        else:
            cut = C.Counting(3, 5, None, C.MOST)
            cut.add(batch)
            assert listed(cut) == want


def test_trie_gives_back_what_went_in():
    rng = np.random.default_rng(3)
    trie, want = C.Trie(4, burst=5), Counter()
    for _ in range(30):
        rows = rng.integers(1, 4, (50, 4)).astype(">u4")
        rows[rng.random(50) < 0.3, 2:] = 0
        rows[:, 0] = rows[:, 0] * 4096 + 64 * rows[:, 1]  # ids that end in zero bytes and share bits
        trie.add("en", rows)
        want.update(map(tuple, rows.tolist()))
        assert trie.entries == sum(trie._size(x) for x in trie.langs.values())
    got = Counter()
    for keep in (20, 0):
        for _, rows, counts in trie.spill(keep):
            for k in (1, 2, 3, 4):  # beginnings lie together
                begins = [tuple(r[:k]) for r in rows.tolist()]
                assert len(set(begins)) == 1 + sum(x != y for x, y in zip(begins, begins[1:]))
            for r, n in zip(rows.tolist(), counts.tolist(), strict=True):
                got[tuple(r)] += n
        assert trie.entries <= keep
    assert got == want


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**15
    rows = [("en", "", 0, 7 * 10**15), ("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "a b", 2, big)]
    got = C.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, n long")).first()
    assert got.score == 1000 * big * 7 * 10**15 // ((big + 1) * (big + 2))


def test_no_rows(spark):
    assert C.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert C.collocations(spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")).collect() == []
