"""Decontamination of documents with fewer shingles than a benchmark item."""

import collections
import random

import pytest
from llm_brute import leaks, plain_words

from yardline.llm.decontaminate import find_leaks


def grams(text):
    words = plain_words(text)
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def whole_leaks(docs, items, similarity=0.8):
    """(id, item, start, words, similarity) of documents shorter than an item, as their own window."""
    out = []
    for d, t in docs:
        for i, item in items:
            a, b = collections.Counter(grams(t)), collections.Counter(grams(item))
            n, m, shared = a.total(), b.total(), (a & b).total()
            if 0 < n < m and shared / (n + m - shared) >= similarity - 1e-12:
                out.append((d, i, 0, n + 4, round(shared / (n + m - shared), 9)))
    return out


@pytest.mark.parametrize("block_items", [20_000, 3])
def test_truncated_items(spark, block_items):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 9, 14, 15, 25, 40, 40, 60])]
    items += [(20, items[6][1]), (21, "a b c d e " * 8), (22, None)]
    rows = [(0, None), (1, ""), (2, "a b c d"), (3, "a b c d e " * 7)]
    for _, t in items[:9]:
        words = t.split()
        for cut in range(0, min(len(words), 16)):
            rows += [(len(rows), " ".join(words[: len(words) - cut])), (len(rows) + 1, ", ".join(words[cut:]).upper())]
        rows.append((len(rows), " ".join([*words[:-3], word()])))
        rows.append((len(rows), " ".join([word(), *words[2:]])))
    known = [r for r in items if r[1]]
    short = whole_leaks(rows, known)
    assert (len(short) > 30) and {r[1] for r in short} >= {3, 5, 6, 8, 20, 21}
    out = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_items=block_items)
    got = [(r.doc_id, x.item, x.start, x.words, round(x.similarity, 9)) for r in out.collect() for x in r.leaks]
    assert sorted(got) == sorted(short + leaks(rows, known))
