"""Repeated bytes and words against brute force."""

import random

import numpy as np
import pytest
from llm_brute import repeated_bytes, repeated_words

from yardline.llm import repeats
from yardline.llm.suffix_array import remove_repeated_bytes, suffix_array
from yardline.llm.suffix_trees import remove_repeated_words, smallest_ids
from yardline.llm.rolling import BYTE_VALUES

SCHEMA = "doc_id long, text string"


def corpus(seed, n=60, alphabet="ab cd", words=False):
    """Rows with shared passages, copies, runs of one letter, nulls, empty texts and tied ids."""
    rng = random.Random(seed)
    make = lambda k: (" ".join if words else "".join)(rng.choice(["a", "bé", "c", "dd"] if words else list(alphabet)) for _ in range(k))
    shared = [make(rng.randrange(10, 60)) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else make(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6))]
        out.append((i, (" " if words else "").join(parts)))
    out += [(n, "x" * 90 if not words else "x " * 90), (n + 1, None), (n + 2, ""), (n + 3, " \n\t ")]
    out += [out[0], out[3], (None, out[5][1]), (None, out[6][1]), (7, out[9][1]), (n + 4, out[2][1])]
    return out


def check_bytes(spark, rows, window=24, gram=8, **more):
    out = remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA), window=window, gram=gram, **more).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out]
    assert all(sum(x.hi - x.lo for x in r.removed) == r.n_removed and len(r.removed) == r.n_spans for r in out)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(repeated_bytes(rows, window), key=key)


def check_words(spark, rows, window=12, gram=4, **more):
    out = remove_repeated_words(spark.createDataFrame(rows, SCHEMA), window=window, gram=gram, **more).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in out]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(repeated_words(rows, window), key=key)


@pytest.mark.parametrize("tokens", [repeats.GROUP_TOKENS, 1])
def test_bytes(spark, tokens):
    check_bytes(spark, corpus(1), group_tokens=tokens)
    check_bytes(spark, corpus(2, alphabet="ab"), group_tokens=tokens)


@pytest.mark.parametrize("tokens", [repeats.GROUP_TOKENS, 1])
def test_words(spark, tokens):
    check_words(spark, corpus(3, words=True), group_tokens=tokens)
    check_words(spark, corpus(4, n=20, words=True), window=15, gram=15, group_tokens=tokens)


def test_long_texts_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(3_000_000))
    rows = [(1, long), (2, long[1_000_000:1_100_000]), (3, "zz" + long[-500:]), (4, "q" * 2_500_000)]
    out = {r.doc_id: r for r in remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[i].n_removed for i in (1, 2, 3, 4)] == [100_500, 100_000, 500, 2_500_000]
    assert bytes(out[3].kept) == b"zz"


def test_columns_with_clashing_names_and_empty_tables(spark):
    schema = "doc_id int, text string, r1 int, R2 string, ranges int, kept string, whole_text int, content long"
    rows = [(1, "ab" * 40, 5, "x", 6, "y", 7, 8), (2, "ab" * 40, 5, "x", 6, "y", 7, 8)]
    for remove, n in ((remove_repeated_bytes, [80, 80]), (remove_repeated_words, [0, 0])):
        out = remove(spark.createDataFrame(rows, schema), window=24, gram=8)
        got = sorted(out.collect(), key=lambda r: r.doc_id)
        assert [r.n_removed for r in got] == n
        assert [(r.r1, r.R2, r.ranges, r.whole_text, r.content) for r in got] == [(5, "x", 6, 7, 8)] * 2
        assert remove(spark.createDataFrame([], schema)).collect() == []


def test_suffix_array_order():
    rng = random.Random(6)
    for text in (b"a", b"aaaa", b"banana", b"\x00\x00\xff\x00", bytes(rng.choice(b"ab") for _ in range(300)), b"abc" * 50):
        got = suffix_array(np.frombuffer(text, np.uint8), 400).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def test_small_groups_of_suffixes_give_the_same():
    rng = random.Random(7)
    values = BYTE_VALUES[[rng.randrange(2) for _ in range(400)]]
    at, windows, first = np.array([0, 150, 400]), np.array([141, 241]), np.array([9, 4])
    want = smallest_ids(values, at, windows, first, window=10)
    for most in (1, 3, 50):
        assert smallest_ids(values, at, windows, first, window=10, most=most).tolist() == want.tolist()
    assert set(want.tolist()) == {4, 9}
