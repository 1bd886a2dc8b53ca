"""URL filters, quality rules, decontamination."""

import random
import re

import pytest
from llm_brute import base_counts, leaks

from yardline.llm import url_filter
from yardline.llm.decontaminate import find_leaks
from yardline.llm.quality_rules import judge
from yardline.llm.url_filter import Rule, filter_urls, host_path

URLS = [
    None, "", "no scheme", "http://net", "http://net/", "https://A.NET/x?y=/en/", "http://a.example.net/en/1", "http://example.net/en",
    "http://xexample.net/en/", "ftp://example.com/de/#f", "http://www.example.com/DE/", "http://b.org/fr/x", "http://borg/fr/x",
    "http://org/fr/", "://net/", "a://b://net/", "http://example.com?/de/", "http://net/\nen/", "http://example.net/en/", "http://ÄB.net/ü",
]


def verdict(url, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    fits = []
    for rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    best = max(fits, key=len, default=None)
    return host, path, best, rules.get(best, default)


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[6]), (None, URLS[9])]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in rows], "page_id long, url string, Rule string, place int")
    got = filter_urls(pages).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    want = sorted([(i, *verdict(u)) for i, u in rows], key=key)
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got], key=key) == want
    assert {r.place for r in got} == {1}
    assert filter_urls(pages.limit(0)).collect() == []
    assert {(r.rule, r.verdict) for r in filter_urls(pages, rules=(), default="block").collect()} == {(None, "block")}


@pytest.mark.parametrize("small", [True, False])
def test_many_rules_and_rules_without_a_token(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr("yardline.llm.common.SMALL_ROWS", 1)
    rules = [host_path(f"h{i}.com/a{i % 3}/", "block") for i in range(60)] + [Rule("any digits in a path of x", "allow", r"^x/\d+$", ())]
    pages = spark.createDataFrame([(i, f"http://s.h{i % 80}.com/a{i % 3}/{i}") for i in range(300)] + [(999, "http://x/77")], "page_id long, url string")
    got = {r.page_id: r.rule for r in filter_urls(pages, rules=rules).collect()}
    for i in range(300):
        assert got[i] == (f"h{i % 80}.com/a{(i % 80) % 3}/" if i % 80 < 60 and i % 3 == (i % 80) % 3 else None)
    assert got[999] == "any digits in a path of x"


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(["a", "com"],), (["b", "com"],), (["a", "com"],)], "tokens array<string>")
    index = {r.rule: r.token for r in url_filter.rarest(urls, [host_path("a.com/", "block"), host_path("b.com/a/", "block")]).collect()}
    assert index == {"a.com/": "a", "b.com/a/": "b"}


def document(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(words))


def test_quality_rules(spark):
    rng = random.Random(1)
    texts = [document(rng, rng.randrange(5, 60)) for _ in range(150)]
    texts += [None, "", " \n\x0b", "a" * 100_000, "x y " * 3000, "\n".join([document(rng, 12)] * 8), "a b c d e\nf a b c d e\ta b c", "# $% & |<> " * 9]
    texts += [re.sub(" ", " ### ", document(rng, 40)) for _ in range(3)] + [" ".join(document(rng, 14).split() * 2)]
    rows = [(i, t, [None, "en", "de"][i % 3] if i % 9 else "en", "hot" if i % 2 else f"s{i}", 7, "c") for i, t in enumerate(texts)]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, N_WORDS int, symbol_share string")
    out = judge(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        want = base_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == want, r.text
        assert r.base_failed == (want[0] < 10 or 100 * want[5] > 20 * want[0])
        assert r.kept == (not r.base_failed and not r.failed_rules) and r.symbol_share == "c"
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] == (base_counts(texts[i])[0] >= 10) for i in range(150))
    assert not any(kept[i] for i in (150, 151, 152, 153, 154, 158, 159, 160))
    assert judge(docs.limit(0)).collect() == []


def test_fences_follow_their_group(spark):
    rng = random.Random(2)
    rows = [(i, re.sub(" ", " # ", document(rng, 30)) if i < 200 else document(rng, 30), "en", "code" if i < 200 else "prose") for i in range(400)]
    rows.append((400, re.sub(" ", " # ", document(rng, 30)), "en", "prose"))
    out = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert [r.doc_id for r in out if not r.kept] == [400]


@pytest.mark.parametrize("block_items", [20_000, 3])
def test_leaks(spark, block_items):
    rng = random.Random(3)
    items = [(i, document(rng, rng.choice([3, 5, 8, 25, 40]))) for i in range(12)] + [(20, None), (21, "")]
    items += [(22, items[4][1]), items[5], (23, "a a a a a a a b b"), (None, document(rng, 20))]
    rows = []
    for i in range(80):
        words = document(rng, rng.randrange(0, 80)).split()
        if i % 2:
            leak = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if leak:
                    leak[rng.randrange(len(leak))] = "changed"
            words[len(words) // 2 : len(words) // 2] = leak
        rows.append((i, " ".join(words).upper() if i % 5 == 0 else ", ".join(words), "x"))
    rows += [(100, None, "x"), (101, "", "x"), (102, "a " * 5000 + "b b", "x"), (103, "... !!! " * 20, "x"), rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Leaks string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = find_leaks(docs, bench, block_items=block_items)
    got = [(r.doc_id, x.item, x.start, x.words, round(x.similarity, 9)) for r in out.collect() for x in r.leaks]
    want = leaks([r[:2] for r in rows], sorted(set(items), key=str))
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=order) == sorted(want, key=order) and len(want) > 10
    assert all(r.leaks == [] for r in find_leaks(docs, bench.limit(0)).collect())
    assert find_leaks(docs.limit(0), bench).collect() == []
