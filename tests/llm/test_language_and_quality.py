"""SimHash, language identification, quality classifier."""

import random

import numpy as np
from llm_brute import near_duplicates as brute

from yardline.llm import quality_classifier
from yardline.llm.components import components
from yardline.llm.language import UNKNOWN, fit, identify
from yardline.llm.simhash import drop_near_duplicates, links, near_duplicates

KEY = lambda r: tuple("" if x is None else str(x).zfill(20) for x in r)


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for _ in range(12):
        words = [word() for _ in range(300)]
        for _ in range(5):
            words[rng.randrange(300)] = word()
            rows.append((n, " ".join(words)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "\n\t"), (n + 3, "One"), (n + 4, "one"), (n + 5, "x y"), (n + 6, "Ä b c"), (n + 7, "ä b c")]
    return [*rows, rows[0], (None, rows[1][1]), (None, None), (3, rows[9][1]), (n + 8, "word " * 50_000)]


def test_near_duplicates(spark):
    rows = near_copies(1)
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, fp int, Component_Id string")
    got = [tuple(r) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=KEY) == sorted(brute(rows), key=KEY)
    stay = [(r.doc_id, r.fp, r.Component_Id) for r in drop_near_duplicates(docs).collect()]
    want = {c for _, _, c in brute(rows)}
    assert sorted(stay) == sorted((c, 1, "y") for c in want)
    assert near_duplicates(docs.limit(0)).collect() == [] == drop_near_duplicates(docs.limit(0)).collect()
    lone = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [tuple(r) for r in near_duplicates(lone).select("doc_id", "component_id").collect()] == [(None, None)] * 2
    assert drop_near_duplicates(lone).count() == 1


def test_links_lose_none(spark):
    rng = random.Random(2)
    prints = set()
    while len(prints) < 60:
        p = rng.getrandbits(64)
        prints |= {p, p ^ 1 << rng.randrange(64), p ^ 1 << 63 ^ 1 << rng.randrange(63), p ^ 7 << rng.randrange(61), p ^ 31 << rng.randrange(59)}
    prints |= {0, 2**64 - 1, 1, 2**63, 3, 7, 15}
    signed = lambda p: p - 2**64 if p >> 63 else p
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for distance in (0, 1, 2, 3, 5):
        want = {(signed(a), signed(b)) for a in prints for b in prints if (a ^ b).bit_count() <= distance and signed(a) < signed(b)}
        assert {tuple(r) for r in links(nodes, distance).collect()} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(-5, 1049), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, **{1000 + i: -5 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def texts(lang, n, seed):
    rng = random.Random(seed)
    parts = {"en": ["the", "ing", "tion", "and", "wh"], "de": ["sch", "ung", "ein", "ß", "keit"], "fr": ["eau", "é", "que", "ou", "ç"]}[lang]
    return [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))) for _ in range(n)]


def test_language(spark):
    rows = [(i, t, lang) for lang in ("en", "de", "fr") for i, t in enumerate(texts(lang, 40, lang))]
    rows += [(900, None, "en"), (901, "12 34", "de"), (902, "text", None), (903, "", "fr")]
    model = fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert set(model.languages) == {"en", "de", "fr"}
    fresh = [(i, t, lang, 0) for lang in ("en", "de", "fr") for i, t in enumerate(texts(lang, 30, lang + "x"))]
    odd = [(None, None, "?", 0), (1, "", "?", 0), (2, "123 ...", "?", 0), (3, "語" * 40, "?", 0), (4, "the ing " * 400_000, "?", 0)]
    docs = spark.createDataFrame(fresh + odd, "doc_id long, text string, truth string, Score int")
    out = identify(docs, model).collect()
    known = [r for r in out if r.truth != "?"]
    assert sum(r.lang_pred == r.truth for r in known) >= 0.95 * len(known)
    assert all(0 <= r.score <= 1 for r in out)
    rest = {r.doc_id: r for r in out if r.truth == "?"}
    assert [rest[i].lang_pred for i in (None, 1, 2)] == [UNKNOWN] * 3 and [rest[i].score for i in (None, 1, 2)] == [0.0] * 3
    assert rest[3].rejected and rest[3].lang_pred in model.languages and rest[4].lang_pred == "en"
    assert identify(docs.limit(0), model).collect() == []
    empty = fit(spark.createDataFrame([], "id long, text string, lang string"))
    assert {r.lang_pred for r in identify(docs, empty).collect()} == {UNKNOWN}


def test_language_fit_is_the_same_every_time(spark):
    rows = spark.createDataFrame([(i, t, lang) for lang in ("en", "de") for i, t in enumerate(texts(lang, 30, lang))], "id long, text string, lang string")
    a, b = fit(rows, sample=15), fit(rows.repartition(5), sample=15)
    assert np.allclose(a.centroids, b.centroids) and a.languages == b.languages


def test_quality(spark):
    rng = random.Random(4)
    good = lambda: ". ".join(" ".join("".join(rng.choices(["th", "en", "ou", "er"], k=2)) for _ in range(9)) for _ in range(6))
    bad = lambda: " | ".join("".join(rng.choices(["zz", "qx", "#"], k=3)) for _ in range(60))
    rows = [(i, good() if i % 3 else bad(), f"s{i % 4}", "en", 100) for i in range(400)]
    odd = [(500, None, None, None, None), (501, "", "s", "en", 0), (502, "x" * 200_000, "s", "en", -3), rows[5], (None, rows[6][1], "s", "en", 3)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, source string, lang string, n_chars long").withColumn("Quality", docs_extra())
    pages = docs.selectExpr("doc_id as id", "text", "source", "lang", "n_chars as size")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 400, 4)] + [(0, 0), (None, 1), (777, 1), (8, None)], "id long, label int")
    model = quality_classifier.fit(pages, labels)
    assert model.labels == 100 and min(model.pseudo) > 0
    out = quality_classifier.score(docs, model).collect()
    assert len(out) == len(rows) + len(odd) and "Quality" not in out[0].asDict()
    right = [r.good == bool(r.doc_id % 3) for r in out if r.doc_id is not None and r.doc_id < 400]
    assert sum(right) > 0.97 * len(right)
    assert all(0 <= p <= 1 for r in out for p in (r.quality, r.text_quality, r.metadata_quality))
    assert quality_classifier.score(docs.limit(0), model).collect() == []
    none = quality_classifier.fit(pages, labels.limit(0))
    assert {r.quality for r in quality_classifier.score(docs, none).collect()} == {0.5}


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit("clash")
