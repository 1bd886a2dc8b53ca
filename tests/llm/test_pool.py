"""Co-training over all unlabelled pages."""

import random

import numpy as np
import pyarrow as pa

from yardline.llm import quality_classifier as Q


def pages(n, seed=6):
    rng = random.Random(seed)
    word = lambda parts: "".join(rng.choices(parts, k=2))
    rows = []
    for i in range(n):
        parts = ["th", "en", "ou", "er"] if i % 3 else ["zz", "qx", "#"]
        rows.append((i, " ".join(word(parts) for _ in range(30)), f"s{i % 4}", "en", 100))
    return rows


SCHEMA = "id long, text string, source string, lang string, size long"


def test_every_unlabelled_page_may_be_labelled(spark):
    n = 10_000
    rows = pages(n)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, n, 25)], "id long, label int")
    table = spark.createDataFrame([*rows, *rows[:50]], SCHEMA)
    model = Q.fit(table, labels)
    assert model.labels == 400
    # five rounds of a tenth of the unlabelled pages; a pool of some 4 000 gives 2 000
    assert 0.45 * (n - 400) < min(model.pseudo) and max(model.pseudo) <= n - 400
    again = Q.fit(table.repartition(7), labels)
    assert all(np.allclose(a.weight, b.weight, atol=1e-3) for a, b in zip(model.views, again.views, strict=True))
    sampled = Q.fit(table, labels, labelled=200)
    assert 120 < sampled.labels < 280 and min(sampled.pseudo) > 0.45 * (n - 400)


def test_sums_in_tasks_are_those_of_all_rows(spark):
    rows = [*pages(300), (300, "x " * 70_000, None, None, None), (301, None, "s", "en", -3), (302, "a a b", "s", "de", 5)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("id", "text", "source", "lang", "size"), r, strict=True)) for r in rows])
    whole = Q.views_of(batch)
    small = Q.packed(batch)
    for a, b in zip(whole, Q.unpacked(small), strict=True):
        assert np.allclose(a, b, atol=1e-5)
    sums = Q.moments(whole)
    edges = np.cumsum([1, *[x.shape[1] for x in whole for _ in (0, 1)]])
    cuts = [sums[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    state = Q.Rounds([Q.scales(sums[0], cuts[0], cuts[1]), Q.scales(sums[0], cuts[2], cuts[3])])
    rng = np.random.default_rng(1)
    betas = [rng.normal(size=x.shape[1] + 1) / 10 for x in whole]
    for view in (0, 1):
        state.betas[view].append(betas[view])
        state.cuts[view].append((-50, 50))
    frame = spark.createDataFrame([(r["bag"], r["rest"]) for r in small.to_pylist()], "bag binary, rest binary").repartition(5)
    assert np.allclose(Q.summed(frame, Q.moments), sums, rtol=1e-4)
    got, want = Q.summed(frame, lambda v: state.sums(v, dict(enumerate(betas)))), state.sums(whole, dict(enumerate(betas)))
    assert want[0] > 0 and np.allclose(got, want, rtol=1e-2, atol=1e-2 * np.abs(want).max())
    assert Q.summed(frame, state.counts).sum() == state.counts(whole).sum() < 2 * len(rows)
    assert Q.summed(frame.limit(0), Q.moments) is None


def test_cut():
    counts = np.zeros(2 * Q.TOP + 1)
    counts[Q.TOP + 3000], counts[Q.TOP + 2000], counts[Q.TOP + Q.EDGE], counts[Q.TOP + Q.EDGE - 1] = 5, 7, 9, 100
    counts[Q.TOP - 4000], counts[Q.TOP - Q.EDGE], counts[Q.TOP - Q.EDGE + 1] = 2, 4, 100
    assert Q.cut(counts, [1, 5]) == (-4000, 3000, 7)
    assert Q.cut(counts, [3, 6]) == (-Q.EDGE, 2000, 6 + 12)
    assert Q.cut(counts, [1e9, 1e9]) == (-Q.EDGE, Q.EDGE, 6 + 21)
