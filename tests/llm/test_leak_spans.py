"""Every place of a benchmark item in a document."""

import random

import pytest

from yardline.llm.decontaminate import find_leaks


@pytest.mark.parametrize("block_items", [20_000, 1])
def test_all_copies_of_an_item_show(spark, block_items):
    rng = random.Random(5)
    text = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(1000)) for _ in range(n)]
    one, two = text(30), text(20)
    changed = ["changed", *one[1:]]
    rows = [
        (0, [*text(7), *changed, *text(9), *one, *text(3), *one], [(1, 7), (1, 46), (1, 79)], [(1, 46)]),
        (1, [*two, *two, *one], [(1, 40), (2, 0), (2, 20)], [(1, 40), (2, 0)]),
        (2, one[:-1], [(1, 0)], [(1, 0)]),
        (3, text(50), [], []),
    ]
    docs = spark.createDataFrame([(i, " ".join(w), 1) for i, w, _, _ in rows], "doc_id long, text string, Leak_Spans int")
    bench = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(two))], "item_id long, text string")
    out = {r.doc_id: r for r in find_leaks(docs, bench, block_items=block_items).collect()}
    for i, _, spans, best in rows:
        assert sorted((x.item, x.start) for x in out[i].leak_spans) == spans
        assert sorted((x.item, x.start) for x in out[i].leaks) == best
        assert all(x in out[i].leak_spans for x in out[i].leaks)
    assert [x.similarity < 1 for x in sorted(out[0].leak_spans, key=lambda x: x.start)] == [True, False, False]
