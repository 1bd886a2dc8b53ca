"""One-hot columns of a key with many common categories."""

from yardline.plans import models as M


def test_every_common_category_has_a_column(spark):
    rows = [(f"p{i}",) for i in range(70) for _ in range(6)] + [("seldom",)] * 5 + [(None,)]
    out, names = M.one_hot(spark.createDataFrame(rows, "player string"), ["player"])
    assert sorted(names) == sorted([f"player_p{i}" for i in range(70)] + ["player_rare"])
    sums = out.groupBy().sum(*names).first().asDict()
    assert {n: sums[f"sum({n})"] for n in names} == {n: 6.0 for n in names}
