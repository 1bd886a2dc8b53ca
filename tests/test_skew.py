"""Operators on groups treated as too large for a task: same results as on the plain route."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from yardline.operators.aggregates import average_rank, overall_quantiles, quantiles
from yardline.operators.skew import group_sizes, with_position
from yardline.operators.sets import chrono_split, ordinal_codes, pair_rows, time_folds
from yardline.operators.columns import fill_median, fill_ramp
from yardline.operators.windows import Lag, add_features, cumulative_sum, expanding_mean
from yardline.plans.evaluate import calibration_curve, conformal_adjustment, quantile_bins, simulation_summary
from yardline.plans.models import ks_distance, robust_scale


@pytest.fixture(scope="module")
def frame(spark):
    """A third of the rows belong to one key; values repeat."""
    rng = np.random.default_rng(11)
    n = 1200
    pdf = pd.DataFrame({
        "id": np.arange(n),
        "k": np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n)),
        "t": rng.permutation(n),
        "x": rng.integers(0, 60, n).astype(float),
    })
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_sizes(frame):
    pdf, df = frame
    sizes = group_sizes(df, ["k"], 50)
    assert sizes.total == len(pdf)
    assert sizes.largest == pdf.groupby("k").size().max()
    assert not sizes.fits or sizes.largest <= sizes.limit


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_positions(frame, keys, descending):
    pdf, df = frame
    got = with_position(df, keys, ["t"], "p", descending=descending, floor=50).toPandas().set_index("id").sort_index()
    by = pdf.sort_values("t", ascending=not descending)
    want = (by.groupby(keys).cumcount() + 1 if keys else pd.Series(np.arange(1, len(by) + 1), by.index))
    assert (got["p"] == want.sort_index()).all()


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(200)], "k string, t int")
    got = with_position(df, ["k"], ["t"], "p", floor=10).toPandas()
    assert len(got) == 200
    assert sorted(got[got["k"].isna()]["p"]) == list(range(1, 101))


@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles(frame, keys):
    pdf, df = frame
    probs = {"a": 0.0, "b": 0.1, "m": 0.5, "c": 0.83, "z": 1.0}
    got = quantiles(df, keys, "x", probs, floor=50).toPandas()
    for name, p in probs.items():
        if keys:
            want = pdf.groupby("k")["x"].quantile(p)
            np.testing.assert_allclose(got.set_index("k")[name].sort_index(), want)
        else:
            assert got[name][0] == pytest.approx(pdf["x"].quantile(p))


def test_average_rank(frame):
    pdf, df = frame
    want = pdf.assign(r=pdf.groupby("k")["x"].rank(ascending=False)).set_index("id")["r"]
    for floor in (None, 50):
        got = average_rank(df, ["k"], "x", "r", floor=floor).toPandas().set_index("id")["r"].sort_index()
        np.testing.assert_allclose(got, want.sort_index())


def test_rank_of_ties_and_nulls(spark):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate([5.0, 7.0, 7.0, None, 1.0])], "k string, i int, x double")
    for floor in (None, 2):
        rows = average_rank(df, ["k"], "x", "r", floor=floor).orderBy("i").collect()
        assert [r.r for r in rows] == [3, 1.5, 1.5, None, 4]


@pytest.mark.parametrize("op", [
    lambda df, f: pair_rows(df, ["t"], floor=f),
    lambda df, f: chrono_split(df, ["t"], fraction=0.9, floor=f),
    lambda df, f: time_folds(df, ["t"], 15, floor=f),
    lambda df, f: ordinal_codes(df, "t", "code", floor=f),
    lambda df, f: quantile_bins(df, "x", 10, floor=f),
    lambda df, f: robust_scale(df, ["x"], floor=f),
    lambda df, f: fill_median(df.withColumn("x", F.when(F.col("x") > 10, F.col("x"))), ["x"], floor=f),
    lambda df, f: fill_ramp(df.withColumn("x", F.when(F.col("x") > 3, F.col("x"))), "x", ["t"], 250.0, 215.0, 80, floor=f),
    lambda df, f: conformal_adjustment(df.withColumns({"lo": F.lit(10.0), "hi": F.lit(40.0)}), "x", "lo", "hi", floor=f),
    lambda df, f: ks_distance(df.filter("x > 0"), "x", floor=f),
    lambda df, f: simulation_summary(df.select(F.col("k").alias("row_id"), F.col("x").alias("value")),
                                     df.groupBy(F.col("k").alias("row_id")).agg(F.max("x").alias("actual")), floor=f),
    lambda df, f: calibration_curve(df.select(F.col("k").alias("row_id"), F.col("x").alias("value")),
                                    df.groupBy(F.col("k").alias("row_id")).agg(F.avg("x").alias("actual")), 5, floor=f),
])
def test_same_result_on_both_routes(frame, op):
    _, df = frame
    plain, spread = op(df, None).toPandas(), op(df, 100).toPandas()
    order = sorted(plain.columns)
    plain, spread = (p[order].sort_values(order).reset_index(drop=True) for p in (plain, spread))
    pd.testing.assert_frame_equal(plain, spread, check_dtype=False, rtol=1e-9)


def test_overall_quantiles(frame):
    pdf, df = frame
    for floor in (None, 100):
        q = overall_quantiles(df, {"a": ("x", 0.5), "b": ("t", 0.25)}, floor=floor)
        row = df.limit(1).select(q["a"].alias("a"), q["b"].alias("b")).first()
        assert (row.a, row.b) == (pytest.approx(pdf["x"].median()), pytest.approx(pdf["t"].quantile(0.25)))


def test_sizes_measured_before_a_filter(spark):
    """The only large group is gone when the features are computed."""
    df = spark.createDataFrame([("hot" if i < 300 else f"k{i % 50}", i, float(i)) for i in range(500)], "k string, t int, x double")
    sizes = group_sizes(df, ["k"], 100)
    assert not sizes.fits
    cold = df.filter("k <> 'hot'")
    feats = {"prev": Lag("x"), "mean": expanding_mean("x")}
    got = add_features(cold, ["k"], ["t"], feats, sizes=sizes).toPandas().sort_values("t").reset_index(drop=True)
    want = add_features(cold, ["k"], ["t"], feats).toPandas().sort_values("t").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want)


@pytest.mark.parametrize("floor", [None, 50])
def test_a_feature_may_replace_a_column_that_others_read(frame, floor):
    pdf, df = frame
    feats = {"x": Lag("x"), "sum": cumulative_sum("x")}
    got = add_features(df, ["k"], ["t"], feats, floor=floor)
    assert got.columns == ["id", "k", "t", "x", "sum"]
    got = got.toPandas().set_index("id").sort_index()
    by = pdf.sort_values("t").groupby("k")["x"]
    pd.testing.assert_series_equal(got["x"], by.shift().sort_index(), check_names=False)
    pd.testing.assert_series_equal(got["sum"], by.cumsum().sort_index(), check_names=False)


def test_limit_does_not_grow(spark):
    assert group_sizes(spark.range(5000).selectExpr("id % 2 as k"), ["k"], 100).limit == 100


def test_ramp_leaves_later_nulls(spark):
    df = spark.createDataFrame([(i, None) for i in range(19)] + [(50, 1.0)], "t int, x double")
    for floor in (None, 5):
        got = [r.x for r in fill_ramp(df, "x", ["t"], 250.0, 215.0, 18, floor=floor).orderBy("t").collect()]
        assert got[0] == 250.0 and got[17] == pytest.approx(215.0) and got[18] is None and got[19] == 1.0
