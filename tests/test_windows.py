"""Window features against pandas, on plain windows and on the route for groups larger than a task."""

import numpy as np
import pandas as pd
import pytest

from yardline.operators.windows import (
    Ewm,
    Lag,
    Lead,
    RollingMean,
    RollingSlope,
    add_features,
    cumulative_sum,
    expanding_fraction,
    expanding_max,
    expanding_mean,
    fill_forward,
    running_count,
)

MICRO = [10.0, 20.0, None, 40.0, 30.0]


def _micro(spark):
    return spark.createDataFrame([("p", i, v) for i, v in enumerate(MICRO)], "k string, t int, x double")


@pytest.mark.parametrize("floor", [None, 2])
@pytest.mark.parametrize(
    "feature, expected",
    [
        (Ewm("x", span=4), [None, 10, 16.25, 16.25, 31.319796954314718]),
        (RollingMean("x", 2), [None, None, 15, None, None]),
        (RollingMean("x", 2, partial=True), [None, 10, 15, 20, 40]),
        (expanding_mean("x"), [None, 10, 15, 15, 23.333333333333332]),
        (Lag("x"), [None, 10, 20, None, 40]),
        (expanding_max("x"), [None, 10, 20, 20, 40]),
        (cumulative_sum("x"), [10, 30, 30, 70, 100]),
        (running_count(), [0, 1, 2, 3, 4]),
        (fill_forward("x"), [10, 20, 20, 40, 30]),
    ],
)
def test_micro(spark, feature, expected, floor):
    rows = add_features(_micro(spark), ["k"], ["t"], {"f": feature}, floor=floor).orderBy("t").collect()
    assert [r.f for r in rows] == pytest.approx(expected, nan_ok=True)


def test_fraction_and_single_point_slope(spark):
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate([0.99, 0.5, 1.0, 0.96])], "k string, t int, x double")
    out = add_features(
        df, ["k"], ["t"], {"f": expanding_fraction("x", 0.95), "s": RollingSlope("x", 25)}
    ).orderBy("t").collect()
    assert [r.f for r in out] == pytest.approx([1.0, 0.5, 1 / 3, 0.5])
    assert out[0].s == 0


def _frame(n, hot_share, nulls, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < hot_share, 0, rng.integers(1, 30, n))
    x = rng.normal(100, 20, n)
    x[rng.random(n) < nulls] = np.nan
    return pd.DataFrame({"k": key, "t": rng.permutation(n), "x": x})


def _slope(v):
    return np.polyfit(np.arange(len(v)), v, 1)[0] if len(v) > 1 else 0.0


def _expected(pdf, keys):
    pdf = pdf.sort_values([*keys, "t"]).reset_index(drop=True)
    g = pdf.groupby(keys)["x"] if keys else None

    def tr(f):
        return g.transform(f) if keys else f(pdf["x"])

    pdf["lag"] = tr(lambda s: s.shift())
    pdf["lead"] = tr(lambda s: s.shift(-1))
    pdf["full"] = tr(lambda s: s.shift().rolling(6).mean())
    pdf["part"] = tr(lambda s: s.shift().rolling(12, min_periods=1).mean())
    pdf["ewm"] = tr(lambda s: s.shift().ewm(alpha=0.08).mean())
    pdf["ewm_now"] = tr(lambda s: s.ewm(span=4).mean())
    pdf["com"] = tr(lambda s: s.shift().ewm(com=0.08).mean())
    pdf["mean"] = tr(lambda s: s.shift().expanding().mean())
    pdf["top"] = tr(lambda s: s.shift().expanding().max())
    pdf["fill"] = tr(lambda s: s.ffill())
    pdf["n"] = pdf.groupby(keys).cumcount() if keys else np.arange(len(pdf))
    return pdf


FEATURES = {
    "lag": Lag("x"),
    "lead": Lead("x"),
    "full": RollingMean("x", 6),
    "part": RollingMean("x", 12, partial=True),
    "ewm": Ewm("x", alpha=0.08),
    "ewm_now": Ewm("x", span=4, shift=False),
    "com": Ewm("x", com=0.08),
    "mean": expanding_mean("x"),
    "top": expanding_max("x"),
    "fill": fill_forward("x"),
    "n": running_count(),
}


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("floor, hot, nulls", [(None, 0.0, 0.1), (50, 0.4, 0.0), (50, 0.4, 0.3)])
def test_against_pandas(spark, keys, floor, hot, nulls):
    pdf = _frame(3000, hot, nulls)
    df = spark.createDataFrame([(int(a), int(b), None if np.isnan(c) else float(c)) for a, b, c in pdf.values], "k long, t long, x double")
    want = _expected(pdf, keys).sort_values("t").reset_index(drop=True)
    got = add_features(df, keys, ["t"], FEATURES, floor=floor).toPandas().sort_values("t").reset_index(drop=True)
    assert len(got) == len(want)
    for name in FEATURES:
        np.testing.assert_allclose(got[name].astype(float), want[name].astype(float), rtol=1e-9, err_msg=name)


def test_ewm_long_null_run(spark):
    """A null run much longer than the memory of the average, in a group longer than the plain form allows."""
    rng = np.random.default_rng(3)
    x = rng.normal(10, 3, 3000)
    x[700:1500] = np.nan
    x[1502:2200] = np.nan
    df = spark.createDataFrame([(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)], "t long, x double")
    got = add_features(df, [], ["t"], {"e": Ewm("x", com=0.08), "a": Ewm("x", span=4)}, floor=200).toPandas().sort_values("t")
    s = pd.Series(x)
    np.testing.assert_allclose(got["e"].astype(float), s.shift().ewm(com=0.08).mean(), rtol=1e-9)
    np.testing.assert_allclose(got["a"].astype(float), s.shift().ewm(span=4).mean(), rtol=1e-9)


@pytest.mark.parametrize("floor", [None, 40])
def test_slope(spark, floor):
    pdf = _frame(400, 0.4, 0.0)
    df = spark.createDataFrame([(int(a), int(b), float(c)) for a, b, c in pdf.values], "k long, t long, x double")
    pdf = pdf.sort_values("t")
    pdf["s"] = pdf.groupby("k")["x"].transform(lambda s: s.rolling(25, min_periods=1).apply(_slope, raw=True))
    got = add_features(df, ["k"], ["t"], {"s": RollingSlope("x", 25)}, floor=floor).toPandas().sort_values("t")
    np.testing.assert_allclose(got["s"], pdf["s"], atol=1e-9)


def test_no_leakage(spark):
    """Changing row t leaves every shifted feature at rows up to t unchanged."""
    base = _frame(200, 0.0, 0.0)
    changed = base.copy()
    changed.loc[changed["t"] == 150, "x"] = 1e6
    shifted = {n: f for n, f in FEATURES.items() if n in ("lag", "full", "part", "ewm", "com", "mean", "top")}
    frames = []
    for pdf in (base, changed):
        df = spark.createDataFrame(pdf)
        frames.append(add_features(df, ["k"], ["t"], shifted).filter("t <= 150").toPandas().sort_values("t"))
    for n in shifted:
        np.testing.assert_allclose(frames[0][n], frames[1][n])
