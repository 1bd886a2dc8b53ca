"""Regression jobs against closed forms in NumPy."""

import math

import numpy as np
import pandas as pd
import pytest

from yardline.functions.scalars import normal_cdf
from yardline.operators.sets import time_folds
from yardline.plans import models as M
from yardline.plans import ratings as R


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(3, 2, n), "g": rng.integers(0, 30, n)})
    pdf["season"], pdf["week"] = 2016 + pdf["id"] // 180, 1 + pdf["id"] % 180 // 10
    effect = rng.normal(0, 2, 30)
    pdf["y"] = 5 + 2 * pdf["a"] - pdf["b"] + effect[pdf["g"]] + rng.normal(size=n)
    pdf["fold"] = pdf["id"] % 8
    return pdf, spark.createDataFrame(pdf)


def _ols(pdf, alpha=0.0, scale=False):
    x, y = pdf[["a", "b"]].to_numpy(), pdf["y"].to_numpy()
    mean, sd = x.mean(axis=0), x.std(axis=0) if scale else np.ones(2)
    z = (x - mean) / sd
    w = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean())) / sd
    return y.mean() - w @ mean, w


def test_out_of_fold(data):
    pdf, df = data
    got = M.out_of_fold(df, ["a", "b"], "y", "fold").toPandas().set_index("id")["oof"].sort_index()
    want = pd.Series(0.0, pdf["id"])
    for k in range(8):
        b0, w = _ols(pdf[pdf["fold"] != k])
        sel = pdf["fold"] == k
        want[sel] = b0 + pdf.loc[sel, ["a", "b"]].to_numpy() @ w
    np.testing.assert_allclose(got, want, rtol=1e-8)


def test_walk_forward(data):
    pdf, df = data
    got = M.walk_forward(df, ["a", "b"], "y", alphas=[10.0], first_week=20).toPandas().set_index("id")["preds"]
    weeks = sorted(set(zip(pdf["season"], pdf["week"])))
    for i in (20, 33, len(weeks) - 2):
        s, w = weeks[i]
        past = pdf[(pdf["season"] < s) | ((pdf["season"] == s) & (pdf["week"] <= w))]
        b0, coef = _ols(past, 10.0, scale=True)
        nxt = pdf[(pdf["season"] == weeks[i + 1][0]) & (pdf["week"] == weeks[i + 1][1])]
        np.testing.assert_allclose(got[nxt["id"]], b0 + nxt[["a", "b"]].to_numpy() @ coef, rtol=1e-8)


def test_time_series_scores(data):
    pdf, df = data
    rows = time_folds(df.drop("fold"), ["id"], 5)
    got = M.time_series_scores(rows, ["a", "b"], "y", "fold", [1.0]).toPandas().set_index("fold")["mae"]
    size, first = 100, 100
    for k in (1, 5):
        cut = first + (k - 1) * size
        b0, w = _ols(pdf[:cut], 1.0, scale=True)
        test = pdf[cut:cut + size]
        want = np.abs(test["y"] - b0 - test[["a", "b"]].to_numpy() @ w).mean()
        assert got[k] == pytest.approx(want)


def test_quantile_regression(data):
    pdf, df = data
    coefs = M.quantile_regression(df, ["a", "b"], "y", (0.05, 0.5, 0.95))
    for p, c in coefs.items():
        pred = c[0] + pdf[["a", "b"]].to_numpy() @ np.array(c[1:])
        assert np.mean(pdf["y"] <= pred) == pytest.approx(p, abs=0.02)


def test_random_intercept(data):
    pdf, df = data
    fixed, effects = R.random_intercept(df, "g", "y", ["a", "b"])
    assert fixed["a"] == pytest.approx(2, abs=0.15) and fixed["b"] == pytest.approx(-1, abs=0.1)
    assert fixed["sigma_sq"] == pytest.approx(1, abs=0.2) and 1.5 < fixed["tau_sq"] < 8
    # the intercepts solve the mixed-model equations of the fitted variances
    x = np.column_stack([np.ones(len(pdf)), pdf[["a", "b"]]])
    z = np.eye(30)[pdf["g"]]
    v = fixed["sigma_sq"] * np.eye(len(pdf)) + fixed["tau_sq"] * z @ z.T
    beta = np.linalg.solve(x.T @ np.linalg.solve(v, x), x.T @ np.linalg.solve(v, pdf["y"]))
    u = fixed["tau_sq"] * z.T @ np.linalg.solve(v, pdf["y"] - x @ beta)
    np.testing.assert_allclose([fixed["intercept"], fixed["a"], fixed["b"]], beta, rtol=1e-6)
    got = effects.toPandas().set_index("g")["intercept"].sort_index()
    np.testing.assert_allclose(got, u, atol=1e-5)
    # no other ratio of variances is more likely
    def loss(ratio):
        h = np.eye(len(pdf)) + ratio * z @ z.T
        b = np.linalg.solve(x.T @ np.linalg.solve(h, x), x.T @ np.linalg.solve(h, pdf["y"]))
        r = pdf["y"] - x @ b
        return len(pdf) * np.log(r @ np.linalg.solve(h, r)) + np.linalg.slogdet(h)[1]

    best = fixed["tau_sq"] / fixed["sigma_sq"]
    assert loss(best) <= min(loss(best * 1.01), loss(best / 1.01))


def test_partial_pool_moves_toward_the_grand_mean(data):
    pdf, df = data
    rows = R.partial_pool(df, "g", "y").toPandas()
    grand = rows["mean"].mean()
    assert ((rows["pooled_mean"] - grand).abs() <= (rows["mean"] - grand).abs() + 1e-12).all()


def test_distribution_functions(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 1.0, 2.5, 10.0)], "x double")
    got = df.select("x", M.gamma_cdf(1.0, df["x"]).alias("one"), M.gamma_cdf(6.0, df["x"]).alias("six"),
                    normal_cdf(df["x"]).alias("up"), normal_cdf(-df["x"]).alias("down")).toPandas()
    x = got["x"].to_numpy()
    np.testing.assert_allclose(got["one"], 1 - np.exp(-x), atol=1e-12)
    tail = np.exp(-x) * sum(x**k / math.factorial(k) for k in range(6))
    np.testing.assert_allclose(got["six"], 1 - tail, atol=1e-12)
    up = [0.5 * math.erfc(-v / math.sqrt(2)) for v in x]
    np.testing.assert_allclose(got["up"], up, atol=2e-7)
    np.testing.assert_allclose(got["down"], 1 - np.array(up), atol=2e-7)


def test_target_encode_test_rows(spark):
    rows = [(i, "a", float(i), i < 3) for i in range(4)] + [(9, "b", 5.0, False)]
    df = spark.createDataFrame(rows, "t int, k string, y double, train boolean")
    got = {r.t: r.k_encoded for r in M.target_encode(df, "k", "y", ["t"], df["train"]).collect()}
    mean = 1.0
    assert got == {0: mean, 1: (0 + mean) / 2, 2: (1 + mean) / 3, 3: (3 + mean) / 4, 9: mean}


@pytest.mark.parametrize("floor", [None, 40])
def test_local_smooth(spark, floor):
    line = spark.createDataFrame([("a", i, 3.0 + 2 * i) for i in range(30)], "k string, t int, y double")
    got = M.local_smooth(line, ["k"], ["t"], "y", floor=floor).toPandas()
    np.testing.assert_allclose(got["smooth"], got["y"], atol=1e-9)
    rng = np.random.default_rng(2)
    noisy = [("a", i, float(np.sin(i / 15) + rng.normal(0, 0.2))) for i in range(120)] + [("b", 0, 5.0)]
    got = M.local_smooth(spark.createDataFrame(noisy, "k string, t int, y double"), ["k"], ["t"], "y", floor=floor).toPandas()
    a = got[got["k"] == "a"].sort_values("t")["smooth"]
    assert np.abs(a - np.sin(np.arange(120) / 15)).max() < 0.35
    assert got[got["k"] == "b"]["smooth"].tolist() == [5.0]


def test_legacy_cutoff(data):
    pdf, df = data
    got = M.walk_forward(df, ["a", "b"], "y", alphas=[10.0], first_week=20, legacy_cutoff=True).toPandas().set_index("id")["preds"]
    weeks = sorted(set(zip(pdf["season"], pdf["week"])))
    for i in (20, 33, len(weeks) - 2):
        s, w = weeks[i]
        past = pdf[(pdf["season"] <= s) & (pdf["week"] <= w)]
        b0, coef = _ols(past, 10.0, scale=True)
        nxt = pdf[(pdf["season"] == weeks[i + 1][0]) & (pdf["week"] == weeks[i + 1][1])]
        np.testing.assert_allclose(got[nxt["id"]], b0 + nxt[["a", "b"]].to_numpy() @ coef, rtol=1e-8)


def test_walk_forward_models(data):
    pdf, df = data
    got = M.walk_forward_models(df, ["a", "b"], "y", alphas=[10.0], net=(0.3, 0.5), first_week=30).toPandas().set_index("id")
    ridge = M.walk_forward(df, ["a", "b"], "y", alphas=[10.0], first_week=30).toPandas().set_index("id")["preds"]
    np.testing.assert_allclose(got["ridge_preds"].sort_index(), ridge.sort_index())
    np.testing.assert_allclose(got["ensemble"], got[["ridge_preds", "en_preds", "huber_preds"]].mean(axis=1))
    last = got[(got["season"] == pdf["season"].max())]
    last = last[last["week"] == last["week"].max()]
    past = pdf[pdf["season"] * 100 + pdf["week"] < int((last["season"] * 100 + last["week"]).iloc[0])]
    x, y = past[["a", "b"]].to_numpy(), past["y"].to_numpy()
    mean, sd = x.mean(axis=0), x.std(axis=0)
    z = (x - mean) / sd
    rows = np.column_stack([np.ones(len(last)), (last[["a", "b"]].to_numpy() - mean) / sd])

    def net_loss(b):
        return ((y - b[0] - z @ b[1:]) ** 2).mean() / 2 + 0.3 * (0.5 * np.abs(b[1:]).sum() + 0.25 * (b[1:] ** 2).sum())

    def huber_loss(b):
        r = np.abs(y - b[0] - z @ b[1:3])
        s = np.exp(b[3])
        h = np.where(r < 1.15 * s, (r / s) ** 2, 2 * 1.15 * r / s - 1.15**2)
        return (s + s * h).sum() + 5.0 * (b[1:3] ** 2).sum()

    for name, loss in (("en_preds", net_loss), ("huber_preds", huber_loss)):
        b = np.linalg.lstsq(rows, last[name].to_numpy(), rcond=None)[0]
        np.testing.assert_allclose(rows @ b, last[name], atol=1e-8)
        if name == "huber_preds":
            grid = np.linspace(-3, 3, 4001)
            b = np.append(b, grid[np.argmin([huber_loss(np.append(b, g)) for g in grid])])
        for i in range(len(b)):
            for step in (-1e-2, 1e-2):
                moved = b.copy()
                moved[i] += step
                assert loss(b) <= loss(moved) + 1e-9


def test_no_intercept(data):
    pdf, df = data
    g = M.read_gram(M.gram_table(df, ["a", "b"], "y").first(), 4)
    b0, w, _ = g.ridge(intercept=False)
    x = pdf[["a", "b"]].to_numpy()
    np.testing.assert_allclose(w, np.linalg.lstsq(x, pdf["y"], rcond=None)[0], rtol=1e-8)
    assert b0 == 0


def test_fold_quantiles(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"x": rng.normal(size=90), "fold": rng.integers(0, 3, 90)})
    pdf["y"] = 3 + 2 * pdf["x"] + rng.gumbel(size=90) * (1 + pdf["x"].abs())
    probs = (0.1, 0.5, 0.9)
    got = {r["fold"]: np.array(r["_coefs"]).reshape(3, 2) for r in M.fold_quantiles(spark.createDataFrame(pdf), ["x"], "y", "fold", probs).collect()}
    for k in range(3):
        own = pdf[pdf["fold"] != k]
        x, y = own["x"].to_numpy(), own["y"].to_numpy()
        i, j = np.triu_indices(len(own), 1)  # a best line passes through two points
        slope = (y[j] - y[i]) / (x[j] - x[i])
        lines = np.column_stack((y[i] - slope * x[i], slope))
        for b, p in zip(got[k], probs, strict=True):
            loss = lambda c: np.where((e := y - c[..., :1] - c[..., 1:] * x) >= 0, p * e, (p - 1) * e).sum(axis=-1)  # noqa: B023, E731
            assert loss(b[None])[0] <= loss(lines).min() * 1.001


def test_stack(data):
    pdf, df = data
    rows = df.withColumn("more", df["a"] * df["b"])
    got = M.stack(rows, ["a", "b", "more"], "y", "fold").toPandas().set_index("id").sort_index()
    want = M.out_of_fold(rows, ["a", "b", "more"], "y", "fold").toPandas().set_index("id")["oof"].sort_index()
    np.testing.assert_allclose(got["oof"], want)
    y = got["y"].to_numpy()
    for name, p in (("oof_5", 0.05), ("oof_50", 0.5), ("oof_95", 0.95)):
        assert np.mean(y <= got[name]) == pytest.approx(p, abs=0.04)
    assert M.fold_quantiles(rows.limit(0), ["a"], "y", "fold").collect() == []


def plain_lowess(y, share, robust):
    n = len(y)
    near = min(n, max(2, int(share * n + 1e-10)))
    weight, x = np.ones(n), np.arange(n)
    for i in range(robust + 1):
        fit = np.empty(n)
        for at in range(n):
            left = min(max(0, math.ceil(at - near / 2)), n - near)
            own = slice(left, left + near)
            reach = max(at - left, left + near - 1 - at)
            v = (1 - (np.abs(x[own] - at) / reach) ** 3) ** 3 * weight[own]
            d = x[own] - at
            s0, s1, s2 = v.sum(), (v * d).sum(), (v * d * d).sum()
            t0, t1 = (v * y[own]).sum(), (v * d * y[own]).sum()
            fit[at] = (t0 * s2 - s1 * t1) / (s0 * s2 - s1 * s1)
        off = np.abs(y - fit) / (6 * np.median(np.abs(y - fit)))
        off = np.where(off > 0.999, 1, np.where(off <= 0.001, 0, off))
        weight = (1 - off**2) ** 2
    return fit


@pytest.mark.parametrize(("n", "share"), [(40, 0.7), (151, 0.7), (300, 0.13), (900, 0.4)])
def test_lowess(n, share):
    rng = np.random.default_rng(n)
    y = 250 + 40 * np.sin(np.arange(n) / 20) + rng.normal(0, 30, n)
    y[::17] += 400
    np.testing.assert_allclose(M.smoothed(y, share, 3), plain_lowess(y, share, 3), rtol=1e-6)


def test_lowess_of_short_and_flat_series(spark):
    rows = [("a", 1, 5.0), ("b", 1, 1.0), ("b", 2, 9.0), ("c", 1, None), (None, 1, 2.0)] + [("d", i, 7.0) for i in range(20)]
    rows += [("e", i, 3.0 * i) for i in range(50)]
    got = M.lowess(spark.createDataFrame(rows, "k string, t int, y double"), ["k"], ["t"], "y").collect()
    assert len(got) == len(rows) - 1
    assert all(r.smooth == pytest.approx(r.y, abs=1e-6) for r in got)
    assert M.smoothed(np.arange(200_000.0), 0.7, 1)[1000] == pytest.approx(1000, abs=1e-3)


def test_exact_distributions(spark):
    df = spark.createDataFrame([(x,) for x in (-9.0, -3.0, -0.5, 0.0, 0.5, 1.0, 4.0, 9.0, 80.0, 300.0)], "x double")
    got = df.select("x", M.exact_normal_cdf(df["x"]).alias("n"), M.gamma_cdf(60.0, df["x"]).alias("g"), M.gamma_cdf(0.5, df["x"]).alias("h")).collect()
    for r in got:
        assert r.n == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), abs=1e-12)
        poisson = 1 - math.exp(-r.x) * sum(r.x**k / math.factorial(k) for k in range(60)) if r.x > 0 else 0.0
        assert r.g == pytest.approx(poisson, abs=1e-10)
        assert r.h == pytest.approx(math.erf(math.sqrt(r.x)) if r.x > 0 else 0.0, abs=1e-12)
    p = spark.createDataFrame([(0.8 / 10.131, 100), (1.36 / 10.131, 100)], "d double, n long")
    values = [r[0] for r in p.select(M.kolmogorov_p(p["d"], p["n"])).collect()]
    assert values == pytest.approx([0.5441, 0.0495], abs=1e-3)


def test_digamma(spark):
    df = spark.createDataFrame([(x,) for x in (0.3, 1.0, 7.5, 4000.0)], "x double")
    for x, d, t in df.select("x", M._digamma(df["x"]), M._digamma(df["x"], True)).collect():
        n = 2_000_000
        k = np.arange(n)
        assert d == pytest.approx(math.log(n + x - 0.5) - (1 / (x + k)).sum(), abs=1e-8)
        assert t == pytest.approx((1 / (x + k) ** 2).sum() + 1 / (n + x - 0.5), abs=1e-8)


def test_negative_binomial(spark):
    rng = np.random.default_rng(9)
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "p": rng.integers(0, 12, n)})
    mean = np.exp(1.5 + 0.4 * pdf["a"] + rng.normal(0, 0.4, 12)[pdf["p"]])
    pdf["y"] = rng.poisson(mean * rng.gamma(3.0, 1 / 3.0, n))
    fixed, out = M.negative_binomial(spark.createDataFrame(pdf), ["a"], "y", "p", ["id"])
    got = out.toPandas().sort_values("id")
    x = np.column_stack((np.ones(n), got["a"], got["p_encoded"]))
    y, b, size = got["y"].to_numpy(), np.array([fixed["intercept"], fixed["a"], fixed["p_encoded"]]), fixed["size"]
    np.testing.assert_allclose(np.exp(x @ b), got["count_pred"], rtol=1e-9)
    assert 2.2 < size < 4.2 and fixed["a"] == pytest.approx(0.4, abs=0.06)

    lgamma = np.vectorize(math.lgamma)

    def likelihood(b, size):
        m = np.exp(x @ b)
        return (lgamma(y + size) - math.lgamma(size) + size * np.log(size / (size + m)) + y * np.log(m / (size + m))).sum()

    best = likelihood(b, size)
    for i in range(3):
        for move in (-1e-3, 1e-3):
            assert likelihood(b + move * np.eye(3)[i], size) <= best
    assert likelihood(b, size * 1.01) <= best and likelihood(b, size / 1.01) <= best
    _, none = M.negative_binomial(spark.createDataFrame(pdf).limit(0), ["a"], "y", "p", ["id"])
    assert none.collect() == []


def test_time_series_fits(spark, data):
    pdf, _ = data
    pdf = pdf.assign(block=pdf["id"] // 150, pos=np.exp(1 + 0.3 * pdf["a"]) * np.random.default_rng(1).gamma(4, 0.25, len(pdf)))
    df = spark.createDataFrame(pdf)
    huber = {r["block"]: np.array(r["_coefs"]) for r in M.time_series_fits(df, ["a", "b"], "y", "block", ["huber"]).collect()}
    gamma = {r["block"]: np.array(r["_coefs"]) for r in M.time_series_fits(df, ["a", "b"], "pos", "block", ["gamma"]).collect()}
    assert sorted(huber) == sorted(gamma) == [1, 2, 3]
    for k in (1, 3):
        past = pdf[pdf["block"] < k]
        x = np.column_stack((np.ones(len(past)), past[["a", "b"]]))
        mean = np.exp(x @ gamma[k])
        np.testing.assert_allclose(x.T @ ((past["pos"] - mean) / mean), 0, atol=1e-4 * len(past))
        b, sd = np.zeros(3), np.array([0, past["a"].std(ddof=0), past["b"].std(ddof=0)])
        sigma, y = past["y"].std(), past["y"].to_numpy()
        for _ in range(500):
            e = np.abs(y - x @ b)
            w = np.where(e > 1.15 * sigma, 1.15 * sigma / np.maximum(e, 1e-300), 1.0)
            b = np.linalg.solve(x.T @ (x * w[:, None]) + 5 * sigma * np.diag(sd**2), x.T @ (w * y))
            e = np.abs(y - x @ b)
            out = e > 1.15 * sigma
            sigma = np.sqrt((e[~out] ** 2).sum() / (len(y) - 1.15**2 * out.sum()))
        np.testing.assert_allclose(huber[k], b, rtol=1e-4, atol=1e-4)
    scores = M.time_series_model_scores(df, ["a", "b"], "y", "block", models=("huber",)).toPandas().set_index("block")["mae"]
    own = pdf[pdf["block"] == 3]
    want = np.abs(own["y"] - np.column_stack((np.ones(len(own)), own[["a", "b"]])) @ huber[3]).mean()
    assert scores[3] == pytest.approx(want)
    assert M.time_series_fits(df.limit(0), ["a"], "y", "block").collect() == []


def test_boosted_gamma(spark):
    rng = np.random.default_rng(12)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "p": rng.integers(0, 9, n)})
    mean = np.exp(1 + np.where(pdf["a"] > 0.3, 0.8, 0.0) + rng.normal(0, 0.5, 9)[pdf["p"]])
    pdf["y"] = mean * rng.gamma(5, 0.2, n)
    df = spark.createDataFrame(pdf)
    losses, out = M.boosted_gamma(df, ["a"], "y", df["id"] % 5 != 0, "p", ["id"], rounds=14, rate=0.3)
    train, held = np.array(losses).T
    assert (np.diff(train) < 1e-9).all() and (np.diff(held[:8]) < 0).all()
    got = out.toPandas()
    ratio = got["y"] / got["boost_pred"]
    own = (2 * (ratio - 1 - np.log(ratio)))[~got["_fitted"]].mean()
    assert own == pytest.approx(held[-1]) and held[-1] < 0.6 * held[0]
    # the first tree's leaves hold the step that is best for their rows
    base = pdf.loc[pdf["id"] % 5 != 0, "y"].mean()
    _, one = M.boosted_gamma(df, ["a"], "y", df["id"] % 5 != 0, rounds=1, rate=1.0, depth=1)
    for _, rows in one.filter("_fitted").toPandas().groupby("boost_pred"):
        step = 1 - base / rows["y"].mean()
        assert np.log(rows["boost_pred"].iloc[0] / base) == pytest.approx(step, rel=1e-6)
    assert M.boosted_gamma(df.limit(0), ["a"], "y", df["id"] > 0)[0] == []
