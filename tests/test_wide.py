"""Weekly refits with players as categories, against fits on the whole dense matrix."""

import numpy as np
import pandas as pd
import pytest

from yardline.plans import wide

NUMBERS, SMALL = ["a", "b"], ["season", "roof"]
ALPHAS, NET_ALPHAS, RATIOS = (5.0, 50.0), (0.02, 0.3), (0.5, 1.0)
FIRST = 18


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    n = 700
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(70, 9, n)})
    pdf["season"], pdf["week"] = 2016 + pdf["id"] // 350, 1 + pdf["id"] % 350 // 25
    pdf["player"] = [f"p{min(int(rng.exponential(9)), 40)}" for _ in range(n)]
    pdf["roof"] = rng.choice(["dome", "out", None], n, p=[0.3, 0.68, 0.02])
    effect = {p: rng.normal(0, 3) for p in pdf["player"].unique()}
    pdf["y"] = 5 + 2 * pdf["a"] - 0.2 * pdf["b"] + pdf["player"].map(effect) + rng.standard_t(3, size=n)
    pdf.loc[[3, 400], "a"] = np.nan
    pdf.loc[[5, 600], "y"] = np.nan
    pdf.loc[rng.integers(0, n, 12), "player"] = None
    return pdf


@pytest.fixture(scope="module")
def fitted(spark, data):
    schema = "id long, a double, b double, season long, week long, player string, roof string, y double"
    rows = [tuple(None if v is None or v != v else v for v in r) for r in data[["id", "a", "b", "season", "week", "player", "roof", "y"]].itertuples(index=False)]
    df = spark.createDataFrame(rows, schema).repartition(5)
    out = wide.walk_forward_wide(
        df, NUMBERS, SMALL, "player", "y", ["id"], alphas=ALPHAS, net_alphas=NET_ALPHAS, net_ratios=RATIOS, folds=3, first_week=FIRST, huber_alpha=5.0
    )
    assert out.columns[: len(df.columns)] == df.columns
    folds = df.select("id", wide.hash_fold(["id"], 3, 4416).alias("f")).toPandas().set_index("id")["f"]
    return out.toPandas().set_index("id"), folds


def dense(train, rows):
    """Indicator and standardised columns of rows, as the training rows define them; which are penalised."""
    parts, pen = [np.ones(len(rows))], [0.0]
    for n in NUMBERS:
        parts.append((rows[n] - train[n].mean()) / train[n].std(ddof=0))
        pen.append(1.0)
    for n in (*SMALL, "player"):
        key = lambda f: f[n].astype(object).where(f[n].notna(), "none").astype(str)  # noqa: B023, E731
        counts = key(train).value_counts()
        often = sorted(counts[counts >= 6].index)
        for v in often:
            parts.append((key(rows) == v).astype(float))
            pen.append(1.0)
        if (counts < 6).any():
            parts.append((~key(rows).isin(often)).astype(float))
            pen.append(1.0)
    return np.column_stack(parts), np.array(pen)


def weeks_to_try(data):
    weeks = sorted(set(zip(data["season"], data["week"])))
    return [weeks[i] for i in (FIRST + 1, FIRST + 4, len(weeks) - 1)]


def split(data, season, week):
    good = data[data["a"].notna()]
    past = (good["season"] < season) | ((good["season"] == season) & (good["week"] < week))
    return good[past & good["y"].notna()], good[(good["season"] == season) & (good["week"] == week)]


def test_rows(data, fitted):
    got, _ = fitted
    weeks = sorted(set(zip(data["season"], data["week"])))
    want = {i for i, s, w, a in zip(data["id"], data["season"], data["week"], data["a"]) if (s, w) >= weeks[FIRST + 1] and a == a}
    assert set(got.index) == want and got.index.is_unique
    np.testing.assert_allclose(got["ensemble"], got[["ridge_preds", "en_preds", "huber_preds"]].mean(axis=1))


def test_ridge(data, fitted):
    got, _ = fitted
    for season, week in weeks_to_try(data):
        train, rows = split(data, season, week)
        x, pen = dense(train, train)
        y, fits = train["y"].to_numpy(), []
        for alpha in ALPHAS:
            inverse = np.linalg.pinv(x.T @ x + alpha * np.diag(pen))
            w = inverse @ x.T @ y
            free = len(y) - np.trace(inverse @ x.T @ x)
            fits.append((len(y) * ((y - x @ w) ** 2).sum() / free**2, alpha, w))
        _, alpha, w = min(fits, key=lambda f: f[0])
        own = got.loc[rows["id"]]
        assert set(own["ridge_alpha"]) == {alpha}
        np.testing.assert_allclose(own["ridge_preds"], dense(train, rows)[0] @ w, rtol=1e-7)


def net(x, y, pen, alpha, ratio):
    w, n = np.zeros(x.shape[1]), len(y)
    gram, target = x.T @ x / n, x.T @ y / n
    for _ in range(20_000):
        before = w.copy()
        for j in range(len(w)):
            left = target[j] - gram[j] @ w + gram[j, j] * w[j]
            size = gram[j, j] + alpha * (1 - ratio) * pen[j]
            w[j] = np.sign(left) * max(abs(left) - alpha * ratio * pen[j], 0) / size if size > 0 else 0
        if np.abs(w - before).max() < 1e-10:
            break
    return w


def test_elastic_net(data, fitted):
    got, folds = fitted
    for season, week in weeks_to_try(data):
        train, rows = split(data, season, week)
        x, pen = dense(train, train)
        y, fold = train["y"].to_numpy(), folds.loc[train["id"]].to_numpy()
        errors = {}
        for ratio in RATIOS:
            for alpha in sorted(NET_ALPHAS, reverse=True):
                e = []
                for f in range(3):
                    w = net(x[fold != f], y[fold != f], pen, alpha, ratio)
                    e.append(((y - x @ w)[fold == f] ** 2).mean())
                errors[alpha, ratio] = np.mean(e)
        best = min(errors, key=errors.get)
        own = got.loc[rows["id"]]
        assert set(zip(own["en_alpha"], own["en_ratio"])) == {best}
        np.testing.assert_allclose(own["en_preds"], dense(train, rows)[0] @ net(x, y, pen, *best), atol=2e-4)


def test_huber(data, fitted):
    got, _ = fitted
    for season, week in weeks_to_try(data):
        train, rows = split(data, season, week)
        x, pen = dense(train, train)
        y, sigma, w = train["y"].to_numpy(), train["y"].std(), np.zeros(x.shape[1])
        for _ in range(2000):
            e = np.abs(y - x @ w)
            weight = np.where(e > 1.15 * sigma, 1.15 * sigma / np.maximum(e, 1e-300), 1.0)
            new = np.linalg.pinv(x.T @ (x * weight[:, None]) + 5 * sigma * np.diag(pen)) @ x.T @ (weight * y)
            e = np.abs(y - x @ new)
            out = e > 1.15 * sigma
            size = np.sqrt((e[~out] ** 2).sum() / (len(y) - 1.15**2 * out.sum()))
            moved = max(np.abs(new - w).max(), abs(size / sigma - 1))
            w, sigma = new, size
            if moved < 1e-9:
                break
        np.testing.assert_allclose(got.loc[rows["id"]]["huber_preds"], dense(train, rows)[0] @ w, atol=2e-3)


def test_no_rows_and_too_many_values(spark):
    empty = spark.createDataFrame([], "id long, a double, season long, week long, player string, roof string, y double")
    assert wide.walk_forward_wide(empty, ["a"], ["roof"], "player", "y", ["id"]).collect() == []
    many = spark.range(300).selectExpr("id", "1.0D AS a", "1 AS season", "1 AS week", "'p' AS player", "string(id) AS roof", "1.0D AS y")
    with pytest.raises(ValueError, match="roof"):
        wide.walk_forward_wide(many, ["a"], ["roof"], "player", "y", ["id"])
