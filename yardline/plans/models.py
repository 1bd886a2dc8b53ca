"""Regression jobs.

Least-squares models are fitted from Gram matrices: one aggregate over the rows gives X'X, X'y and y'y per
fold or per week, and everything after it is a solve the size of the feature list. Other models are
``pyspark.ml`` estimators.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.operators.aggregates import overall_quantiles, with_group
from yardline.operators.windows import add_features, cumulative_sum, prior_totals
from yardline.session import settle


def c(name: str) -> Column:
    return F.col(name)


# --- encoding and scaling ----------------------------------------------------------------------------
def target_encode(
    df: DataFrame, key: str, y: str, order: Sequence[str], train: Column | None = None, **size
) -> DataFrame:
    """Ordered target encoding: (sum of earlier targets + mean) / (earlier rows + 1) for training rows,
    the same from all training rows of the key for the others."""
    is_train = F.lit(True) if train is None else train
    rows = df.withColumn("_train", is_train).withColumn("_y", F.when(c("_train"), c(y).cast("double")))
    rows = add_features(rows, [key], order, {"_p": prior_totals("_y")}, **size)
    rows = with_group(rows, [key], {"_s": F.coalesce(F.sum("_y"), F.lit(0.0)), "_n": F.count("_y")})
    rows = with_group(rows, [], {"_m": F.avg("_y")})
    past = (c("_p.total") + c("_m")) / (c("_p.n") + 1)
    whole = (c("_s") + c("_m")) / (c("_n") + 1)
    out = rows.withColumn(f"{key}_encoded", F.when(c("_train"), past).otherwise(whole))
    return out.drop("_train", "_y", "_p", "_s", "_n", "_m")


def rare_bucket(df: DataFrame, col: str, at_least: int = 6, name: str | None = None, train: Column | None = None) -> DataFrame:
    """Replace categories seen fewer than ``at_least`` times (in training rows) by ``rare``."""
    seen = df if train is None else df.filter(train)
    common = seen.groupBy(c(col).alias("_c")).agg(F.count(F.lit(1)).alias("_n")).filter(c("_n") >= at_least)
    rows = df.join(common.drop("_n"), c(col) == c("_c"), "left")
    return rows.withColumn(name or f"{col}_bucket", F.coalesce("_c", F.lit("rare"))).drop("_c")


def one_hot(
    df: DataFrame, cols: Sequence[str], at_least: int = 6, train: Column | None = None
) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per common category, and ``<col>_rare`` for all others, unknown ones and nulls.

    Common: seen ``at_least`` times in training rows, however many such categories there are. Returns the frame and the
    names of the new columns.
    """
    seen = df if train is None else df.filter(train)
    added: dict[str, Column] = {}
    for col in cols:
        counts = seen.filter(c(col).isNotNull()).groupBy(c(col).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        common = [r["v"] for r in counts.filter(c("n") >= at_least).orderBy(F.desc("n"), "v").collect()]
        value = c(col).cast("string")
        added |= {f"{col}_{v}": F.coalesce(value == v, F.lit(False)).cast("double") for v in common}
        added[f"{col}_rare"] = (~F.coalesce(value.isin(common), F.lit(False))).cast("double")
    return df.withColumns(added), list(added)


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation."""
    stats = {f"_m_{n}": F.avg(n) for n in cols} | {f"_s_{n}": F.stddev_pop(n) for n in cols}
    rows = with_group(df, [], stats)
    scaled = {f"{n}_scaled": F.try_divide(c(n) - c(f"_m_{n}"), c(f"_s_{n}")) for n in cols}
    return rows.withColumns(scaled).drop(*stats)


def robust_scale(df: DataFrame, cols: Sequence[str], *, floor: int | None = None) -> DataFrame:
    """(x - median) / interquartile range, from exact quantiles."""
    wanted = {f"_{n}_{end}": (n, p) for n in cols for end, p in (("lo", 0.25), ("mid", 0.5), ("hi", 0.75))}
    q = overall_quantiles(df, wanted, floor=floor)
    scaled = {f"{n}_scaled": F.try_divide(c(n) - q[f"_{n}_mid"], q[f"_{n}_hi"] - q[f"_{n}_lo"]) for n in cols}
    return df.withColumns(scaled)


# --- Gram matrices -----------------------------------------------------------------------------------
class Gram:
    """Sums of products of (1, x..., y)."""

    def __init__(self, m: np.ndarray):
        self.m = m

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.m + other.m)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.m - other.m)

    @property
    def n(self) -> float:
        return float(self.m[0, 0])

    def ridge(self, alpha: float = 0.0, scale: bool = False, intercept: bool = True) -> tuple[float, np.ndarray, float]:
        """Intercept (not penalised; 0 without one), coefficients, generalised cross-validation score."""
        n = self.n
        mean = self.m[0] / n if intercept else np.zeros(len(self.m))
        cov = self.m[1:, 1:] - n * np.outer(mean[1:], mean[1:])
        a, b, yy = cov[:-1, :-1], cov[:-1, -1], cov[-1, -1]
        sd = np.sqrt(np.maximum(np.diag(a) / n, 0)) if scale else np.ones(len(b))
        sd = np.where(sd > 0, sd, 1.0)
        a, b = a / np.outer(sd, sd), b / sd
        inv = np.linalg.pinv(a + alpha * np.eye(len(b)))
        w = inv @ b
        rss = max(yy - 2 * w @ b + w @ a @ w, 0.0)
        free = n - int(intercept) - np.trace(inv @ a)
        score = n * rss / free**2 if free > 0 else math.inf
        w = w / sd
        return float(mean[-1] - w @ mean[1:-1]), w, score

    def elastic_net(self, alpha: float, l1_ratio: float, steps: int = 1000, tolerance: float = 1e-9) -> tuple[float, np.ndarray]:
        """Intercept and coefficients on standardised features, by coordinate descent on the products."""
        n = self.n
        mean = self.m[0] / n
        cov = self.m[1:, 1:] / n - np.outer(mean[1:], mean[1:])
        sd = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
        used = sd > 0
        sd = np.where(used, sd, 1.0)
        a, b = cov[:-1, :-1] / np.outer(sd, sd), cov[:-1, -1] / sd
        w = np.zeros(len(b))
        for _ in range(steps):
            moved = 0.0
            for j in np.flatnonzero(used):
                r = b[j] - a[j] @ w + a[j, j] * w[j]
                new = np.sign(r) * max(abs(r) - alpha * l1_ratio, 0.0) / (a[j, j] + alpha * (1 - l1_ratio))
                moved, w[j] = max(moved, abs(new - w[j])), new
            if moved <= tolerance * max(1.0, float(np.abs(w).max(initial=0.0))):
                break
        w = w / sd
        return float(mean[-1] - w @ mean[1:-1]), w

    def best_ridge(self, alphas: Sequence[float], scale: bool = False) -> tuple[float, np.ndarray, float]:
        """Ridge with the alpha of the lowest score; returns intercept, coefficients, alpha."""
        fits = [(*self.ridge(a, scale), a) for a in alphas]
        best = min(fits, key=lambda f: f[2])
        return best[0], best[1], best[3]


def gram_table(df: DataFrame, xs: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` group with the sums of products; rows with a null input are left out."""
    names = ["_one", *xs, y]
    rows = df.na.drop("any", subset=[*xs, y]).withColumn("_one", F.lit(1.0))
    aggs = []
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            aggs.append(F.sum(c(a).cast("double") * c(names[j]).cast("double")).alias(f"m_{i}_{j}"))
    return rows.groupBy(*by).agg(*aggs)


def read_gram(row, size: int) -> Gram:
    m = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            m[i, j] = m[j, i] = row[f"m_{i}_{j}"] or 0.0
    return Gram(m)


def solved(table: DataFrame, by: Sequence[str], xs: Sequence[str], solve: Callable[[Gram], list[float]]) -> DataFrame:
    """Coefficients (array ``_coefs``) of each row of a Gram table: one small solve per row, in the tasks."""
    size = len(xs) + 2
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            coefs = [[float(v) for v in solve(read_gram(row, size))] for row in pdf.to_dict("records")]
            yield pdf[list(by)].assign(_coefs=coefs)

    return table.mapInPandas(run, ", ".join(f"`{n}` {kinds[n]}" for n in by) + ", _coefs array<double>")


def _sums(table: DataFrame) -> list[str]:
    return [n for n in table.columns if n.startswith("m_")]


def linear_prediction(xs: Sequence[str], coefs: Column) -> Column:
    """Prediction from a row's coefficients, an array starting with the intercept."""
    out = coefs[0]
    for i, x in enumerate(xs):
        out = out + coefs[i + 1] * c(x).cast("double")
    return out


def out_of_fold(df: DataFrame, xs: Sequence[str], y: str, fold: str, alpha: float = 0.0, name: str = "oof") -> DataFrame:
    """Predict each fold from a model fitted on the other folds; one pass for all fits."""
    df = settle(df)
    parts = settle(gram_table(df, xs, y, [fold]))
    names = _sums(parts)
    others = with_group(parts, [], {f"_all_{n}": F.sum(n) for n in names})
    others = others.select(fold, *[(c(f"_all_{n}") - c(n)).alias(n) for n in names])

    def solve(g: Gram) -> list[float]:
        b0, w, _ = g.ridge(alpha)
        return [b0, *w]

    rows = df.join(solved(others, [fold], xs, solve), [fold], "left")
    return rows.withColumn(name, linear_prediction(xs, c("_coefs"))).drop("_coefs").select(*df.columns, name)


def time_series_scores(
    df: DataFrame, xs: Sequence[str], y: str, fold: str, alphas: Sequence[float], scale: bool = True
) -> DataFrame:
    """Mean absolute error per alpha and test block; block k is predicted from all lower blocks."""
    df = settle(df)
    parts = settle(gram_table(df, xs, y, [fold]))
    earlier = Window.orderBy(fold).rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    past = parts.select(fold, *[F.sum(n).over(earlier).alias(n) for n in _sums(parts)])

    def solve(g: Gram) -> list[float]:
        return [v for a in alphas for b0, w, _ in [g.ridge(a, scale)] for v in (b0, *w)]

    coefs = solved(past.filter((c(fold) > 0) & c("m_0_0").isNotNull()), [fold], xs, solve)
    rows = df.filter(c(fold) > 0).join(coefs, [fold], "left").na.drop("any", subset=[*xs, y])
    p = len(xs) + 1
    maes = []
    for i, a in enumerate(alphas):
        pred = linear_prediction(xs, F.slice("_coefs", i * p + 1, p))
        maes.append(F.struct(F.lit(float(a)).alias("alpha"), F.avg(F.abs(c(y) - pred)).alias("mae")))
    return rows.groupBy(fold).agg(F.array(*maes).alias("_m")).select(fold, F.inline("_m"))


def _known_by(parts: DataFrame, legacy_cutoff: bool) -> DataFrame:
    """Running sums of a Gram table over its weeks: everything up to a week, or, as the legacy cutoff has it, every
    earlier or equal season with an earlier or equal week number. One row per week of the calendar."""
    names = _sums(parts)
    if not legacy_cutoff:
        upto = Window.orderBy("season", "week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return parts.select("season", "week", *[F.sum(n).over(upto).alias(n) for n in names])
    calendar = parts.agg(F.collect_set("season").alias("s"), F.collect_set("week").alias("w"))
    grid = calendar.select(F.explode("s").alias("season"), "w").select("season", F.explode("w").alias("week"))
    grid = grid.join(parts, ["season", "week"], "left").na.fill(0.0, subset=names)
    for by, order in (("week", "season"), ("season", "week")):
        upto = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        grid = grid.select("season", "week", *[F.sum(n).over(upto).alias(n) for n in names])
    return grid.join(parts.select("season", "week"), ["season", "week"], "left_semi")


def _weekly(df: DataFrame, xs: Sequence[str], y: str, first_week: int, legacy_cutoff: bool = False) -> DataFrame:
    """What is known before each week from the one after ``first_week`` on: a Gram table by season and week."""
    parts = settle(gram_table(df, xs, y, ["season", "week"]))
    order = Window.orderBy("season", "week")
    weeks = parts.select("season", "week", F.row_number().over(order).alias("_i"),
                         F.lead("season").over(order).alias("_s"), F.lead("week").over(order).alias("_w"))
    known = _known_by(parts, legacy_cutoff).join(weeks, ["season", "week"])
    known = known.filter((c("_i") > first_week) & c("_s").isNotNull())
    return known.select(c("_s").alias("season"), c("_w").alias("week"), *_sums(parts))


def walk_forward(
    df: DataFrame, xs: Sequence[str], y: str, alphas: Sequence[float] = (10, 100, 200, 500, 1000),
    first_week: int = 50, legacy_cutoff: bool = False, name: str = "preds",
) -> DataFrame:
    """Refit a standardised ridge each week on everything played, predict the next week.

    All fits come from one aggregate per (season, week). ``legacy_cutoff`` trains on rows with an earlier or
    equal season *and* an earlier or equal week number instead of everything before.
    """
    df = settle(df)

    def solve(g: Gram) -> list[float]:
        b0, w, _ = g.best_ridge(alphas, scale=True)
        return [b0, *w]

    rows = df.join(solved(_weekly(df, xs, y, first_week, legacy_cutoff), ["season", "week"], xs, solve), ["season", "week"])
    return rows.withColumn(name, linear_prediction(xs, c("_coefs"))).drop("_coefs").select(*df.columns, name)


def walk_forward_models(
    df: DataFrame, xs: Sequence[str], y: str, *, alphas: Sequence[float] = (10, 100, 200, 500, 1000),
    net: tuple[float, float] = (0.1, 0.5), epsilon: float = 1.15, huber_alpha: float = 5.0, first_week: int = 50,
) -> DataFrame:
    """Ridge, elastic net and Huber regression refitted each week on everything played, and their mean, for the next
    week: ``ridge_preds``, ``en_preds``, ``huber_preds``, ``ensemble``.

    Ridge and net need the weekly products only. Huber's weights depend on each fit, so a pass over the rows adds up
    the weighted products of all weeks' fits at once.
    """
    df = settle(df)
    known = settle(_weekly(df, xs, y, first_week))
    p = len(xs) + 1

    def solve(g: Gram) -> list[float]:
        b0, w, _ = g.best_ridge(alphas, scale=True)
        e0, e = g.elastic_net(*net)
        return [b0, *w, e0, *e]

    rows = df.join(solved(known, ["season", "week"], xs, solve), ["season", "week"])
    rows = rows.withColumns({n: linear_prediction(xs, F.slice("_coefs", i * p + 1, p)) for i, n in enumerate(("ridge_preds", "en_preds"))})
    robust = huber_by_week(df, known, xs, y, epsilon, huber_alpha)
    rows = rows.drop("_coefs").join(robust, ["season", "week"])
    rows = rows.withColumn("huber_preds", linear_prediction(xs, c("_coefs"))).drop("_coefs")
    rows = rows.withColumn("ensemble", (c("ridge_preds") + c("en_preds") + c("huber_preds")) / 3)
    return rows.select(*df.columns, "ridge_preds", "en_preds", "huber_preds", "ensemble")


def huber_by_week(
    df: DataFrame, known: DataFrame, xs: Sequence[str], y: str, epsilon: float, alpha: float, passes: int = 100, tolerance: float = 1e-5
) -> DataFrame:
    """Coefficients of Huber regressions, with a scale of their own, on the rows before each week of ``known``.

    Re-weighted least squares; the driver holds the products of every week, a number that only the calendar sets.
    """
    size = len(xs) + 2
    grams = {(r["season"], r["week"]): read_gram(r, size) for r in known.collect()}
    weeks = sorted(grams)
    kinds = {f.name: f.dataType.simpleString() for f in known.schema.fields}
    schema = f"season {kinds['season']}, week {kinds['week']}, _coefs array<double>"
    if not weeks:
        return df.sparkSession.createDataFrame([], schema)
    rows = df.select("season", "week", *[c(n).cast("double").alias(n) for n in [*xs, y]]).na.drop()
    rows = settle(rows)
    spread = [np.sqrt(np.maximum(np.diag(g.m)[1:-1] / g.n - (g.m[0, 1:-1] / g.n) ** 2, 0)) for g in (grams[w] for w in weeks)]
    fits = [grams[w].ridge() for w in weeks]
    beta = np.array([[b0, *w] for b0, w, _ in fits])
    scale = np.array([math.sqrt(max(float(np.append(-b, 1.0) @ grams[w].m @ np.append(-b, 1.0)) / grams[w].n, 1e-12))
                      for w, b in zip(weeks, beta, strict=True)])
    moved = math.inf
    for _ in range(passes):
        sums = _huber_sums(rows, weeks, beta, scale, epsilon, size)
        new, new_scale = np.empty_like(beta), np.empty_like(scale)
        for i, s in enumerate(sums):
            m = s[:-3].reshape(size, size)
            penalty = np.diag([0.0, *(alpha * scale[i] * spread[i] ** 2)])
            new[i] = np.linalg.lstsq(m[:-1, :-1] + penalty, m[:-1, -1], rcond=None)[0]
            inside, out, n = s[-3:]
            new_scale[i] = math.sqrt(max(inside / max(n - epsilon**2 * out, 1.0), 1e-12))
        step = np.abs((new - beta) * np.array([[1.0, *s] for s in spread])).max(axis=1) / scale
        moved = max(float(step.max()), float(np.abs(new_scale / scale - 1).max()))
        beta, scale = new, new_scale
        if moved < tolerance:
            break
    else:
        warnings.warn(f"Huber fits still move by {moved:.1e} of their scale after {passes} passes", stacklevel=2)
    return df.sparkSession.createDataFrame([(*w, [float(v) for v in b]) for w, b in zip(weeks, beta, strict=True)], schema)


def _huber_sums(
    rows: DataFrame, weeks: Sequence[tuple[int, int]], beta: np.ndarray, scale: np.ndarray, epsilon: float, size: int
) -> np.ndarray:
    """Per week, of the rows before it: weighted products, squared residuals inside, rows outside, rows."""
    starts = np.array([s * 100 + w for s, w in weeks])  # weeks of a season have two digits

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(weeks), size * size + 3))
        for pdf in batches:
            at = (pdf["season"] * 100 + pdf["week"]).to_numpy()
            order = np.argsort(at, kind="stable")
            v = np.column_stack([np.ones(len(pdf)), pdf.iloc[:, 2:].to_numpy(dtype=float)])[order]
            for i, n in enumerate(np.searchsorted(at[order], starts).tolist()):
                own = v[:n]
                e = np.abs(own[:, -1] - own[:, :-1] @ beta[i])
                far = e > epsilon * scale[i]
                weight = np.where(far, epsilon * scale[i] / np.maximum(e, 1e-300), 1.0)
                acc[i, :-3] += ((own * weight[:, None]).T @ own).ravel()
                acc[i, -3:] += (e[~far] ** 2).sum(), far.sum(), n
        i, j = np.indices(acc.shape)
        yield pd.DataFrame({"w": i.ravel(), "at": j.ravel(), "v": acc.ravel()})

    parts = rows.mapInPandas(fold, "w int, at int, v double").groupBy("w", "at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((len(weeks), size * size + 3))
    out[parts["w"], parts["at"]] = parts["v"]
    return out


def quantile_regression(
    df: DataFrame, xs: Sequence[str], y: str, probs: Sequence[float] = (0.05, 0.5, 0.95),
    passes: int = 60, eps: float = 1e-4, tolerance: float = 1e-6,
) -> dict[float, list[float]]:
    """Quantile regression by iteratively re-weighted least squares; all quantiles share a pass.

    A pass is one Spark job: each task adds up, batch by batch, the weighted Gram matrix and the pinball
    loss of every quantile, and Spark sums the tasks' few numbers. It stops when no loss changes, and warns
    if that doesn't happen.
    """
    size = len(xs) + 2
    rows = settle(df.select(*[c(x).cast("double").alias(x) for x in xs], c(y).cast("double").alias(y)).na.drop())
    b0, w, _ = read_gram(gram_table(rows, xs, y).first(), size).ridge()
    coefs = {p: np.array([b0, *w]) for p in probs}
    first = rows.agg(F.stddev_pop(y).alias("s"), F.count(F.lit(1)).alias("n")).first()
    spread, n = first["s"] or 1.0, first["n"]
    losses = dict.fromkeys(probs, math.inf)
    best = {p: (math.inf, coefs[p]) for p in probs}
    for _ in range(passes):
        sums = _irls_sums(rows, coefs, eps * spread, size)
        moved = 0.0
        for p in probs:
            gram, loss = sums[p][:-1].reshape(size, size), sums[p][-1] / n
            if loss < best[p][0]:
                best[p] = (loss, coefs[p])
            moved = max(moved, abs(losses[p] - loss) / spread)
            losses[p] = loss
            b0, w, _ = Gram(gram).ridge()
            coefs[p] = np.array([b0, *w])
        if moved < tolerance:
            break
    else:
        warnings.warn(f"quantile regression still moves by {moved:.1e} of the spread after {passes} passes", stacklevel=2)
    return {p: [float(v) for v in best[p][1]] for p in probs}


def _irls_sums(rows: DataFrame, coefs: dict[float, np.ndarray], floor: float, size: int) -> dict[float, np.ndarray]:
    probs = list(coefs)
    given = [coefs[p] for p in probs]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(probs), size * size + 1))
        for pdf in batches:
            v = np.column_stack([np.ones(len(pdf)), pdf.to_numpy(dtype=float)])
            for i, p in enumerate(probs):
                e = v[:, -1] - v[:, :-1] @ given[i]
                side = np.where(e >= 0, p, 1 - p)
                weight = side / np.maximum(np.abs(e), floor)
                acc[i, :-1] += ((v * weight[:, None]).T @ v).ravel()
                acc[i, -1] += side @ np.abs(e)
        i, j = np.indices(acc.shape)
        yield pd.DataFrame({"q": i.ravel(), "at": j.ravel(), "v": acc.ravel()})

    parts = rows.mapInPandas(fold, "q int, at int, v double").groupBy("q", "at").agg(F.sum("v").alias("v"))
    out = np.zeros((len(probs), size * size + 1))
    for r in parts.collect():  # one number per quantile and matrix entry
        out[r["q"], r["at"]] = r["v"]
    return {p: out[i] for i, p in enumerate(probs)}


def fold_quantiles(
    df: DataFrame, xs: Sequence[str], y: str, fold: str, probs: Sequence[float] = (0.05, 0.5, 0.95),
    passes: int = 60, eps: float = 1e-5, tolerance: float = 2e-6,
) -> DataFrame:
    """Quantile regressions of each fold on the rows of all other folds: rows (fold, ``_coefs``), the coefficients of every quantile behind
    each other. A row has one fold (an integer); rows with a null input take no part.

    Iteratively re-weighted least squares, all folds and quantiles in one pass over the rows: a row adds to the sums of
    every fold but its own. What reaches the driver are the sums of each fold and quantile. The floor under the residuals, which
    rounds the loss off, comes down with the passes.
    """
    size, q = len(xs) + 2, len(probs)
    rows = df.select(c(fold).cast("int").alias("_fold"), *[c(x).cast("double").alias(x) for x in xs], c(y).cast("double").alias(y)).na.drop()
    rows = settle(rows)
    grams = {r["_fold"]: read_gram(r, size) for r in gram_table(rows, xs, y, ["_fold"]).collect()}
    folds = sorted(grams)
    schema = f"`{fold}` int, _coefs array<double>"
    if not folds:
        return df.sparkSession.createDataFrame([], schema)
    whole = Gram(sum(g.m for g in grams.values()))
    fits = [(whole - grams[k]).ridge() for k in folds]
    coefs = np.repeat(np.array([[b0, *w] for b0, w, _ in fits]), q, axis=0)  # [fold and quantile, coefficient]
    n = np.repeat(np.array([max((whole - grams[k]).n, 1.0) for k in folds]), q)
    mean = whole.m[0, -1] / whole.n
    spread = math.sqrt(max(whole.m[-1, -1] / whole.n - mean * mean, 0.0)) or 1.0
    best, lowest, before = coefs.copy(), np.full(len(coefs), math.inf), np.full(len(coefs), math.inf)
    floor, moved = 0.03, math.inf
    for _ in range(passes):
        sums = _fold_sums(rows, folds, probs, coefs, floor * spread, size)
        loss = sums[:, -1] / n
        better = loss < lowest
        best[better], lowest[better] = coefs[better], loss[better]
        moved = float((np.abs(before - loss) / spread).max())
        if moved < tolerance and floor <= eps:
            break
        before, floor = loss, max(floor * 0.5, eps)
        solved_ = [Gram(v[:-1].reshape(size, size)).ridge() for v in sums]
        coefs = np.array([[b0, *w] for b0, w, _ in solved_])
    else:
        warnings.warn(f"quantile regressions still move by {moved:.1e} of the spread after {passes} passes", stacklevel=2)
    table = [(k, [float(v) for v in best[i * q : (i + 1) * q].ravel()]) for i, k in enumerate(folds)]
    return df.sparkSession.createDataFrame(table, schema)


def _fold_sums(rows: DataFrame, folds: Sequence[int], probs: Sequence[float], coefs: np.ndarray, floor: float, size: int) -> np.ndarray:
    """Per fold and quantile, of the rows of other folds: weighted products and the loss."""
    level = np.tile(np.array(probs), len(folds))
    own = np.repeat(np.array(folds), len(probs))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(own), size * size + 1))
        for pdf in batches:
            at = pdf.iloc[:, 0].to_numpy()
            v = np.column_stack([np.ones(len(pdf)), pdf.iloc[:, 1:].to_numpy(dtype=float)])
            e = v[:, -1:] - v[:, :-1] @ coefs.T
            side = np.where(e >= 0, level, 1 - level) * (at[:, None] != own)
            acc[:, :-1] += (side / np.maximum(np.abs(e), floor)).T @ (v[:, :, None] * v[:, None, :]).reshape(len(v), -1)
            acc[:, -1] += (side * np.abs(e)).sum(axis=0)
        i, j = np.indices(acc.shape)
        yield pd.DataFrame({"fit": i.ravel(), "at": j.ravel(), "v": acc.ravel()})

    parts = rows.mapInPandas(fold, "fit int, at int, v double").groupBy("fit", "at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((len(own), size * size + 1))
    out[parts["fit"], parts["at"]] = parts["v"]
    return out


def stack(
    df: DataFrame, xs: Sequence[str], y: str, fold: str, probs: Sequence[float] = (0.05, 0.5, 0.95), name: str = "oof"
) -> DataFrame:
    """Combine predictions ``xs`` of several models: each fold gets the linear and quantile fits of all other folds, as ``oof`` and
    ``oof_5``, ``oof_50``, ``oof_95``. Rows with a null among ``xs`` or without a fold have null results."""
    df = settle(df)
    rows = out_of_fold(df, xs, y, fold, name=name)
    table = fold_quantiles(df, xs, y, fold, probs).withColumnRenamed(fold, "_of")
    rows = rows.join(F.broadcast(table), c(fold) == c("_of"), "left")  # a row per fold
    p = len(xs) + 1
    quantile = {f"{name}_{round(100 * v)}": linear_prediction(xs, F.slice("_coefs", i * p + 1, p)) for i, v in enumerate(probs)}
    return rows.withColumns(quantile).drop("_coefs", "_of")


def time_series_fits(
    df: DataFrame, xs: Sequence[str], y: str, fold: str, models: Sequence[str] = ("gamma", "huber"), epsilon: float = 1.15, alpha: float = 5.0,
    passes: int = 100, tolerance: float = 1e-7,
) -> DataFrame:
    """Gamma regressions (log link, positive targets) and Huber regressions of each test block on all lower blocks: rows (fold, model,
    ``_coefs``). Block 0 is only trained on.

    The fits of all blocks share the passes: a row adds its re-weighted products, or working targets, to the sums of every block above
    its own. Penalties of the Huber fits are on standardised features.
    """
    size = len(xs) + 2
    rows = df.select(c(fold).cast("int").alias("_fold"), *[c(x).cast("double").alias(x) for x in xs], c(y).cast("double").alias(y)).na.drop()
    rows = settle(rows)
    out: list[tuple[int, str, list[float]]] = []
    for model in models:
        used = rows.filter(c(y) > 0) if model == "gamma" else rows
        used = used.withColumn(y, F.log(c(y))) if model == "gamma" else used  # the first guess is a line through the logarithms
        grams = {r["_fold"]: read_gram(r, size) for r in gram_table(used, xs, y, ["_fold"]).collect()}
        blocks = [k for k in sorted(grams) if any(j < k for j in grams)]
        if not blocks:
            continue
        past = [Gram(sum(g.m for j, g in grams.items() if j < k)) for k in blocks]
        fits = [g.ridge() for g in past]
        beta = np.array([[b0, *w] for b0, w, _ in fits])
        spread = np.array([np.sqrt(np.maximum(np.diag(g.m)[:-1] / g.n - (g.m[0, :-1] / g.n) ** 2, 0)) for g in past])
        scale = np.array([math.sqrt(max(float(np.append(-b, 1.0) @ g.m @ np.append(-b, 1.0)) / g.n, 1e-12)) for g, b in zip(past, beta, strict=True)])
        moved = math.inf
        for _ in range(passes):
            sums = _block_sums(rows, blocks, beta, scale, epsilon, size, model)
            m = sums[:, :-3].reshape(-1, size, size)
            a = m[:, :-1, :-1].copy()
            if model == "huber":
                i = np.arange(size - 1)
                a[:, i, i] += alpha * scale[:, None] * spread**2
                inside, outside, n = sums[:, -3:].T
                new_scale = np.sqrt(np.maximum(inside / np.maximum(n - epsilon**2 * outside, 1.0), 1e-12))
            else:
                new_scale = scale
            new = np.array([np.linalg.lstsq(v, b, rcond=None)[0] for v, b in zip(a, m[:, :-1, -1], strict=True)])
            unit = np.maximum(spread, 1e-12)
            unit[:, 0] = 1.0
            moved = float(max((np.abs(new - beta) * unit / (scale[:, None] if model == "huber" else 1.0)).max(), np.abs(new_scale / scale - 1).max()))
            beta, scale = new, new_scale
            if moved < tolerance:
                break
        else:
            warnings.warn(f"{model} fits still move by {moved:.1e} after {passes} passes", stacklevel=2)
        out += [(k, model, [float(v) for v in b]) for k, b in zip(blocks, beta, strict=True)]
    return df.sparkSession.createDataFrame(out, f"`{fold}` int, model string, _coefs array<double>")


def _block_sums(
    rows: DataFrame, blocks: Sequence[int], beta: np.ndarray, scale: np.ndarray, epsilon: float, size: int, model: str
) -> np.ndarray:
    """Per block, of the rows of lower blocks: weighted products, squared residuals inside, rows outside, rows."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(blocks), size * size + 3))
        for pdf in batches:
            v = np.column_stack([np.ones(len(pdf)), pdf.iloc[:, 1:].to_numpy(dtype=float)])
            lower = pdf.iloc[:, 0].to_numpy()[:, None] < np.array(blocks)
            eta = v[:, :-1] @ beta.T
            if model == "gamma":
                weight = (lower & (v[:, -1:] > 0)).astype(float)
                target = eta + v[:, -1:] * np.exp(-np.clip(eta, -50, 50)) - 1
            else:
                e = np.abs(v[:, -1:] - eta)
                far = e > epsilon * scale
                weight = np.where(far, epsilon * scale / np.maximum(e, 1e-300), 1.0) * lower
                target = v[:, -1:]
                acc[:, -3] += (e**2 * ~far * lower).sum(axis=0)
                acc[:, -2] += (far & lower).sum(axis=0)
            acc[:, -1] += lower.sum(axis=0)
            x = v[:, :-1]
            sums = np.zeros((len(blocks), size, size))
            sums[:, :-1, :-1] = (weight.T @ (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)).reshape(len(blocks), size - 1, size - 1)
            sums[:, :-1, -1] = (weight * target).T @ x
            acc[:, :-3] += sums.reshape(len(blocks), -1)
        i, j = np.indices(acc.shape)
        yield pd.DataFrame({"block": i.ravel(), "at": j.ravel(), "v": acc.ravel()})

    parts = rows.mapInPandas(fold, "block int, at int, v double").groupBy("block", "at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((len(blocks), size * size + 3))
    out[parts["block"], parts["at"]] = parts["v"]
    return out


def time_series_model_scores(df: DataFrame, xs: Sequence[str], y: str, fold: str, **fit) -> DataFrame:
    """Mean absolute error per model and test block, each predicted from all lower blocks. Gamma models are judged on positive targets."""
    df = settle(df)
    fits = time_series_fits(df, xs, y, fold, **fit).withColumnRenamed(fold, "_of")
    rows = df.na.drop("any", subset=[*xs, y]).join(F.broadcast(fits), c(fold) == c("_of"))  # a row per block and model
    line = linear_prediction(xs, c("_coefs"))
    rows = rows.withColumn("_e", F.abs(c(y) - F.when(c("model") == "gamma", F.exp(line)).otherwise(line)))
    rows = rows.filter((c("model") != "gamma") | (c(y) > 0))
    return rows.groupBy("model", fold).agg(F.count(F.lit(1)).alias("n"), F.avg("_e").alias("mae"))


def predict_linear(df: DataFrame, xs: Sequence[str], coefs: Sequence[float], name: str) -> DataFrame:
    return df.withColumn(name, linear_prediction(xs, F.array(*[F.lit(float(v)) for v in coefs])))


# --- Spark ML estimators -----------------------------------------------------------------------------
def _assembled(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    rows = settle(df.na.drop("any", subset=[*xs, y]).withColumn(y, c(y).cast("double")))
    return VectorAssembler(inputCols=list(xs), outputCol="_x").transform(rows)


def gamma_regression(df: DataFrame, xs: Sequence[str], y: str, name: str = "gamma_pred") -> DataFrame:
    """Gamma regression with log link on positive targets."""
    rows = _assembled(df.filter(c(y) > 0), xs, y)
    est = GeneralizedLinearRegression(family="gamma", link="log", featuresCol="_x", labelCol=y, predictionCol=name)
    return est.fit(rows).transform(rows).drop("_x")


def huber_regression(df: DataFrame, xs: Sequence[str], y: str, epsilon: float = 1.15, alpha: float = 5.0, name: str = "huber_preds") -> DataFrame:
    rows = _assembled(df, xs, y)
    n = rows.count()
    est = LinearRegression(loss="huber", epsilon=epsilon, regParam=alpha / n, maxIter=50, featuresCol="_x",
                           labelCol=y, predictionCol=name)
    return est.fit(rows).transform(rows).drop("_x")


def elastic_net(df: DataFrame, xs: Sequence[str], y: str, alpha: float = 0.1, l1_ratio: float = 0.5, name: str = "en_preds") -> DataFrame:
    rows = _assembled(df, xs, y)
    est = LinearRegression(regParam=alpha, elasticNetParam=l1_ratio, featuresCol="_x", labelCol=y, predictionCol=name)
    return est.fit(rows).transform(rows).drop("_x")


def count_glm(df: DataFrame, xs: Sequence[str], y: str, name: str = "count_pred") -> tuple[float, DataFrame]:
    """Poisson regression with log link; returns the overdispersion (Pearson chi-square / df) and predictions."""
    rows = _assembled(df.filter(c(y) >= 0), xs, y)
    est = GeneralizedLinearRegression(family="poisson", link="log", featuresCol="_x", labelCol=y, predictionCol=name)
    model = est.fit(rows)
    out = model.transform(rows).drop("_x")
    pearson = F.sum(F.pow(c(y) - c(name), 2.0) / c(name))
    row = out.agg(pearson.alias("s"), F.count(F.lit(1)).alias("n")).first()
    return row["s"] / (row["n"] - len(xs) - 1), out


def boosted_trees(df: DataFrame, xs: Sequence[str], y: str, trees: int = 100, name: str = "boost_pred") -> DataFrame:
    """Boosted trees of depth 2 on the log of a positive target."""
    rows = _assembled(df.filter(c(y) > 0), xs, y).withColumn("_log", F.log(c(y)))
    est = GBTRegressor(maxDepth=2, maxIter=trees, seed=7, featuresCol="_x", labelCol="_log", predictionCol="_p")
    return est.fit(rows).transform(rows).withColumn(name, F.exp("_p")).drop("_x", "_log", "_p")


def boosted_gamma(
    df: DataFrame, xs: Sequence[str], y: str, train: Column, entity: str | None = None, order: Sequence[str] = (), *, rounds: int = 30,
    rate: float = 0.1, depth: int = 2, name: str = "boost_pred",
) -> tuple[list[tuple[float, float]], DataFrame]:
    """Boosted trees for positive targets by gamma deviance with a log link; fitted on ``train``, judged on all other rows too.

    Returns the mean deviance of training and held-out rows before the first and after every round, and the rows with ``_fitted``
    and predictions. ``entity`` enters as its target encoding, which held-out rows take from the training rows. A round fits a tree of
    Spark's to the Newton steps ``1 - mean / y``, weighted by ``y / mean``, so a leaf holds the best step for its rows. Rows
    with a null input or a target that isn't positive take no part.
    """
    rows = df.na.drop("any", subset=[*xs, y]).filter(c(y) > 0).withColumns({"_fitted": train, y: c(y).cast("double")}).filter(c("_fitted").isNotNull())
    terms = list(xs)
    if entity is not None:
        rows = target_encode(rows, entity, y, order, c("_fitted"))
        terms.append(f"{entity}_encoded")
    rows = settle(VectorAssembler(inputCols=terms, outputCol="_x").transform(rows))
    start = rows.filter("_fitted").agg(F.avg(y)).first()[0]
    if start is None:
        return [], rows.drop("_x").withColumn(name, F.lit(None).cast("double"))
    rows = rows.withColumn("_f", F.lit(math.log(start)))
    tree = DecisionTreeRegressor(maxDepth=depth, featuresCol="_x", labelCol="_step", weightCol="_weight", predictionCol="_leaf", seed=7)
    ratio = c(y) * F.exp(-c("_f"))
    deviance = 2 * (ratio - 1 - F.log(ratio))
    losses: list[tuple[float, float]] = []
    for i in range(rounds + 1):
        r = rows.agg(F.avg(F.when(c("_fitted"), deviance)).alias("a"), F.avg(F.when(~c("_fitted"), deviance)).alias("b")).first()
        losses.append((r["a"], r["b"]))
        if i == rounds:
            break
        model = tree.fit(rows.filter("_fitted").withColumns({"_step": 1 - 1 / ratio, "_weight": ratio}))
        rows = model.transform(rows).withColumn("_f", c("_f") + c("_leaf") * rate).drop("_leaf")
        if i % 6 == 5:
            rows = settle(rows)  # trees of some rounds, then their sum
    return losses, rows.withColumn(name, F.exp("_f")).drop("_x", "_f")


# --- counts ------------------------------------------------------------------------------------------
def _digamma(x: Column, derivative: bool = False) -> Column:
    """Digamma function of a positive column, or its derivative, right to 1e-12: eight steps up, then the asymptotic series."""
    low, high = F.lit(0.0), x + 8.0
    for k in range(8):
        low = low + F.pow(x + float(k), -2.0 if derivative else -1.0)
    t = F.lit(1.0) / (high * high)
    if derivative:
        series = t / 2 + (1 + t * (1 / 6 - t * (1 / 30 - t * (1 / 42 - t * (1 / 30 - t * 5 / 66))))) / high
        return series + low
    return F.log(high) - 0.5 / high - t * (1 / 12 - t * (1 / 120 - t * (1 / 252 - t * (1 / 240 - t / 132)))) - low


def negative_binomial(
    df: DataFrame, xs: Sequence[str], y: str, entity: str, order: Sequence[str], name: str = "count_pred", steps: int = 100, tolerance: float = 1e-10
) -> tuple[dict[str, float], DataFrame]:
    """Counts with a log link and variance m + m * m / size, with an effect of the entity; returns the coefficients and the size, and the
    rows with predictions.

    The entity enters as its ordered target encoding (``target_encode``: earlier rows only, in ``order``), as column
    ``<entity>_encoded``. Scoring for the coefficients and Newton steps for the logarithm of the size, both from one aggregate of the
    rows a step. Rows with a null input or a negative count take no part. Counts that vary no more than their mean end at
    a size of 1e7, the Poisson limit.
    """
    rows = target_encode(df.filter((c(y) >= 0) & c(entity).isNotNull()).na.drop("any", subset=[*xs, y]), entity, y, order)
    rows = settle(rows)
    terms = [*xs, f"{entity}_encoded"]
    first = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("_m"), F.var_pop(y).alias("_v"),
        *[f(c(x).cast("double")).alias(f"{label}_{x}") for x in terms for f, label in ((F.avg, "m"), (F.stddev_pop, "s"))],
    ).first()
    if not first["n"] or not first["_m"]:
        return {}, rows.withColumn(name, F.lit(0.0) if first["n"] else F.lit(None).cast("double"))
    centre = [first[f"m_{x}"] for x in terms]
    spread = [first[f"s_{x}"] or 1.0 for x in terms]
    z = [F.lit(1.0), *[(c(x).cast("double") - m) / s for x, m, s in zip(terms, centre, spread, strict=True)]]
    beta = np.array([math.log(first["_m"]), *[0.0] * len(terms)])
    size = min(1e7, first["_m"] ** 2 / max(first["_v"] - first["_m"], 1e-7 * first["_m"]))
    count, p = c(y).cast("double"), len(z)
    for _ in range(steps):
        eta = sum((F.lit(float(b)) * v for b, v in zip(beta, z, strict=True)), F.lit(0.0))
        own = rows.select(*[v.alias(f"z{i}") for i, v in enumerate(z)], count.alias("y"), F.exp(eta).alias("mean"))
        share = F.lit(size) / (F.lit(size) + c("mean"))
        sums = [F.sum(c(f"z{i}") * (c("y") - c("mean")) * share).alias(f"g{i}") for i in range(p)]
        sums += [F.sum(c(f"z{i}") * c(f"z{j}") * c("mean") * share).alias(f"h{i}_{j}") for i in range(p) for j in range(i, p)]
        past = F.lit(size) + c("y")
        slope = _digamma(past) - _digamma(F.lit(size)) + F.log(share) + 1 - past / (F.lit(size) + c("mean"))
        bend = _digamma(past, True) - _digamma(F.lit(size), True) + 1 / size - 2 / (F.lit(size) + c("mean")) + past / F.pow(F.lit(size) + c("mean"), 2.0)
        r = own.agg(*sums, F.sum(slope).alias("slope"), F.sum(bend).alias("bend")).first()
        h = np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
        step = np.linalg.lstsq(h, np.array([r[f"g{i}"] for i in range(p)]), rcond=None)[0]
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-300))
        g, curve = size * r["slope"], size * r["slope"] + size * size * r["bend"]
        move = -g / curve if curve < 0 else math.copysign(0.5, g)
        move = max(-1.0, min(1.0, move))
        beta, before, size = beta + step, size, min(1e7, size * math.exp(move))
        if np.abs(step).max() < tolerance and abs(math.log(size / before)) < tolerance * 100:
            break
    else:
        warnings.warn(f"the count model still moves after {steps} steps", stacklevel=2)
    plain = beta[1:] / np.array(spread)
    fixed = {"intercept": float(beta[0] - plain @ np.array(centre)), **dict(zip(terms, map(float, plain), strict=True)), "size": float(size)}
    eta = sum((F.lit(float(b)) * v for b, v in zip(beta, z, strict=True)), F.lit(0.0))
    return fixed, rows.withColumn(name, F.exp(eta))


# --- distribution distance ---------------------------------------------------------------------------
def gamma_cdf(shape: float, x: Column, most: float = 200.0) -> Column:
    """Distribution function of the gamma distribution with scale 1, by its power series, whose terms are all positive: right to
    1e-12 up to ``most``, beyond which there is too little left to count (``most`` is raised for large shapes)."""
    most = max(most, shape + 12 * math.sqrt(shape) + 40)
    inside = F.least(F.greatest(x, F.lit(1e-300)), F.lit(float(most)))
    first = F.exp(F.lit(shape) * F.log(inside) - inside - math.lgamma(shape + 1))
    terms = math.ceil(most + 10 * math.sqrt(most) + 60)
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(s: Column, k: Column) -> Column:
        term = s["term"] * inside / (k + shape)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), state, add, lambda s: s["sum"])
    return F.when(x <= 0, 0.0).otherwise(F.least(first * total, F.lit(1.0)))


def exact_normal_cdf(z: Column) -> Column:
    """Distribution function of the standard normal, by that of the gamma distribution with shape one half."""
    half = gamma_cdf(0.5, z * z / 2) / 2
    return F.when(z < 0, 0.5 - half).otherwise(0.5 + half)


def kolmogorov_p(distance: Column, n: Column) -> Column:
    """Chance of a larger Kolmogorov-Smirnov distance: the limit distribution with Stephens' correction for the size."""
    root = F.sqrt(n.cast("double"))
    scaled = (root + 0.12 + 0.11 / root) * distance
    total = F.lit(0.0)
    for k in range(1, 41):
        total = total + F.exp(scaled * scaled * (-2.0 * k * k)) * (2.0 if k % 2 else -2.0)
    return F.when(scaled < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(total, F.lit(1.0))))


def ks_distance(df: DataFrame, col: str, *, floor: int | None = None) -> DataFrame:
    """Kolmogorov-Smirnov distance to a normal and to a gamma distribution fitted by moments, and its p-value.

    The empirical distribution comes from counts by value; the fitted ones are column expressions.
    """
    rows = df.filter(c(col).isNotNull()).select(c(col).cast("double").alias("x"))
    m = rows.agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var")).first()
    n, mean, var = m["n"], m["mean"], m["var"]
    counted = settle(rows.groupBy("x").agg(F.count(F.lit(1)).alias("_n")))
    counted = add_features(counted, [], ["x"], {"_upto": cumulative_sum("_n")}, floor=floor)
    fitted = {"normal": exact_normal_cdf((c("x") - mean) / math.sqrt(var)), "gamma": gamma_cdf(mean * mean / var, c("x") * (mean / var))}
    aggs = []
    for d, f in fitted.items():
        gap = F.greatest(c("_upto") / F.lit(n) - f, f - (c("_upto") - c("_n")) / F.lit(n))
        aggs.append(F.max(gap).alias(f"{d}_distance"))
    out = counted.agg(F.sum("_n").alias("n"), *aggs)
    return out.withColumns({f"{d}_p": kolmogorov_p(c(f"{d}_distance"), c("n")) for d in fitted})


# --- smoothing ---------------------------------------------------------------------------------------
@dataclass(frozen=True)
class LocalLine:
    """Local linear smooth: a weighted line through the rows up to ``half`` away, read off at the row.

    Tricube weights by distance in rows; rows beyond the ends and null values have no weight.
    """

    col: str
    half: int

    @property
    def reach(self) -> tuple[int, int]:
        return self.half, self.half

    def column(self, w: WindowSpec, base: Column) -> Column:
        sums = [F.lit(0.0)] * 5
        for d in range(-self.half, self.half + 1):
            v = (F.lag(self.col, -d) if d < 0 else F.lead(self.col, d)).over(w).cast("double")
            weight = (1 - (abs(d) / (self.half + 1)) ** 3) ** 3
            known = F.when(v.isNotNull(), F.lit(weight)).otherwise(0.0)
            v = F.coalesce(v, F.lit(0.0))
            for i, term in enumerate((known, known * d, known * (d * d), known * v, known * v * d)):
                sums[i] = sums[i] + term
        n, x, xx, y, xy = sums
        spread = n * xx - x * x
        return F.when(spread > 1e-9, F.try_divide(y * xx - x * xy, spread)).otherwise(F.try_divide(y, n))


def local_smooth(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, half: int = 6, name: str = "smooth", **size
) -> DataFrame:
    """Smooth each series over its rows by local lines of bounded width, whatever the length of a series."""
    return add_features(df.filter(c(col).isNotNull()), keys, order, {name: LocalLine(col, half)}, **size)


_TRICUBE = ((0, 1.0), (3, -3.0), (6, 3.0), (9, -1.0))  # (1 - d^3)^3 by powers of d


def _local_lines(y: np.ndarray, weight: np.ndarray, near: int) -> np.ndarray:
    """At every place of a series, the line through its ``near`` nearest places, weighted by tricube distance and ``weight``.

    The tricube is a polynomial of the distance, so its sums over any window come from running sums of powers of the place. Powers
    are taken from the middle of blocks half as long as a window, which keeps them near 1.
    """
    n = len(y)
    out = np.empty(n)
    step = max(1, near // 2)
    for first in range(0, n, step):
        at = np.arange(first, min(first + step, n))
        left = np.clip(np.ceil(at - near / 2).astype(np.int64), 0, n - near)
        low, high = int(left[0]), int(left[-1]) + near
        reach = np.maximum(at - left, left + near - 1 - at) / near  # the farthest place of a window has no weight
        u = (np.arange(low, high) - (at[0] + at[-1]) / 2) / near
        here = u[at - low]
        moments = []
        for v, most in ((weight[low:high], 2), (weight[low:high] * y[low:high], 1)):
            powers = np.array([v * u**p for p in range(9 + most + 1)])
            sums = np.concatenate((np.zeros((len(powers), 1)), np.cumsum(powers, axis=1)), axis=1)
            total = np.zeros((most + 1, len(at)))
            for a, b, sign in ((left - low, at - low, -1.0), (at - low, left - low + near, 1.0)):
                part = sums[:, b] - sums[:, a]
                apart = []  # sums of (distance / reach) ** q
                for q in range(9 + most + 1):
                    moved = sum(math.comb(q, p) * (-here) ** (q - p) * part[p] for p in range(q + 1))
                    apart.append((sign / reach) ** q * moved)
                for m in range(most + 1):
                    total[m] += sign**m * sum(k * apart[q + m] for q, k in _TRICUBE)
            moments.append(total)
        (n0, x, xx), (sy, xy) = moments
        size = n0 * xx - x * x
        slanted = size > 1e-9 * np.maximum(n0, 1e-300) ** 2
        flat = np.where(n0 > 1e-12, sy / np.where(n0 > 1e-12, n0, 1), y[at])
        out[at] = np.where(slanted, (sy * xx - x * xy) / np.where(slanted, size, 1), flat)
    return out


_SHORT = 256  # places of a series whose windows are laid out whole


@lru_cache(maxsize=64)
def _windows(n: int, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``near`` nearest places of every place of a series, their distance in windows, and its tricube weight."""
    at = np.arange(n)
    left = np.clip(np.ceil(at - near / 2).astype(np.int64), 0, n - near)
    places = left[:, None] + np.arange(near)
    apart = (places - at[:, None]) / near
    reach = np.maximum(at - left, left + near - 1 - at) / near
    return places, apart, (1 - np.minimum(np.abs(apart) / reach[:, None], 1) ** 3) ** 3


def _short_local_lines(y: np.ndarray, weight: np.ndarray, near: int) -> np.ndarray:
    """``_local_lines`` of a short series: its windows depend on its length alone and are kept for the next one."""
    places, apart, tricube = _windows(len(y), near)
    w = tricube * weight[places]
    wd, near_y = w * apart, y[places]
    n0, x, xx = w.sum(axis=1), wd.sum(axis=1), (wd * apart).sum(axis=1)
    sy, xy = (w * near_y).sum(axis=1), (wd * near_y).sum(axis=1)
    size = n0 * xx - x * x
    slanted = size > 1e-9 * np.maximum(n0, 1e-300) ** 2
    flat = np.where(n0 > 1e-12, sy / np.where(n0 > 1e-12, n0, 1), y)
    return np.where(slanted, (sy * xx - x * xy) / np.where(slanted, size, 1), flat)


def smoothed(y: np.ndarray, share: float, robust: int) -> np.ndarray:
    """LOWESS of a series of evenly spaced values."""
    n = len(y)
    near = min(n, max(2, int(share * n + 1e-10)))
    if n < 3:
        return y.astype(float)
    weight = np.ones(n)
    lines = _short_local_lines if n <= _SHORT else _local_lines
    for i in range(robust + 1):
        fit = lines(y, weight, near)
        if i < robust:
            off = np.abs(y - fit)
            scale = 6 * np.median(off)
            off = off / scale if scale > 1e-12 * max(1.0, np.abs(y).max()) else (off > 1e-9 * max(1.0, np.abs(y).max())).astype(float)
            off = np.where(off > 0.999, 1.0, np.where(off <= 0.001, 0.0, off))
            weight = (1 - off**2) ** 2
    return fit


def lowess(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, share: float = 0.7, robust: int = 3, name: str = "smooth"
) -> DataFrame:
    """Smooth each series by local lines over a share of it, with ``robust`` further passes that give outliers less weight.

    The neighbours of a place are the ``share`` of the series nearest to it in rows; weights are tricube by distance and bisquare
    by the residual over six times their exact median. Rows without a value are left out, a series of one or two rows
    stays as it is. The work is linear in the length of a series, which a task holds as two numbers a row and its columns.
    """
    rows = df.filter(c(col).isNotNull())
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(o, "ascending") for o in order])
        return table.append_column(name, pa.array(smoothed(table[col].cast(pa.float64()).to_numpy(), share, robust)))

    return rows.groupBy(*keys).applyInArrow(run, schema)
