"""Team ratings and shrinkage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.operators.aggregates import with_group
from yardline.session import settle


def c(name: str) -> Column:
    return F.col(name)


def simple_ratings(games: DataFrame, passes: int = 12, settle_every: int = 4) -> DataFrame:
    """Simple rating system per season: average margin plus the opponents' adjusted margins, iterated.

    ``games``: season, team_a, team_b, team_a_score, team_b_score (two rows per game). All teams move at
    once in a pass. Every pass is an average over opponents, which carries a common shift through
    unchanged, so ratings are centred once at the end. Games of a pair are folded into one weighted edge
    before the passes; lineage is cut by a written table every few passes.
    """
    pairs = games.groupBy("season", c("team_a").alias("team"), c("team_b").alias("opp")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("team_a_score").alias("pf"), F.sum("team_b_score").alias("pa")
    )
    pairs = settle(pairs)
    teams = pairs.groupBy("season", "team").agg(
        F.sum("n").alias("games"),
        (F.sum("pf") / F.sum("n")).alias("pts_for"),
        (F.sum("pa") / F.sum("n")).alias("pts_against"),
    ).withColumn("init_mov", c("pts_for") - c("pts_against"))
    teams = settle(teams)
    edges = pairs.select("season", "team", "opp", "n")
    base = teams.select("season", c("team").alias("opp"), c("init_mov").alias("_mov"))
    adj = base.select("season", "opp", F.lit(0.0).alias("adj"))
    for i in range(1, passes + 1):
        strength = base.join(adj, ["season", "opp"]).select("season", "opp", (c("_mov") + c("adj")).alias("_s"))
        adj = (
            edges.join(strength, ["season", "opp"])
            .groupBy("season", c("team").alias("opp"))
            .agg((F.sum(c("_s") * c("n")) / F.sum("n")).alias("adj"))
        )
        if i % settle_every == 0 and i < passes:
            adj = settle(adj)
    out = teams.join(adj.withColumnRenamed("opp", "team"), ["season", "team"])
    out = with_group(out, ["season"], {"_mean": F.avg("adj")}).withColumn("adj", c("adj") - c("_mean"))
    return out.withColumn("final_srs", c("init_mov") + c("adj")).drop("_mean")


def james_stein(df: DataFrame, col: str, sigma_sq: float | Column, by: Sequence[str] = (), name: str = "js") -> DataFrame:
    """Shrink estimates toward 0 by 1 - (k - 2) sigma^2 / sum of squares; ``sigma_sq`` is a variance, given
    as a number or as an aggregate of the group."""
    var = sigma_sq if isinstance(sigma_sq, Column) else F.max(F.lit(float(sigma_sq)))
    stats = {"_k": F.count(col), "_ss": F.sum(c(col) * c(col)), "_var": var}
    factor = 1 - (c("_k") - 2) * c("_var") / c("_ss")
    return with_group(df, list(by), stats).withColumn(name, factor * c(col)).drop(*stats)


def partial_pool(df: DataFrame, key: str, col: str) -> DataFrame:
    """Group means pulled toward the grand mean of groups by their reliability (method of moments)."""
    groups = df.groupBy(key).agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.var_samp(col).alias("var"))
    within = F.sum(c("var") * (c("n") - 1)) / F.sum(F.when(c("var").isNotNull(), c("n") - 1))
    stats = {
        "_grand": F.avg("mean"),
        "_within": within,
        "_between": F.greatest(F.var_samp("mean") - within * F.avg(1 / c("n").cast("double")), F.lit(0.0)),
    }
    weight = F.try_divide(c("_between"), c("_between") + c("_within") / c("n"))
    rows = with_group(groups, [], stats).withColumn("weight", weight)
    shrunk = c("_grand") + c("weight") * (c("mean") - c("_grand"))
    return rows.select(key, "n", "mean", "weight", shrunk.alias("pooled_mean"))


def posterior_edges(estimates: DataFrame, first_season: int, label: str = "label", value: str = "mean") -> DataFrame:
    """Labels ``1|season/term[season:team]`` split into their parts; offence beside defence per season and team."""
    part = lambda pattern: F.regexp_extract(label, pattern, 1)
    rows = estimates.select(
        part(r"/(\w+)\[").alias("term"), part(r"\[(\d+):").cast("int").alias("season"), part(r":(.+)\]").alias("team"), c(value).alias("v")
    ).filter(c("season") >= first_season)
    sides = {"off_mean": "team_a", "def_mean": "team_b"}
    out = rows.groupBy("season", "team").agg(*[F.max(F.when(c("term") == t, c("v"))).alias(n) for n, t in sides.items()])
    return out.withColumn("total_edge", c("off_mean") - c("def_mean"))


def random_intercept(
    df: DataFrame, key: str, y: str, xs: Sequence[str], tolerance: float = 1e-9
) -> tuple[dict[str, float], DataFrame]:
    """Linear model with a random intercept per group, by maximum likelihood.

    Given the ratio of the two variances, everything else follows from sums of products in which a group only counts
    by its size, so rows are reduced to one row per distinct group size. The likelihood is searched over the ratio:
    each round is one aggregate of that table for a grid of ratios, around the best one so far. Returns the fixed
    effects and variances, and the group table with its intercepts.
    """
    names = ["_one", *xs]
    p = len(names)
    rows = df.select(key, c(y).cast("double").alias("_y"), F.lit(1.0).alias("_one"),
                     *[c(x).cast("double").alias(x) for x in xs]).na.drop()
    every = [*names, "_y"]
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    groups = settle(
        rows.groupBy(key).agg(
            *[F.sum(a).alias(f"_s{i}") for i, a in enumerate(every)],
            *[F.sum(c(every[i]) * c(every[j])).alias(f"_m{i}_{j}") for i, j in pairs],
        )
    )
    by_size = settle(
        groups.groupBy(c("_s0").alias("n")).agg(
            F.count(F.lit(1)).alias("k"), *[F.sum(c(f"_s{i}") * c(f"_s{j}")).alias(f"b{i}_{j}") for i, j in pairs]
        )
    )
    row = groups.agg(*[F.sum(f"_m{i}_{j}").alias(f"b{i}_{j}") for i, j in pairs]).first()
    whole = _symmetric([row[f"b{i}_{j}"] or 0.0 for i, j in pairs], p + 1)
    total = whole[0, 0]

    def fit(ratio: float, shrunk: np.ndarray, logs: float) -> tuple[float, np.ndarray, float, float]:
        gls = whole - shrunk
        beta = np.linalg.lstsq(gls[:p, :p], gls[:p, p], rcond=None)[0]
        e = np.append(-beta, 1.0)  # residual as a combination of (1, x, y)
        sigma = max(float(e @ gls @ e) / total, 1e-12)
        return total * np.log(sigma) + logs, beta, sigma, ratio * sigma

    low, high, best = -14.0, 10.0, None
    while best is None or high - low > tolerance * 24 * 16:
        ratios = np.exp(np.linspace(low, high, 17))
        sums = _shrunk_sums(by_size, ratios, pairs)
        fits = [fit(r, _symmetric(s[:-1], p + 1), s[-1]) for r, s in zip(ratios, sums, strict=True)]
        at = min(range(len(fits)), key=lambda i: fits[i][0])
        best, step = fits[at], (high - low) / 16
        middle = float(np.log(ratios[at]))
        low, high = middle - step, middle + step
    _, beta, sigma, tau = best
    resid = c(f"_s{p}") - sum((F.lit(float(beta[i])) * c(f"_s{i}") for i in range(p)), F.lit(0.0))
    shrunk = F.lit(float(tau)) / (F.lit(float(sigma)) + c("_s0") * F.lit(float(tau))) * resid
    fixed = {"intercept": float(beta[0])} | {x: float(v) for x, v in zip(xs, beta[1:], strict=True)}
    effects = groups.select(key, c("_s0").cast("long").alias("n"), shrunk.alias("intercept"))
    return fixed | {"sigma_sq": float(sigma), "tau_sq": float(tau)}, effects


def _symmetric(values: Sequence[float], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = values
    return out + np.triu(out, 1).T


def _shrunk_sums(by_size: DataFrame, ratios: np.ndarray, pairs: Sequence[tuple[int, int]]) -> np.ndarray:
    """For each ratio of variances the shrunk sums between groups, and the log determinant."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(ratios), len(pairs) + 1))
        for pdf in batches:
            n = pdf["n"].to_numpy(dtype=float)
            spread = 1 + np.outer(ratios, n)
            acc[:, :-1] += (ratios[:, None] / spread) @ pdf[[f"b{i}_{j}" for i, j in pairs]].to_numpy(dtype=float)
            acc[:, -1] += np.log(spread) @ pdf["k"].to_numpy(dtype=float)
        i, j = np.indices(acc.shape)
        yield pd.DataFrame({"r": i.ravel(), "at": j.ravel(), "v": acc.ravel()})

    parts = by_size.mapInPandas(fold, "r int, at int, v double").groupBy("r", "at").agg(F.sum("v").alias("v"))
    out = np.zeros((len(ratios), len(pairs) + 1))
    for row in parts.collect():  # one number per ratio and entry
        out[row["r"], row["at"]] = row["v"]
    return out
