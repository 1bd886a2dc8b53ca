"""Evaluation of predictions and of predictive distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.functions.scalars import flag, interval_residual, normal_cdf
from yardline.operators.aggregates import quantiles
from yardline.operators.windows import add_features, cumulative_sum
from yardline.session import settle


def c(name: str) -> Column:
    return F.col(name)


def quantile_bins(df: DataFrame, col: str, bins: int, name: str = "bin", *, floor: int | None = None) -> DataFrame:
    """Right-closed quantile bin from 1: one more than the number of inner edges below the value."""
    edges = {f"e{i}": i / bins for i in range(1, bins)}
    table = quantiles(df, [], col, edges, floor=floor)
    inner = table.select(F.array(*edges).alias("e")).scalar()
    df = df.withColumn("_edges", inner)
    return df.withColumn(name, 1 + F.size(F.filter("_edges", lambda e: e < c(col)))).drop("_edges")


def error_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    e = c(actual).cast("double") - c(predicted).cast("double")
    return df.groupBy(*by).agg(
        F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.avg(e).alias("mean_residual")
    )


def t_statistic(df: DataFrame, col: str, mu: float = 0.0) -> DataFrame:
    """One-sample t statistic, degrees of freedom and two-sided p-value (by the normal variate that corresponds to t,
    right to three places from a few degrees of freedom on)."""
    out = df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("_s"))
    t = F.try_divide(c("mean") - F.lit(mu), c("_s") / F.sqrt(c("n").cast("double")))
    out = out.select("n", "mean", t.alias("t"), (c("n") - 1).alias("df"))
    z = (8 * c("df") + 1) / (8 * c("df") + 3) * F.sqrt(c("df") * F.log1p(c("t") * c("t") / c("df")))
    return out.withColumn("p", 2 * normal_cdf(-z))


def coverage_by_bin(df: DataFrame, actual: str, low: str, high: str, by: str, bins: int = 10, **size) -> DataFrame:
    """Coverage and mean width of an interval per quantile bin of a prediction."""
    rows = quantile_bins(df, by, bins, **size)
    inside = flag(c(actual).between(c(low), c(high)))
    return rows.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(inside).alias("coverage"), F.avg(c(high) - c(low)).alias("width")
    )


def conformal_adjustment(
    df: DataFrame, actual: str, low: str, high: str, level: float = 0.9, *, floor: int | None = None
) -> DataFrame:
    """The ceil(level (n + 1))-th smallest interval residual, as one row; null when n is too small.

    Residuals are counted by value before they are ordered, so the many zeros are one row.
    """
    rows = df.select(interval_residual(c(low), c(high), c(actual)).alias("_r")).filter(c("_r").isNotNull())
    counted = settle(rows.groupBy("_r").agg(F.count(F.lit(1)).alias("_n")))
    n = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    counted = add_features(counted, [], ["_r"], {"_upto": cumulative_sum("_n")}, floor=floor)
    k = F.ceil(F.lit(level) * (n + 1))
    return counted.withColumn("_k", k).agg(F.min(F.when(c("_upto") >= c("_k"), c("_r"))).alias("adjustment"))


def conformal_interval(
    df: DataFrame, actual: str, low: str, high: str, level: float = 0.9, *, floor: int | None = None
) -> DataFrame:
    """Interval widened on both sides so that it covers ``level`` of the given rows."""
    adj = conformal_adjustment(df, actual, low, high, level, floor=floor).scalar()
    rows = df.withColumn("_a", adj)
    rows = rows.withColumns({"conformed_low": c(low) - c("_a"), "conformed_high": c(high) + c("_a")}).drop("_a")
    inside = flag(c(actual).between(c("conformed_low"), c("conformed_high")))
    return rows.withColumn("inside_conformed", inside)


SUMMARY = {"median": 0.5, "q10": 0.1, "q80": 0.8, "q90": 0.9, "q95": 0.95}


def simulation_summary(
    draws: DataFrame, actuals: DataFrame, probs: Mapping[str, float] = SUMMARY, *, floor: int | None = None
) -> DataFrame:
    """Mean and quantiles of each row's draws, and how the actual value compares."""
    rows = quantiles(draws, ["row_id"], "value", probs, floor=floor, mean="mean")
    rows = rows.join(actuals.select("row_id", "actual"), ["row_id"])
    flags = {f"over_{n}": flag(c("actual") > c(n)) for n in probs if n != "q10"}
    return rows.withColumns(flags | {"under_q10": flag(c("actual") < c("q10"))})


def summary_rates(summary: DataFrame) -> DataFrame:
    """Share of rows with each exceedance flag."""
    flags = [n for n in summary.columns if n.startswith(("over_", "under_"))]
    return summary.agg(F.count(F.lit(1)).alias("n"), *[F.avg(n).alias(n) for n in flags])


def calibration_curve(
    draws: DataFrame, actuals: DataFrame, levels: int = 75, start: float = 0.1, stop: float = 1.0,
    *, floor: int | None = None,
) -> DataFrame:
    """Share of actual values at or below each predicted quantile."""
    probs = {f"p{i}": min(1.0, start + (stop - start) * i / (levels - 1)) for i in range(levels)}
    rows = quantiles(draws, ["row_id"], "value", probs, floor=floor)
    rows = rows.select("row_id", F.array(*probs).alias("q")).join(actuals.select("row_id", "actual"), ["row_id"])
    shares = [F.avg(flag(c("actual") <= c("q")[i])) for i in range(levels)]
    points = [F.struct(F.lit(i).alias("i"), F.lit(p).alias("level"), s.alias("share")) for i, (p, s) in enumerate(zip(probs.values(), shares, strict=True))]
    return rows.agg(F.array(*points).alias("_p")).select(F.inline("_p"))
