"""Aggregates that pandas-style data needs beyond Spark's own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.operators.skew import group_sizes, join_on
from yardline.operators.windows import add_features, cumulative_sum
from yardline.session import settle


def total(col: str | Column) -> Column:
    """Sum that is 0, not null, for a group without values."""
    return F.coalesce(F.sum(col), F.lit(0))


def total_where(cond: Column, col: str | Column) -> Column:
    """Sum over the rows of a group that meet a condition."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _at(order: Sequence[str]) -> Column:
    """Ordering value. One number keeps the aggregate in fixed-width buffers, so that Spark hashes; several
    columns make a struct, and Spark sorts."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def first_value(col: str, order: Sequence[str]) -> Column:
    """Value of the group's first row, null included."""
    return F.min_by(F.struct(F.col(col).alias("v")), _at(order))["v"]


def first_known(col: str, order: Sequence[str]) -> Column:
    """First non-null value in order."""
    return F.min_by(col, F.when(F.col(col).isNotNull(), _at(order)))


def last_known(col: str, order: Sequence[str]) -> Column:
    return F.max_by(col, F.when(F.col(col).isNotNull(), _at(order)))


def group_with_labels(
    df: DataFrame,
    keys: Mapping[str, str],
    labels: Mapping[str, str],
    at: Column,
    sums: Mapping[str, Column],
    maxes: Mapping[str, Column] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Sums and maxima per group, with text labels taken from the group's first row.

    Strings cannot sit in a hash aggregate's buffer, and sorting every play to carry a name along is the
    slow way. So the labels are grouped on in a first step, which hashes and leaves about one row per
    group, and the second step picks among those few. ``at``: a number ordering the rows; rows where it is
    null give no label. A sum without any value is null. ``within``: keys, of few groups each, by which the result is
    dealt out, so that windows over them need no further exchange.
    """
    fine = label_groups(df, keys, labels, at, sums, maxes)
    fine = fine.repartition(*within) if within else fine
    return pick_labels(fine, list(keys), list(labels), list(sums), list(maxes or {}))


def label_groups(
    df: DataFrame,
    keys: Mapping[str, str],
    labels: Mapping[str, str],
    at: Column,
    sums: Mapping[str, Column],
    maxes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """First step of ``group_with_labels``: a row per keys and labels (named ``_l_`` and the label)."""
    by = [F.col(v).alias(k) for k, v in {**keys, **{f"_l_{n}": v for n, v in labels.items()}}.items()]
    return df.groupBy(*by).agg(
        F.min(at).alias("_at"),
        *[F.sum(x).alias(n) for n, x in sums.items()],
        *[F.max(x).alias(n) for n, x in (maxes or {}).items()],
    )


def pick_labels(fine: DataFrame, keys: Sequence[str], labels: Sequence[str], sums: Sequence[str], maxes: Sequence[str] = ()) -> DataFrame:
    """Second step of ``group_with_labels``: a row per keys."""
    names = F.struct(*[F.col(f"_l_{n}").alias(n) for n in labels])
    first = F.min_by(names, F.when(F.col("_at").isNotNull(), F.struct("_at", names)))
    coarse = fine.groupBy(*keys).agg(
        first.alias("_first"),
        *[F.sum(n).alias(n) for n in sums],
        *[F.max(n).alias(n) for n in maxes],
    )
    return coarse.select(*keys, *[F.col("_first")[n].alias(n) for n in labels], *sums, *maxes)


def share(part: Column, whole: Column) -> Column:
    """Ratio; null where the denominator is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def with_group(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Add group aggregates to every row.

    A join with the aggregated table rather than a window: partial aggregation comes before the shuffle,
    and a very large group is never gathered in one task. Spark broadcasts the small side when its
    measured size allows.
    """
    if not keys:
        one = df.agg(*[c.alias(n) for n, c in aggs.items()])
        packed = one.select(F.struct(*aggs).alias("s"))
        out = df.withColumn("_all", packed.scalar())
        return out.select(*df.columns, *[F.col("_all")[n].alias(n) for n in aggs])
    small = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return join_on(df, small, keys, "left")


def keep_large_groups(df: DataFrame, keys: Sequence[str], at_least: int, counted: str | None = None) -> DataFrame:
    """Rows of groups with enough (non-null) rows."""
    n = F.count(F.lit(1) if counted is None else F.col(counted))
    big = df.groupBy(*keys).agg(n.alias("_n")).filter(F.col("_n") >= at_least).drop("_n")
    return df.join(big, list(keys), "left_semi")


def mean_interval(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Mean, population standard error and bounds two errors away."""
    x = F.col(col)
    out = df.groupBy(*keys).agg(
        F.avg(x).alias("mean"), (F.stddev_pop(x) / F.sqrt(F.count(x).cast("double"))).alias("se")
    )
    return out.withColumn("low", F.col("mean") - 2 * F.col("se")).withColumn("high", F.col("mean") + 2 * F.col("se"))


def mean_ci(df: DataFrame, keys: Sequence[str], col: str, z: float = 1.96) -> DataFrame:
    """Mean with a normal 95 % interval per category."""
    out = df.groupBy(*keys).agg(
        F.avg(col).alias("mean"),
        F.count(col).alias("n"),
        (F.stddev_samp(col) / F.sqrt(F.count(col).cast("double"))).alias("_se"),
    )
    half = F.lit(z) * F.col("_se")
    return out.select(*keys, "n", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def quantiles(
    df: DataFrame, keys: Sequence[str], col: str, probs: Mapping[str, float], *, floor: int | None = None,
    mean: str | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``; ``mean`` names one for the mean.

    ``percentile`` keeps the distinct values of a group in one task. Groups too large for that are counted
    by value first (combined before the shuffle), numbered by a running count, and the two order
    statistics around each quantile are picked out.
    """
    x = df.filter(F.col(col).isNotNull())
    sizes = group_sizes(x, keys, floor)
    if sizes.fits:
        arr = F.array(*[F.lit(float(p)) for p in probs.values()])
        out = x.groupBy(*keys).agg(F.percentile(col, arr).alias("_q"), F.avg(col).alias("_mean"))
        means = [] if mean is None else [F.col("_mean").alias(mean)]
        return out.select(*keys, *means, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])
    counted = settle(x.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n")))
    counted = add_features(counted, keys, [col], {"_upto": cumulative_sum("_n")}, floor=floor)
    placed = with_group(counted, keys, {"_total": F.sum("_n")})
    aggs = []
    for name, p in probs.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        for end, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            here = (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
            aggs.append(F.max(F.when(here, F.col(col).cast("double"))).alias(f"_{name}_{end}"))
    average = F.sum(F.col(col) * F.col("_n")) / F.sum("_n")
    picked = placed.groupBy(*keys).agg(F.max("_total").alias("_total"), average.alias("_mean"), *aggs)
    out = [] if mean is None else [F.col("_mean").alias(mean)]
    for name, p in probs.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (rank - F.floor(rank)) * (hi - lo)).alias(name))
    return picked.select(*keys, *out)


def overall_quantiles(
    df: DataFrame, wanted: Mapping[str, tuple[str, float]], *, floor: int | None = None
) -> dict[str, Column]:
    """Whole-table quantiles of several columns as scalar columns: name to (column, probability)."""
    if group_sizes(df, [], floor).fits:
        one = df.agg(*[F.percentile(col, F.lit(float(p))).alias(n) for n, (col, p) in wanted.items()])
        packed = one.select(F.struct(*wanted).alias("s")).scalar()
        return {n: packed[n] for n in wanted}
    # all columns as one long table, counted in one go; a number per name and probability reaches the driver
    probs = {f"q{i}": p for i, p in enumerate(dict.fromkeys(float(p) for _, p in wanted.values()))}
    cols = dict.fromkeys(col for col, _ in wanted.values())
    pairs = [F.struct(F.lit(n).alias("_of"), F.col(n).cast("double").alias("_x")) for n in cols]
    long = df.select(F.inline(F.array(*pairs)))
    found = {r["_of"]: r for r in quantiles(long, ["_of"], "_x", probs, floor=floor).collect()}
    named = {p: n for n, p in probs.items()}
    return {n: F.lit(found[col][named[float(p)]] if col in found else None).cast("double") for n, (col, p) in wanted.items()}


def average_rank(
    df: DataFrame, keys: Sequence[str], col: str, name: str, *, floor: int | None = None, grain: str | None = None
) -> DataFrame:
    """Descending rank where ties share their mean rank; null stays null.

    ``grain="player"``: the rows are players of a game, so groups are small by what they are and no size
    is measured. Otherwise groups too large for a task are counted by value and ranked by a running count.
    """
    x = F.col(col)
    if grain == "player" or group_sizes(df, keys, floor).fits:
        spec = Window.partitionBy(*keys).orderBy(x.desc_nulls_last())
        tied = Window.partitionBy(*keys, col)
        rank = F.rank().over(spec) + (F.count(F.lit(1)).over(tied) - 1) / 2
        return df.withColumn(name, F.when(x.isNotNull(), rank))
    counted = df.filter(x.isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    counted = add_features(counted, keys, [col], {"_upto": cumulative_sum("_n")}, descending=True, floor=floor)
    ranks = counted.select(*keys, col, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(name))
    return join_on(df, ranks, [*keys, col], "left")
