"""Projections and cleaning over whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.functions.scalars import half_even
from yardline.operators.aggregates import overall_quantiles
from yardline.operators.skew import with_position


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_matching(df: DataFrame, *patterns: str) -> DataFrame:
    """Drop columns whose name contains one of the patterns."""
    return df.drop(*[c for c in df.columns if any(p in c for p in patterns)])


def mask(df: DataFrame, col: str, where: Column, value) -> DataFrame:
    """Set a column where a condition holds; unknown counts as not holding."""
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(where, value).otherwise(F.col(col)))


def fold(df: DataFrame, keep: Sequence[str], name: str = "_others") -> DataFrame:
    """Keep some columns; the others, an earlier result of this included, become one 64-bit hash.

    For rows that still get compared as wholes (``distinct``) and carried far, where nothing else reads the other columns. Null
    differs from every value; -0.0 is 0.0 and NaN is NaN, as in ``distinct``. Unequal rows are only taken for equal if
    the kept columns agree and the hashes collide.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in keep]
    values = [x for c in others for x in (c.isNull(), c)]  # a null alone would leave no trace
    return df.select(*[f"`{c}`" for c in df.columns if c in keep], *([F.xxhash64(*values).alias(name)] if others else []))


def fill_from(df: DataFrame, col: str, other: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.col(other)))


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def fill_median(df: DataFrame, cols: Sequence[str], *, floor: int | None = None) -> DataFrame:
    """Fill nulls with the column's overall median."""
    medians = overall_quantiles(df, {f"_{n}": (n, 0.5) for n in cols}, floor=floor)
    return df.withColumns({n: F.coalesce(F.col(n), medians[f"_{n}"]) for n in cols})


def fill_ramp(
    df: DataFrame, col: str, order: Sequence[str], start: float, stop: float, steps: int, *, floor: int | None = None
) -> DataFrame:
    """Fill the k-th null, in order, with the k-th of ``steps`` evenly spaced values; later nulls stay null."""
    nulls = with_position(df.filter(F.col(col).isNull()), [], order, "_k", floor=floor)
    step = (stop - start) / (steps - 1)
    ramp = F.when(F.col("_k") <= steps, F.lit(start) + F.lit(step) * (F.col("_k") - 1).cast("double"))
    filled = nulls.withColumn(col, ramp).drop("_k")
    return df.filter(F.col(col).isNotNull()).unionByName(filled)


def round_all(df: DataFrame, places: int) -> DataFrame:
    """Half-even rounding of all float columns. Float noise goes first, so exact ties round alike whatever order
    sums were taken in."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            half_even(F.round(F.col(c).cast("double"), 9), places).alias(c) if isinstance(t, T.DoubleType | T.FloatType) else F.col(c)
            for c, t in kinds.items()
        ]
    )
