"""Equi-joins with the checks and collision rules of the source notebooks' merges.

No join here is hinted: Spark broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and splits skewed shuffle partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.functions.scalars import opponent
from yardline.sources.schemas import require_unique


def join_suffixed(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", suffix: str = "_merged"
) -> DataFrame:
    """Join on common keys; other columns of the right side that collide get a suffix."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c not in on}
    return left.join(right.withColumnsRenamed(clash), list(on), how)


def join_renamed(
    left: DataFrame, right: DataFrame, keys: dict[str, str], suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Inner join on differently named keys (left name to right name); both key columns stay."""
    lk, rk = list(keys), list(keys.values())
    shared = [c for c in left.columns if c in right.columns]
    same = [k for k, v in keys.items() if k == v]
    lmap = {c: c + suffixes[0] for c in shared if c not in lk}
    rmap = {c: c + suffixes[1] for c in shared if c not in rk}
    rmap |= {k: f"_right_{k}" for k in same}
    left, right = left.withColumnsRenamed(lmap), right.withColumnsRenamed(rmap)
    cond = F.lit(True)
    for a, b in keys.items():
        cond = cond & (F.col(a) == F.col(rmap.get(b, b)))
    return left.join(right, cond, "inner").drop(*[f"_right_{k}" for k in same])


def validated_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", validate: str = "many_to_one"
) -> DataFrame:
    """Join after checking that the keys are unique on the sides the cardinality asks for."""
    if validate not in ("one_to_one", "many_to_one", "one_to_many"):
        raise ValueError(f"unknown cardinality {validate}")
    if validate.startswith("one"):
        require_unique(left, on)
    if validate.endswith("one"):
        require_unique(right, on)
    return left.join(right, list(on), how)


def lookup(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], value: str, name: str | None = None, default=None
) -> DataFrame:
    """Value from a table with unique keys; missing keys give the default."""
    name = name or value
    out = df.join(dim.select(*keys, F.col(value).alias("_value")), list(keys), "left")
    found = F.col("_value") if default is None else F.coalesce(F.col("_value"), F.lit(default))
    return out.withColumn(name, found).drop("_value")


def priority_lookup(
    df: DataFrame, first: DataFrame, second: DataFrame, keys: Sequence[str], value: str, name: str, default
) -> DataFrame:
    """Value from ``first`` where it has the key, else from ``second``, else the default."""
    both = first.select(*keys, F.col(value).alias("_v"), F.lit(0).alias("_p")).unionByName(
        second.select(*keys, F.col(value).alias("_v"), F.lit(1).alias("_p"))
    )
    dim = both.groupBy(*keys).agg(F.min_by("_v", "_p").alias("_v"))
    return lookup(df, dim, keys, "_v", name, default)


def opponent_join(df: DataFrame, teams: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add columns of the opposing team's row of the same game."""
    df = df.withColumn("opp_team", opponent(F.col("team"), F.col("home_team"), F.col("away_team")))
    other = teams.select("game_id", F.col("team").alias("opp_team"), *cols)
    return df.join(other, ["game_id", "opp_team"], "left")


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the left side that the right side lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), [key], "left_anti")


