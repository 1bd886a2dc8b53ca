"""Declared schemas, and checks on columns and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STADIUMS = "stadium STRING, state STRING, lat DOUBLE, long DOUBLE"
MONEYLINES = "seq LONG, date INT, team STRING, ml INT"
PLAYER_STATS = (
    "season INT, week INT, season_type STRING, position STRING, player_id STRING, player_name STRING, "
    "recent_team STRING, attempts INT, completions INT, interceptions INT, passing_yards DOUBLE, "
    "passing_epa DOUBLE, rushing_epa DOUBLE"
)


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice. The count is combined before the shuffle and one row is read back."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).head(1)
    if repeated:
        raise ValueError(f"keys {list(keys)} are not unique, e.g. {repeated[0].asDict()}")
