"""Appending, de-duplicating, splitting and folding rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.operators.skew import with_position


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in order. An aggregate, so a repeated key is folded before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def pair_rows(df: DataFrame, order: Sequence[str], name: str = "pair", *, floor: int | None = None) -> DataFrame:
    """Number consecutive rows two by two, from 0."""
    df = with_position(df, [], order, "_pos", floor=floor)
    return df.withColumn(name, F.floor((F.col("_pos") - 1) / 2).cast("long")).drop("_pos")


def chrono_split(
    df: DataFrame, order: Sequence[str], *, rows: int | None = None, fraction: float | None = None,
    floor: int | None = None,
) -> DataFrame:
    """Add ``part`` = train for the first rows in order (a count or a share of all rows), else test."""
    if (rows is None) == (fraction is None):
        raise ValueError("give either rows or fraction")
    df = with_position(df, [], order, "_pos", floor=floor)
    if rows is None:
        n = df.agg(F.count(F.lit(1))).scalar()
        last = F.floor(n * F.lit(fraction))
    else:
        last = F.lit(rows)
    return df.withColumn("part", F.when(F.col("_pos") <= last, "train").otherwise("test")).drop("_pos")


def hash_number(cols: Sequence[str], seed: int) -> Column:
    """A number below 2**32 from the ids as text: the same for a row in any engine that has MD5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_fold(cols: Sequence[str], folds: int, seed: int) -> Column:
    """Fold number from a hash of an id: the same row always gets the same fold."""
    return (hash_number(cols, seed) % folds).cast("int")


def random_split(df: DataFrame, ids: Sequence[str], train_share: float = 0.8, seed: int = 0) -> DataFrame:
    """Add ``part``: a reproducible random split by id."""
    bucket = hash_number(ids, seed) % 1000
    return df.withColumn("part", F.when(bucket < round(train_share * 1000), "train").otherwise("test"))


def time_folds(df: DataFrame, order: Sequence[str], splits: int, *, floor: int | None = None) -> DataFrame:
    """Add ``fold``: 0 for rows that are only ever trained on, 1..splits for the test blocks in time order.
    Block k is tested on a model trained on all rows of lower folds."""
    df = with_position(df, [], order, "_pos", floor=floor)
    n = df.agg(F.count(F.lit(1))).scalar()
    size = F.floor(n / (splits + 1))
    first = n - size * splits
    fold = F.when(F.col("_pos") <= first, 0).otherwise(F.floor((F.col("_pos") - first - 1) / size) + 1)
    return df.withColumn("fold", fold.cast("int")).drop("_pos")


def ordinal_codes(df: DataFrame, col: str, name: str, *, floor: int | None = None) -> DataFrame:
    """Code of each distinct value by sort order, from 0; join it back to encode or decode."""
    ids = df.select(col).filter(F.col(col).isNotNull()).distinct()
    ids = with_position(ids, [], [col], name, floor=floor)
    return ids.withColumn(name, F.col(name) - 1)


def home_away_rows(games: DataFrame) -> DataFrame:
    """One game row to two team rows in one pass; the spread is negated for the home side."""

    def side(a: str, b: str, home: int) -> Column:
        sign = -1 if home else 1
        return F.struct(
            F.col(f"{a}_team").alias("team_a"),
            F.col(f"{b}_team").alias("team_b"),
            F.lit(home).alias("team_a_home"),
            F.col(f"{a}_score").alias("team_a_score"),
            F.col(f"{b}_score").alias("team_b_score"),
            F.col(f"{a}_coach").alias("team_a_coach"),
            F.col(f"{b}_coach").alias("team_b_coach"),
            F.col(f"{a}_rest").alias("team_a_rest"),
            F.col(f"{b}_rest").alias("team_b_rest"),
            (F.col("spread_line") * sign).alias("spread_line"),
        )

    keep = ["game_id", "season", "total_line", "referee", "stadium"]
    rows = games.select(
        *keep,
        F.split_part("game_id", F.lit("_"), F.lit(2)).cast("int").alias("week"),
        F.col("lat").alias("stadium_lat"),
        F.col("long").alias("stadium_long"),
        F.explode(F.array(side("home", "away", 1), side("away", "home", 0))).alias("t"),
    ).select("*", "t.*").drop("t")
    mov = F.col("team_a_score") - F.col("team_b_score")
    return rows.withColumns(
        {
            "team_a_rest_edge": F.col("team_a_rest") - F.col("team_b_rest"),
            "total_score": F.col("team_a_score") + F.col("team_b_score"),
            "team_a_win": (mov > 0).cast("int"),
            "team_a_mov": mov,
        }
    )
