"""The backs' model table carries what it reads, and a hash of the rest."""

import pytest
from pyspark.sql import functions as F

from yardline.operators.columns import fold
from yardline.plans import features as X

RUSH = """game_id string, player_id string, team string, player string, home_team string, away_team string, season int, week int, rush_att long,
    rush_yds long, success long, rush_td long, rush_epa double, fumbles long, total_line double, team_rush_atts long, rush_yds_per_att double,
    success_perc double, rush_att_share double, rush_dk_points double, rush_fd_points double"""
REC = """game_id string, player_id string, team string, full_name string, season int, week int, position string, depth_team double,
    offense_pct double, targets long, rec long, air_yards long, yac long, rec_yards long, td long, target_share double, aDOT double,
    yrds_per_rec double, air_yards_share double, yac_per_rec double, `100_yds_rec` int, rec_dk_points double, rec_fd_points double,
    team_air_yards long"""
MODEL = ["game_id", "player_id", "total_dk", "rolling_target_share", "rolling_targets", "rolling_td", "rolling_rush_td", "rolling_rush_att_share",
         "rolling_snap_pct", "total_line", "spread_line"]


def backs(spark):
    """Runners and receivers of 12 games: rows that come twice, games without a receiving line, nulls, one game with two rows of lines."""
    rush, rec, lines = [], [], []
    for g in range(12):
        game = f"g{g:02d}"
        for t in ("A", "B"):
            lines += [(game, t, g / 2 if g != 5 else None)] * (2 if g == 3 else 1)
            for p in range(3):
                n = (g * 7 + p * 3 + (t == "B")) % 11
                who = f"{t}{p}" if (g, p) != (8, 2) else None
                rush.append((game, who, t, f"n{p}", "A", "B", 2020 + g // 6, g % 6, n, 3 * n, n // 2, n % 3, n / 8, n % 2, 40.0 + g if g != 6 else None,
                             20, 3.0, 0.5, n / 16, n * 1.5 if n else None, n * 1.25))
                if (g + p) % 5:
                    rec.append((game, who, t, f"n{p}", 2020 + g // 6, g % 6, "RB" if p else "WR", float(1 + (g + p) % 2), float(20 + n * 5), n % 4, n % 3, n, n, 5 * n,
                                n % 2, n * 2.0, n / 4 if n else None, 1.0, 2.0, 3.0, 0, n * 0.5, n * 0.25, 30 if n else None))
    again = [r for r in rush if r[0] == "g04"]
    return spark.createDataFrame(rush + again, RUSH), spark.createDataFrame(rec, REC), spark.createDataFrame(lines, "game_id string, team string, spread_line double")


def test_unequal_rows_stay_apart(spark):
    rows = [(1, None, 5.0, "x"), (1, 5, None, "x"), (1, None, None, "x"), (1, 0, 0.0, ""), (1, 0, -0.0, ""), (1, 0, float("nan"), None),
            (1, 0, float("nan"), None), (2, 0, 0.0, ""), (1, 0, 0.0, None)]
    df = spark.createDataFrame(rows, "k int, a int, `b.c` double, d string")
    assert fold(df, ["k"]).distinct().count() == df.distinct().count() == 7
    assert fold(fold(df, ["k", "a"]), ["k"]).distinct().count() == 7
    assert fold(df, df.columns).columns == df.columns


@pytest.mark.parametrize("size", [{}, {"row_bound": 1000}, {"floor": 4}])
def test_same_model_table_with_and_without_the_other_columns(spark, size):
    rush, rec, lines = backs(spark)
    out = []
    for keep in (None, X.BACK_MODEL_INPUTS):
        rows = X.back_model_table(X.rb_workload(rush, rec, keep=keep, **size), lines).select(*MODEL).collect()
        out.append(sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows))
    assert out[0] == out[1]
    assert len(out[0]) > 10


def test_backs_carry_what_the_model_reads_and_stay_with_their_game(spark, monkeypatch):
    written, moved, write = [], [], X.settle

    def noted(df):
        written.append(len(df.columns))
        moved.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df)

    monkeypatch.setattr(X, "settle", noted)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    names = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rush, rec, lines = backs(spark)
        rb = X.rb_workload(rush.repartition("game_id"), rec.repartition("game_id"), keep=X.BACK_MODEL_INPUTS)
        X.back_model_table(rb, lines).agg(F.count("*")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert moved[0] == 2  # the join by game and player moves nothing
    assert written == [25, 17, 18]
    assert spark.conf.get(names) == before
