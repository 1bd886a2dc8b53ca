"""Features over groups beyond a task's share read their input a fixed number of times, and give what plain windows give."""

import numpy as np
import pytest

from yardline.operators import aggregates as A
from yardline.operators.windows import add_expanding_means
from yardline.plans import builders as B
from yardline.plans import features as X
from yardline.plans import models as M


def counted(spark, rows, schema):
    """A table, and how many of its rows have been read so far."""
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, schema).mapInArrow(read, schema), seen


PLAYS = "game_date string, game_id string, season int, posteam string, defteam string, epa double, play_type string, play_seq long, play_tie long"


def plays():
    rng = np.random.default_rng(3)
    out = []
    for g in range(30):
        a, b = f"T{g % 4}", f"T{(g + 1) % 4}"
        for i in range(int(rng.integers(2, 9))):
            side = (a, b) if rng.random() < 0.5 else (b, a if g % 7 else None)
            epa = None if rng.random() < 0.2 else float(rng.integers(-20, 20)) / 8
            out.append((f"2020-09-{1 + g // 3:02d}", f"g{g:02d}" if g != 11 else None, 2020 + g % 2, *side, epa, ["pass", "run", "kick"][i % 3], i, g))
    return out


def test_adjusted_epa_reads_plays_twice(spark):
    df, seen = counted(spark, plays(), PLAYS)
    got = B.adjusted_epa(df, floor=12, keep=["play_seq", "play_tie"]).collect()
    assert seen.value <= 2 * len(plays())
    plain = B.adjusted_epa(spark.createDataFrame(plays(), PLAYS), row_bound=1, keep=["play_seq", "play_tie"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))


@pytest.mark.parametrize("floor", [2, 12, 1000])
def test_expanding_means_by_unit(spark, floor):
    """A floor below the plays of a game leaves them to ``add_features``."""
    df = spark.createDataFrame(plays(), PLAYS)
    by = {"league": ["season"], "whole": [], "team": ["season", "posteam"]}
    unit, order = ["game_date", "game_id"], ["play_seq", "play_tie"]
    got = add_expanding_means(df, by, unit, order, "epa", floor=floor)
    plain = add_expanding_means(df, by, unit, order, "epa", row_bound=1)
    assert got.schema == plain.schema
    rows = [sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in x.collect()) for x in (got, plain)]
    assert rows[0] == rows[1]


GAMES = """season int, week int, game_id string, team string, opp_team string, pass_attempt long, rush_attempt long, pass_yards long,
           rush_yards long, opp_pass_yds long, opp_rush_yds long"""


def test_team_rolling_reads_games_once(spark):
    rows = [(2020, g, f"g{g:02d}", f"T{s}", f"T{1 - s}", g, s, g * 3 % 7, g % 5, g % 4, g % 3) for g in range(20) for s in (0, 1)]
    df, seen = counted(spark, rows, GAMES)
    got = X.team_rolling(df, floor=8).collect()
    assert seen.value == len(rows)
    plain = X.team_rolling(spark.createDataFrame(rows, GAMES), row_bound=1).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))


DEFENCE = """season int, week int, game_id string, team string, def_int long, def_td long, fumble_lost long, def_sack long, safety long,
             kick_blocked long"""
LINES = "game_id string, team string, total_line double, spread_line double, points int, opp_points int"


def test_defence_points_reads_lines_once(spark):
    keys = [(f"g{g:02d}", f"T{s}", g, s) for g in range(40) for s in (0, 1)]
    rows = [(2020, g, i, t, g % 2, s, 0, g % 4, 0, 0) for i, t, g, s in keys]
    lines = [(i, t, 40.0 + g, 1.5, g % 30, g % 37) for i, t, g, _ in keys]
    df, seen = counted(spark, rows, DEFENCE)
    got = X.defence_points(df, spark.createDataFrame(lines, LINES), floor=8).collect()
    assert seen.value == len(rows)
    plain = X.defence_points(spark.createDataFrame(rows, DEFENCE), spark.createDataFrame(lines, LINES), row_bound=1).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))


def test_overall_quantiles_are_found_once(spark):
    rows = [(float(i * 7 % 31), i % 5 if i % 4 else None, None) for i in range(90)]
    schema = "a double, b int, c double"
    wanted = {"lo": ("a", 0.25), "mid": ("a", 0.5), "b_mid": ("b", 0.5), "none": ("c", 0.5)}
    df, seen = counted(spark, rows, schema)
    q = A.overall_quantiles(df, wanted, floor=10)
    before = seen.value
    table = spark.range(1).select(*[v.alias(n) for n, v in q.items()])
    got = [table.collect()[0] for _ in range(3)][0]
    assert seen.value == before <= 4 * len(rows)
    small = A.overall_quantiles(spark.createDataFrame(rows, schema), wanted)
    assert got == spark.range(1).select(*[v.alias(n) for n, v in small.items()]).first()


@pytest.mark.parametrize("n", [3, 4, 17, 72, 256])
def test_short_series_by_whole_windows(n):
    rng = np.random.default_rng(n)
    y, weight = rng.normal(200, 50, n), rng.uniform(0, 1, n)
    near = min(n, max(2, int(0.7 * n)))
    np.testing.assert_allclose(M._short_local_lines(y, weight, near), M._local_lines(y, weight, near), rtol=1e-7)


RECEIVERS = """season int, week int, game_id string, team string, player_id string, full_name string, position string, depth_team double,
               offense_pct double, targets long, rolling_targets double"""


def receivers():
    kind = ["WR", "TE", "RB", "WR", "WR"]
    return [(2020, g, f"g{g:02d}", t, f"{t}{p}", f"N{p}", kind[p], 1.0 + (p + g) % 3, float(p * g % 9), (p + g) % 5, float(g % 4) if g else None)
            for g in range(14) for t in ("A", "B") for p in range(5) if (p + g) % 6]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_receivers_move_once_by_player_and_once_by_team(spark, monkeypatch):
    moved, write = [], X.settle

    def counting(df):
        if "pos_depth_targets" not in df.columns:
            moved.append(exchanges(df))
        return write(df)

    monkeypatch.setattr(X, "settle", counting)
    df = spark.createDataFrame(receivers(), RECEIVERS)
    got = X.wr_depth_targets(df).collect()
    assert sum(moved) == 2
    for size in ({"row_bound": 100}, {"floor": 5}):
        other = X.wr_depth_targets(df, **size).select(*got[0].__fields__).collect()
        for a, b in zip(sorted(got, key=str), sorted(other, key=str), strict=True):
            assert all(x == pytest.approx(y, abs=1e-9) if isinstance(x, float) else x == y for x, y in zip(a, b, strict=True))


def test_lines_of_runners_and_receivers_move_twice(spark):
    rows = [("g1", "T1", "P1", "a", 1, 5, 1, 2, 3, 4, 0, 0.5, 0, 0, "T1", "T2", 44.0)]
    schema = """game_id string, posteam string, player string, name string, play_seq long, yards_gained int, pass_attempt int, complete_pass int,
                air_yards int, yards_after_catch int, touchdown int, epa double, success int, fumble_lost int, home_team string,
                away_team string, total_line double"""
    plays = spark.createDataFrame(rows, schema).selectExpr(
        "*", "1 AS rush_attempt", "1 AS qb_dropback", "player AS rusher_player_id", "name AS rusher_player_name", "player AS receiver_player_id",
        "name AS receiver_player_name",
    )
    assert exchanges(B.receiving(plays)) == exchanges(B.rushing(plays)) == 2


def test_model_rows_are_read_twice(spark):
    rows = [(2020, f"g{g:02d}", f"P{p}", "T1", float(g * p % 11), 1.0, 5.0 + g) for g in range(12) for p in range(4)]
    df, seen = counted(spark, rows, "season int, game_id string, player_id string, team string, offense_pct double, depth_team double, total_dk double")
    lines = spark.createDataFrame([(f"g{g:02d}", "T1", 1.5) for g in range(12)], "game_id string, team string, spread_line double")
    assert X.back_model_table(df, lines).count()
    assert seen.value == 2 * len(rows)  # groups are counted, then rows kept
