"""Play table to player-game, team-game and drive tables.

Each builder is one pass of conditional aggregates, combined before the shuffle, so a game or player with
very many plays is folded where its plays are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.functions.scalars import PASSER_NAMES, flag, half_even, id_part, normalise_name
from yardline.operators.aggregates import (
    count_where,
    first_known,
    group_with_labels,
    label_groups,
    last_known,
    pick_labels,
    share,
    total,
    total_where,
)
from yardline.operators.windows import Lead, add_expanding_means, add_features, expanding_mean
from yardline.session import settle
from yardline.sources.schemas import require_columns

PLAY_ORDER = ("play_seq", "play_tie")  # total order of the plays of a game
PLAY_ID = ("play_id",)  # the same order as one number, for aggregates
FIRST_PLAY = "play_seq"  # what a group's labels are taken by
TWO_POINT = "two_point_att"


def c(name: str) -> Column:
    return F.col(name)


def total_if_any(cond: Column, col: str) -> Column:
    """Conditional sum; null when no row of the group meets the condition."""
    return F.when(count_where(cond) > 0, total_where(cond, col))


def play_features(
    plays: DataFrame, order: Sequence[str] = PLAY_ORDER, *, floor: int | None = None, row_bound: int | None = None
) -> DataFrame:
    """Add per-play features: numeric results, seconds until the next play, distance bands."""
    plays = add_features(
        plays, ["game_id"], order, {"_next": Lead("game_seconds_remaining")}, floor=floor, row_bound=row_bound
    )
    result = c("two_point_conv_result")
    kind = F.when(c("two_point_attempt") > 0.5, TWO_POINT).otherwise(c("play_type"))
    plays = plays.withColumns(
        {
            "year": F.year("game_date"),
            "game_date": F.to_date("game_date"),
            "two_point_conv_result": F.when(result == "success", 1).when(result == "failure", 0),
            "spread_line": -c("spread_line"),
            "field_goal_result": flag(c("field_goal_result") == "made"),
            "extra_point_result": flag(c("extra_point_result") == "good"),
            "time_between": F.coalesce(c("game_seconds_remaining") - c("_next"), F.lit(0)),
            "play_type": kind,
            "air_yards_to_sticks": c("air_yards") - c("ydstogo"),
            "season": id_part(c("game_id"), 0).cast("int"),
            "blocked_player_name": flag(c("blocked_player_name").isNotNull()),
        }
    ).drop("_next")
    kick = c("play_type") == "field_goal"
    bands = {"fg_0_39": (0, 39), "fg_40_49": (40, 49), "fg_50_on": (50, 100)}
    return plays.withColumns({n: flag(kick & c("kick_distance").between(lo, hi)) for n, (lo, hi) in bands.items()})


def zero(*names: str) -> dict[str, Column]:
    """Sums over no values as 0."""
    return {n: F.coalesce(c(n), F.lit(0)) for n in names}


def qb_pass(plays: DataFrame, order: str = FIRST_PLAY) -> DataFrame:
    """Passing line per game, passer and team."""
    real = (c("pass_attempt") == 1) & (c("play_type") != TWO_POINT)
    thrown = real & (c("sack") == 0)
    caught = c("complete_pass") == 1
    missed = (c("complete_pass") == 0) & (c("play_type") != TWO_POINT)
    on_throw = {"att": "pass_attempt", "com": "complete_pass", "pass_yards": "yards_gained", "air_yards": "air_yards",
                "yards_after_catch": "yards_after_catch", "AYTS": "air_yards_to_sticks",
                "interception": "interception", "success": "success", "epa": "epa", "cpoe": "cpoe"}
    sums = {n: F.when(thrown, c(col)) for n, col in on_throw.items()}
    sums |= {"_thrown": flag(thrown), "sack": c("sack"), "_caught": flag(caught), "_missed": flag(missed),
             "ay_completions": F.when(caught, c("air_yards")), "ay_incompletions": F.when(missed, c("air_yards"))}
    # touchdowns belong to the passer id, under whatever name and team the play lists
    scored = thrown & (c("interception") == 0) & c("passer_player_id").isNotNull()
    keys = {"game_id": "game_id", "player": "passer_player_name", "team": "posteam"}
    labels = {"player_id": "passer_player_id", "season_type": "season_type", "home_team": "home_team", "away_team": "away_team"}
    maxes = {n: F.when(thrown, c(n)) for n in ("total_line", "temp", "wind")}
    by_id = {"_scored": flag(scored), "_td": F.when(scored, c("touchdown"))}
    # one pass over plays; the two results come from its few rows
    fine = settle(label_groups(plays, keys, labels, F.when(thrown, c(order)), sums | by_id, maxes))
    named = fine.filter(c("player").isNotNull() & c("team").isNotNull())
    stats = pick_labels(named, list(keys), list(labels), list(sums), list(maxes)).filter(c("_thrown") > 0)
    stats = stats.withColumns(zero(*on_throw, "sack", "ay_completions", "ay_incompletions")).withColumns(
        {
            "cpoe": c("cpoe") / 100,
            "ay_completions": F.when(c("_caught") > 0, c("ay_completions")),
            "ay_incompletions": F.when(c("_missed") > 0, c("ay_incompletions")),
        }
    ).drop("_thrown", "_caught", "_missed")
    tds = fine.groupBy("game_id", c("_l_player_id").alias("player_id")).agg(F.sum("_scored").alias("_scored"), total("_td").alias("touchdown"))
    stats = stats.join(tds.filter(c("_scored") > 0).drop("_scored"), ["game_id", "player_id"], "left")
    dropbacks = c("att") + c("sack")
    return stats.withColumns(
        {
            "comp_perc": half_even(share(c("com"), dropbacks), 3) * 100,
            "avg_ay_comp": half_even(share(c("ay_completions"), c("com")), 1),
            "avg_ay_incomp": half_even(share(c("ay_incompletions"), dropbacks - c("com")), 1),
            "epa_per_dropback": half_even(share(c("epa"), dropbacks), 3),
            "player": normalise_name(_fixed_names(c("player"))),
        }
    )


def _fixed_names(name: Column) -> Column:
    out = name
    for wrong, right in PASSER_NAMES.items():
        out = F.when(name == wrong, right).otherwise(out)
    return out


def rushing(plays: DataFrame, order: str = FIRST_PLAY) -> DataFrame:
    """Rushing line per game, rusher and team, with the share of the team's carries."""
    runs = plays.filter((c("rush_attempt") == 1) & c("rusher_player_id").isNotNull() & c("posteam").isNotNull())
    sums = {"rush_att": "rush_attempt", "rush_yds": "yards_gained", "success": "success", "rush_td": "touchdown",
            "rush_epa": "epa", "fumbles": "fumble_lost"}
    stats = group_with_labels(
        runs,
        {"game_id": "game_id", "player_id": "rusher_player_id", "team": "posteam"},
        {"player": "rusher_player_name", "home_team": "home_team", "away_team": "away_team"},
        c(order),
        {n: c(col) for n, col in sums.items()} | {"_lines": c("total_line"), "_n": flag(c("total_line").isNotNull())},
        within=["game_id"],
    )
    stats = stats.withColumns(zero(*sums) | {"total_line": share(c("_lines"), c("_n"))}).drop("_lines", "_n")
    team = Window.partitionBy("game_id", "team")  # the players of one team in one game
    return stats.withColumn("team_rush_atts", F.sum("rush_att").over(team)).withColumns(
        {
            "rush_yds_per_att": half_even(share(c("rush_yds"), c("rush_att")), 1),
            "success_perc": half_even(share(c("success"), c("rush_att")), 3),
            "rush_att_share": half_even(share(c("rush_att"), c("team_rush_atts")), 2),
        }
    )


def receiving(plays: DataFrame, order: str = FIRST_PLAY) -> DataFrame:
    """Receiving line per game, receiver and team, with target and air-yard shares."""
    passes = plays.filter((c("qb_dropback") == 1) & c("receiver_player_id").isNotNull() & c("posteam").isNotNull())
    sums = {"rec": "complete_pass", "air_yards": "air_yards", "yac": "yards_after_catch", "rec_yards": "yards_gained",
            "td": "touchdown"}
    stats = group_with_labels(
        passes,
        {"game_id": "game_id", "player_id": "receiver_player_id", "team": "posteam"},
        {"player": "receiver_player_name"},
        c(order),
        {"targets": flag(c("pass_attempt").isNotNull()).cast("long")} | {n: c(col) for n, col in sums.items()},
        within=["game_id"],
    ).withColumns(zero(*sums))
    team = Window.partitionBy("game_id", "team")  # the players of one team in one game
    stats = stats.withColumn("_targets", F.sum("targets").over(team)).withColumn(
        "team_air_yards", F.sum("air_yards").over(team)
    )
    return stats.withColumns(
        {
            "target_share": half_even(share(c("targets"), c("_targets")), 3) * 100,
            "aDOT": share(c("air_yards"), c("targets")),
            "yrds_per_rec": half_even(share(c("rec_yards"), c("rec")), 1),
            "air_yards_share": half_even(share(c("air_yards"), c("team_air_yards")), 3) * 100,
            "yac_per_rec": half_even(share(c("yac"), c("rec")), 1),
        }
    ).drop("_targets")


def opponent_yards(plays: DataFrame) -> DataFrame:
    """Passing and rushing yards a defence allowed, per game."""
    return (
        plays.filter(c("defteam").isNotNull())
        .groupBy("game_id", c("defteam").alias("team"))
        .agg(
            total_if_any(c("pass_attempt") == 1, "yards_gained").alias("opp_pass_yds"),
            total_if_any(c("rush_attempt") == 1, "yards_gained").alias("opp_rush_yds"),
        )
        .filter(c("opp_pass_yds").isNotNull() | c("opp_rush_yds").isNotNull())
    )


def team_yards(plays: DataFrame) -> DataFrame:
    """Passing and rushing yards a team gained, per game."""
    return (
        plays.filter(c("posteam").isNotNull())
        .groupBy("game_id", c("posteam").alias("team"))
        .agg(
            total_if_any(c("pass_attempt") == 1, "yards_gained").alias("pass_yards"),
            total_if_any(c("rush_attempt") == 1, "yards_gained").alias("rush_yards"),
        )
        .filter(c("pass_yards").isNotNull() | c("rush_yards").isNotNull())
    )


def defence_stats(plays: DataFrame, order: str = FIRST_PLAY) -> DataFrame:
    """Takeaways, sacks and scores of a defence, per game; aborted snaps are left out."""
    kept = ~F.coalesce(c("play_desc").contains("Aborted"), F.lit(False))
    sums = {"def_int": "interception", "def_td": "return_touchdown", "fumble_lost": "fumble_lost", "def_sack": "sack",
            "safety": "safety", "kick_blocked": "blocked_player_name"}
    return group_with_labels(
        plays.filter(kept & c("defteam").isNotNull()),
        {"game_id": "game_id", "team": "defteam"},
        {"season": "season"},
        c(order),
        {n: c(col) for n, col in sums.items()},
    ).withColumns(zero(*sums))


def kicker_stats(plays: DataFrame, order: str = FIRST_PLAY) -> DataFrame:
    """Made kicks per game and kicker."""
    good = c("play_desc").contains("GOOD") & c("play_type").isin("field_goal", "extra_point")
    sums = {"fgs": "field_goal_result", "pats": "extra_point_result", "fg_0_39": "fg_0_39", "fg_40_49": "fg_40_49",
            "fg_50_on": "fg_50_on"}
    return group_with_labels(
        plays.filter(good & c("kicker_player_id").isNotNull()),
        {"game_id": "game_id", "kicker_player_id": "kicker_player_id"},
        {"player": "kicker_player_name", "team": "posteam"},
        c(order),
        {n: c(col) for n, col in sums.items()},
    ).withColumns(zero(*sums))


def adjusted_epa(
    plays: DataFrame, order: Sequence[str] = ("game_date", "game_id", *PLAY_ORDER), *, keep: Sequence[str] = (),
    floor: int | None = None, row_bound: int | None = None,
) -> DataFrame:
    """Efficiency before each play: a team's expanding mean EPA minus the league's, by play type.

    A season and play type holds a large share of all plays, so at scale the games before a play are carried as
    totals (``add_expanding_means``). ``order`` ends with ``PLAY_ORDER``, the rest of it tells games apart. ``keep``:
    further columns of the result.
    """
    needed = ["game_id", "season", "posteam", "defteam", "epa", "play_type"]
    require_columns(plays, needed)
    rows = plays.filter(c("play_type").isin("pass", "run")).select(
        *dict.fromkeys([*needed, *order, *keep])
    )
    sides = {"season_epa_play": [], "season_epa_def": ["defteam"], "season_epa_off": ["posteam"]}
    keys = {name: ["season", *by, "play_type"] for name, by in sides.items()}
    n = len(order) - len(PLAY_ORDER)
    if n > 0 and tuple(order[n:]) == PLAY_ORDER:
        rows = add_expanding_means(rows, keys, order[:n], order[n:], "epa", floor=floor, row_bound=row_bound)
    else:
        for name, by in keys.items():
            rows = add_features(rows, by, order, {name: expanding_mean("epa")}, floor=floor, row_bound=row_bound)
    return rows.withColumns(
        {
            "team_adjusted_off_epa": half_even(c("season_epa_off") - c("season_epa_play"), 3),
            "team_adjusted_def_epa": half_even(c("season_epa_def") - c("season_epa_play"), 3),
        }
    )


def team_scores(plays: DataFrame) -> DataFrame:
    """Touchdowns, field goals and two-point conversions on a team's own scoring plays, per game."""
    return (
        plays.filter(c("td_team") == c("posteam"))
        .groupBy("game_id", c("posteam").alias("team"))
        .agg(
            total("touchdown").alias("off_td"),
            total("field_goal_result").alias("fgs"),
            total("two_point_conv_result").alias("two_pts_conv"),
        )
    )


def game_results(plays: DataFrame, schedule: DataFrame) -> DataFrame:
    """Result, yards, scores, rest and coach per team and game, from processed plays and the schedule."""
    numbers = ["year", "week", "home_score", "away_score", "spread_line", "total_line"]
    texts = ["season_type", "home_team", "away_team"]
    scoring = c("td_team") == c("posteam")
    yards = {"rush_yards": "rush_attempt", "pass_yards": "pass_attempt"}
    scores = {"off_td": "touchdown", "fgs": "field_goal_result", "two_pts_conv": "two_point_conv_result"}
    # one pass over plays, grouped on both teams and the texts, so that it hashes; the rest comes from its few rows
    fine = plays.filter(c("posteam").isNotNull() | c("defteam").isNotNull())
    fine = fine.groupBy("game_id", c("posteam").alias("team"), "defteam", *texts).agg(
        *[F.max(n).alias(n) for n in numbers],
        F.sum(flag(scoring)).alias("_scoring"),
        *[F.sum(F.when(c(on) == 1, F.coalesce("yards_gained", F.lit(0)))).alias(n) for n, on in yards.items()],
        *[F.sum(F.when(scoring, c(col))).alias(n) for n, col in scores.items()],
    )
    fine = settle(fine)
    allowed = fine.filter(c("defteam").isNotNull()).groupBy("game_id", c("defteam").alias("team")).agg(
        F.sum("pass_yards").alias("opp_pass_yds"), F.sum("rush_yards").alias("opp_rush_yds")
    ).filter(c("opp_pass_yds").isNotNull() | c("opp_rush_yds").isNotNull())
    own = fine.filter(c("team").isNotNull()).groupBy("game_id", "team").agg(
        *[F.max(n).alias(n) for n in [*numbers, *texts]],
        *[F.sum(n).alias(n) for n in ["_scoring", *yards, *scores]],
    )
    own = own.withColumns({n: F.when(c("_scoring") > 0, F.coalesce(n, F.lit(0))) for n in scores}).drop("_scoring")
    rest = schedule.select("game_id", "home_rest", "away_rest", "home_coach", "away_coach")
    rows = own.join(allowed, ["game_id", "team"], "left").join(rest, ["game_id"], "left")
    home = c("home") == 1

    def sided(a: str, b: str) -> Column:
        return F.when(home, c(a)).otherwise(c(b))

    return (
        rows.withColumn("home", flag(c("team") == c("home_team")))
        .withColumns(
            {
                "season": id_part(c("game_id"), 0).cast("int"),
                "spread_line": F.when(home, c("spread_line")).otherwise(-c("spread_line")),
                "actual_spread": -(c("home_score") - c("away_score")),
                "points": sided("home_score", "away_score"),
                "opp_points": sided("away_score", "home_score"),
                "actual_total": c("home_score") + c("away_score"),
                "over": flag(c("home_score") + c("away_score") > c("total_line")),
                "rest": sided("home_rest", "away_rest"),
                "opp_rest": sided("away_rest", "home_rest"),
                "coach": sided("home_coach", "away_coach"),
                "opp_coach": sided("away_coach", "home_coach"),
            }
        )
        .filter(c("team") != "")
    )


def drive_stats(plays: DataFrame, order: Sequence[str] = PLAY_ID) -> DataFrame:
    """Totals, possession time and outcome per drive, from processed plays."""
    sums = {"time_between": "poss_time", "rush_attempt": "rush_attempt", "pass_attempt": "pass_attempt",
            "yards_gained": "yards_gained", "interception": "int", "fumble": "fumble", "sack": "sack",
            "success": "success", "epa": "epa"}
    gain = c("score_diff_end") - c("score_diff_start")
    return (
        plays.filter(c("posteam").isNotNull() & c("drive").isNotNull())
        .groupBy("game_id", c("posteam").alias("team"), "drive")
        .agg(
            *[total(s).alias(n) for s, n in sums.items()],
            first_known("score_differential", order).alias("score_diff_start"),
            last_known("score_differential_post", order).alias("score_diff_end"),
        )
        .withColumns(
            {"td": flag(gain >= 6), "fg": flag(gain == 3), "total_plays": c("rush_attempt") + c("pass_attempt")}
        )
    )


def game_stats(plays: DataFrame, min_season: int = 2016) -> DataFrame:
    """Yards, EPA and sacks of both sides per game.

    A side's sacks are those taken while the other side has the ball.
    """
    if min_season < 2000:
        raise ValueError("min_season must be 2000 or later")
    aggs = []
    for side, other in (("home", "away"), ("away", "home")):
        has_ball = c("posteam") == c(f"{side}_team")
        for kind, name in (("RUSH", "rush"), ("PASS", "pass")):
            on = has_ball & (c("play_type_nfl") == kind)
            aggs.append(total_where(on, "yards_gained").alias(f"{side}_{name}_yards"))
            aggs.append(total_where(on, "epa").alias(f"{side}_{name}_epa"))
        sacked = (c("posteam") == c(f"{other}_team")) & (c("play_type_nfl") == "SACK")
        aggs.append(count_where(sacked).alias(f"{side}_team_sacks"))
    return (
        plays.filter(c("season") >= min_season)
        .groupBy("game_id", "home_team", "away_team")
        .agg(*aggs)
        .orderBy("game_id")
    )


def qb_games(plays: DataFrame, order: str = FIRST_PLAY) -> DataFrame:
    """Passing and rushing line of passers per game, nulls as 0."""
    runs = rushing(plays, order).select(
        "game_id", "player_id", "rush_att", "rush_yds", "fumbles", "rush_att_share", "rush_td", "rush_epa"
    )
    rows = qb_pass(plays, order).join(runs, ["game_id", "player_id"], "left").na.fill(0)
    return with_time(rows)


def with_time(df: DataFrame) -> DataFrame:
    """Season and week from the game id."""
    return df.withColumns(
        {"season": id_part(c("game_id"), 0).cast("int"), "week": id_part(c("game_id"), 1).cast("int")}
    )

