"""Player and team features that only look back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.functions.scalars import (
    band_score,
    fantasy_points,
    flag,
    franchise,
    half_even,
    implied_points,
    opponent,
    team_spread,
)
from yardline.operators.aggregates import (
    average_rank,
    keep_large_groups,
    overall_quantiles,
    share,
    with_group,
)
from yardline.operators.columns import fold, mask, round_all
from yardline.operators.joins import join_suffixed, opponent_join, priority_lookup, validated_join
from yardline.operators.skew import group_sizes
from yardline.operators.windows import (
    Ewm,
    Lag,
    RollingMean,
    RollingSlope,
    add_features,
    expanding_fraction,
    expanding_mean,
    fill_forward,
    running_count,
    settled_beyond,
)
from yardline.session import settle, shared_partitions

GAME_ORDER = ("season", "week", "game_id")
PLAYER_ORDER = (*GAME_ORDER, "player_id")


def c(name: str) -> Column:
    return F.col(name)


def tidy(x: Column, places: int) -> Column:
    """Half-even rounding of an average; float noise is removed first, so that exact ties round alike
    whatever order the sums were taken in."""
    return half_even(F.round(x, 9), places)


# --- scoring -----------------------------------------------------------------------------------------
def score_passers(df: DataFrame) -> DataFrame:
    return df.withColumns({"dk_points": fantasy_points("pass_dk"), "fd_points": fantasy_points("pass_fd")})


def score_rushers(df: DataFrame) -> DataFrame:
    return df.withColumns({"rush_dk_points": fantasy_points("rush_dk"), "rush_fd_points": fantasy_points("rush_fd")})


def score_receivers(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "100_yds_rec": flag(c("rec_yards") >= 100),
            "rec_dk_points": fantasy_points("rec_dk"),
            "rec_fd_points": fantasy_points("rec_fd"),
        }
    )


def score_kickers(df: DataFrame) -> DataFrame:
    return df.withColumns({"kicker_dk_points": fantasy_points("kick"), "kicker_fd_points": fantasy_points("kick")})


# --- rolling features --------------------------------------------------------------------------------
def team_rolling(team_games: DataFrame, n: int = 6, **size) -> DataFrame:
    """Full rolling means of what a team did, and of what its opponents did against it."""
    own = {
        "team_rolling_pass_att": "pass_attempt",
        "team_rolling_run_att": "rush_attempt",
        "team_rolling_pass_yds": "pass_yards",
        "team_rolling_run_yds": "rush_yards",
    }
    against = {"opp_rolling_pass_yds": "opp_pass_yds", "opp_rolling_rush_yds": "opp_rush_yds"}
    given = team_games
    team_games = settled_beyond(team_games, size.get("row_bound"), size.get("floor"))
    out = add_features(team_games, ["team"], GAME_ORDER, {k: RollingMean(v, n) for k, v in own.items()}, **size)
    if "sizes" not in size and team_games is not given:  # the same rows, before the first windows
        size["sizes"] = group_sizes(team_games, ["opp_team"], size.get("floor"))
    return add_features(out, ["opp_team"], GAME_ORDER, {k: RollingMean(v, n) for k, v in against.items()}, **size)


def qb_rolling(qb: DataFrame, n: int = 15, min_att: int = 15, **size) -> DataFrame:
    """Rolling passer features; games with few attempts leave after the windows have seen them."""
    qb = score_passers(settle(qb)).withColumns(
        {"pass_success_perc": share(c("success"), c("att")), "total_epa": c("epa") + c("rush_epa")}
    )
    spans = {
        "rolling_pass_attempts": ("att", 9),
        "rolling_pass_yards": ("pass_yards", n),
        "rolling_air_yards": ("air_yards", n),
        "rolling_ints": ("interception", n),
        "rolling_pass_tds": ("touchdown", n),
        "rolling_rush_att": ("rush_att", n),
        "rolling_rush_yds": ("rush_yds", n),
        "rolling_epa_total": ("total_epa", 15),
        "rolling_pass_epa": ("epa", 10),
        "rolling_dk_points": ("dk_points", 12),
    }
    means = {
        "rolling_pass_success": "pass_success_perc",
        "rolling_rush_tds": "rush_td",
        "rolling_rush_att_share": "rush_att_share",
    }
    feats = {k: Ewm(col, span=s) for k, (col, s) in spans.items()}
    feats |= {k: RollingMean(col, n, partial=True) for k, col in means.items()}
    out = add_features(qb, ["player"], PLAYER_ORDER, feats, **size)
    return out.withColumnRenamed("player", "starting_qb").filter(c("att") >= min_att)


def receiver_rolling(df: DataFrame, n: int = 12, **size) -> DataFrame:
    spans = {"targets": 5, "rec": 10, "air_yards": n, "rec_yards": n, "target_share": 4, "td": n, "rec_dk_points": n}
    names = {"rec": "rolling_receptions"}
    df = df if "sizes" in size or "row_bound" in size else settle(df)
    feats = {names.get(k, f"rolling_{k}"): Ewm(k, span=s) for k, s in spans.items()}
    feats["rolling_aDOT"] = RollingMean("aDOT", n, partial=True)
    out = add_features(df, ["player_id"], GAME_ORDER, feats, **size)
    return out.withColumn("rolling_rec_dk_points", F.coalesce(c("rolling_rec_dk_points"), F.lit(0.0)))


def rusher_rolling(df: DataFrame, **size) -> DataFrame:
    spans = {
        "rolling_rush_att": ("rush_att", 6),
        "rolling_rush_yds": ("rush_yds", 15),
        "rolling_rush_td": ("rush_td", 15),
        "rolling_rush_att_share": ("rush_att_share", 4),
        "rolling_rush_dk_pts": ("rush_dk_points", 15),
    }
    out = add_features(df, ["player_id"], GAME_ORDER, {k: Ewm(col, span=s) for k, (col, s) in spans.items()}, **size)
    return out.withColumn("rolling_rush_att_share", tidy(c("rolling_rush_att_share"), 1) * 100)


# columns that the rolling features of rushers and receivers read
RUSHER_INPUTS = ["rush_att", "rush_yds", "rush_td", "rush_att_share", "rush_dk_points"]
RECEIVER_INPUTS = ["targets", "rec", "air_yards", "rec_yards", "target_share", "td", "rec_dk_points", "aDOT"]
RECEIVING_DEFAULTS = ["targets", "rec", "air_yards", "yac", "rec_yards", "td", "target_share", "aDOT",
                      "yrds_per_rec", "air_yards_share", "yac_per_rec", "100_yds_rec", "rec_dk_points"]


def receiver_frame(snaps: DataFrame, depth: DataFrame, receiving: DataFrame) -> DataFrame:
    """Snap counts of backs and receivers with depth-chart slot and receiving line."""
    slots = depth.filter(c("position").isin("QB", "RB", "WR", "TE"))
    slots = slots.select("player_id", "season", "week", "position", "depth_team")
    rows = snaps.withColumnRenamed("player", "full_name").join(slots, ["player_id", "season", "week"], "left")
    rows = rows.distinct().na.drop()
    rows = mask(rows, "full_name", (c("full_name") == "Mike Williams") & (c("team") != "LAC"), "none")
    rows = rows.join(receiving.drop("player"), ["game_id", "player_id", "team"], "left")
    rows = mask(rows, "offense_pct", c("season") == 2021, c("offense_pct") * 100)
    return rows.filter(c("position").isin("RB", "WR", "TE")).na.fill({k: 0 for k in RECEIVING_DEFAULTS})


def rb_workload(rush: DataFrame, receivers: DataFrame, *, keep: Sequence[str] | None = None, **size) -> DataFrame:
    """Backs: touches, rank inside the backfield, and how both differ from their recent level.

    ``keep``: columns that the caller reads. The others then become one hash (``fold``) as soon as no feature needs them.
    """

    def only(df: DataFrame, *needed: str) -> DataFrame:
        return df if keep is None else fold(df, {"game_id", "player_id", "team", "season", "week", *keep, *needed})

    rb = join_suffixed(rush, receivers.drop("season", "week"), ["game_id", "player_id"])
    rb = rb.drop("team_merged", "full_name")
    rb = rb.withColumns(
        {
            "total_dk": c("rush_dk_points") + c("rec_dk_points"),
            "total_fd_points": c("rush_fd_points") + c("rec_fd_points"),
        }
    )
    rb = rb.na.fill({k: 0 for k in RECEIVING_DEFAULTS})  # the totals stay null
    carried = ("position", "offense_pct", "depth_team", "total_dk", "total_fd_points")
    with shared_partitions(rb.sparkSession):  # lines lie by game, which holds few players
        rb = settle(only(rb, *carried, *RUSHER_INPUTS, *RECEIVER_INPUTS))
    if "row_bound" not in size:
        size = {**size, "sizes": group_sizes(rb, ["player_id"], size.get("floor"), 1)}
    totals = {"rolling_total_dk": Ewm("total_dk", span=15), "rolling_total_fd": Ewm("total_fd_points", span=15)}
    rb = add_features(rb, ["player_id"], GAME_ORDER, totals, **size)
    rb = receiver_rolling(rusher_rolling(rb, **size), **size)
    rb = rb.filter(c("position") == "RB").withColumn("player_touches", c("rush_att") + c("targets"))
    rb = only(rb, "player_touches", "offense_pct", "depth_team")
    backfield = Window.partitionBy("game_id", "team")  # the backs of one team in one game
    rb = rb.withColumn("total_team_rb_touches", F.sum("player_touches").over(backfield))
    rb = average_rank(rb, ["game_id", "team"], "player_touches", "workload_rank", grain="player")
    rb = settle(only(rb, "player_touches", "offense_pct", "depth_team", "workload_rank"))
    if "sizes" in size:  # the filter left fewer rows
        size["sizes"] = group_sizes(rb, ["player_id"], size.get("floor"), 1)
    player = {
        "rolling_snap_pct": Ewm("offense_pct", span=4),
        "rolling_player_touches": Ewm("player_touches", span=5),
        "rolling_workload": Ewm("workload_rank", span=5),
        "rolling_depth": Ewm("depth_team", span=5),
    }
    rb = add_features(rb, ["player_id"], GAME_ORDER, player, **size)
    size.pop("sizes", None)
    slot = {"team_rank_avg_touches": Ewm("player_touches", span=5)}
    rb = add_features(rb, ["team", "workload_rank"], PLAYER_ORDER, slot, **size)
    for n in ("rolling_snap_pct", "rolling_player_touches", "rolling_workload", "team_rank_avg_touches"):
        rb = rb.withColumn(n, tidy(c(n), 1))
    rb = rb.withColumns(
        {
            "touch_diff": c("team_rank_avg_touches") - c("rolling_player_touches"),
            "workload_diff": c("workload_rank") - c("rolling_workload"),
            "depth_diff": tidy(c("depth_team") - c("rolling_depth"), 3),
        }
    )
    return only(rb)


def wr_depth_targets(receivers: DataFrame, **size) -> DataFrame:
    """Receivers: targets by depth slot, and the slot's recent level against its players' recent sum.

    ``receivers`` carries ``rolling_targets`` from ``receiver_rolling``.
    """
    slot = ["team", "position", "depth_team"]
    rec = receivers.filter(c("position").isin("WR", "TE"))
    # windows by player come first, while the rows of ``receiver_rolling`` still lie by player
    player = {"rolling_snap_pct": Ewm("offense_pct", span=4), "rolling_depth": Ewm("depth_team", span=5)}
    rec = add_features(rec, ["player_id"], GAME_ORDER, player, **size)
    team = {
        "team_rank_avg_workload": Ewm("target_workload", span=5),
        "rolling_sum_depth": Ewm("sum_team_depth_targets", span=5),
    }
    by_team = {"sizes": group_sizes(rec, ["team"], size.get("floor"), 1)} if "row_bound" not in size else {}
    sizes = by_team.get("sizes")
    by_team = {**size, **by_team}
    if sizes is not None and sizes.fits and sizes.largest <= min(f.safe_rows for f in team.values()):
        rec = rec.repartition("team")  # for its games and its whole history
    # windows over the receivers of one team in one game
    team_game = ["game_id", "team"]
    rec = rec.withColumns(
        {
            "position_targets": F.sum("targets").over(Window.partitionBy(*team_game, "position")),
            "total_wr_te_targets": F.sum("targets").over(Window.partitionBy(*team_game)),
            "sum_team_depth_targets": F.sum("targets").over(Window.partitionBy("game_id", *slot)),
        }
    )
    rec = average_rank(rec, team_game, "targets", "target_workload", grain="player")
    if sizes is not None and not sizes.fits:
        rec = settle(rec)
    rec = settle(add_features(rec, ["team"], PLAYER_ORDER, team, **by_team))
    slots = rec.groupBy(*GAME_ORDER, *slot).agg(
        F.max("sum_team_depth_targets").alias("pos_depth_targets"),
        F.sum("rolling_targets").alias("_players"),
    )
    levels = {
        "rolling_pos_depth_targets": Ewm("pos_depth_targets", span=5),
        "rolling_pos_depth_targets_no_shift": Ewm("pos_depth_targets", span=5, shift=False),
    }
    slots = add_features(settled_beyond(slots, size.get("row_bound"), size.get("floor")), slot, GAME_ORDER, levels, **size)
    slots = slots.withColumn("rolling_depth_target_sum", tidy(F.coalesce("_players", F.lit(0.0)), 1))
    rec = rec.drop("sum_team_depth_targets").join(
        slots.drop("season", "week", "_players"), ["game_id", *slot], "left"
    )
    rounded = ["team_rank_avg_workload", "rolling_sum_depth", *levels]
    rec = rec.withColumns({n: tidy(c(n), 1) for n in rounded})
    return rec.withColumns(
        {
            "depth_diff": tidy(c("depth_team") - c("rolling_depth"), 3),
            "rolling_target_diff": tidy(c("rolling_pos_depth_targets") - c("rolling_depth_target_sum"), 1),
        }
    ).withColumnRenamed("full_name", "player")


def kicker_rolling(kickers: DataFrame, span: int = 15, **size) -> DataFrame:
    cols = {"rolling_pat": "pats", "rolling_39": "fg_0_39", "rolling_49": "fg_40_49", "rolling_50": "fg_50_on",
            "rolling_dk_points": "kicker_dk_points", "rolling_fd_points": "kicker_fd_points"}
    feats = {k: Ewm(v, span=span) for k, v in cols.items()}
    out = add_features(score_kickers(settle(kickers)), ["kicker_player_id", "team"], GAME_ORDER, feats, **size)
    return round_all(out, 2)


def defence_points(defence: DataFrame, team_games: DataFrame, n: int = 15, min_season: int = 2016, **size) -> DataFrame:
    """Fantasy points of defences with points-allowed bands, their rolling means, and the opponent's
    implied score."""
    cols = ["game_id", "team", "total_line", "spread_line", "points", "opp_points"]
    rows = defence.join(team_games.select(*cols), ["game_id", "team"], "left")
    bands = F.coalesce(band_score(c("opp_points")), F.lit(0))
    rows = rows.withColumn("def_dk_pts", fantasy_points("defence") + bands)
    feats = {
        "rolling_opp_points": RollingMean("opp_points", n),
        "rolling_sack": RollingMean("def_sack", n),
        "rolling_int": RollingMean("def_int", n),
        "rolling_dk_pts": RollingMean("def_dk_pts", n),
    }
    rows = add_features(settled_beyond(rows, size.get("row_bound"), size.get("floor")), ["team"], GAME_ORDER, feats, **size)
    implied = c("total_line") / 2 + c("spread_line") / 2
    return rows.withColumn("opp_implied_score", implied).filter(c("season") >= min_season)


# --- starters ----------------------------------------------------------------------------------------
def starters(passers: DataFrame, schedule: DataFrame, next_gen: DataFrame | None = None, **size) -> DataFrame:
    """Starting quarterbacks with game, share of the team's passing yards and its history."""
    schedule = settle(schedule.withColumns({s: franchise(c(s), c("season")) for s in ("home_team", "away_team")}))
    keys = ["season", "week", "recent_team"]
    home = schedule.select("season", "week", c("home_team").alias("recent_team"), "game_id")
    away = schedule.select("season", "week", c("away_team").alias("recent_team"), "game_id")
    rows = priority_lookup(passers, away, home, keys, "game_id", "game_id", "NA")
    rows = validated_join(rows, schedule.drop("season_type"), ["game_id", "season", "week"])
    passers_of_team = Window.partitionBy(*keys)  # the passers of one team in one week
    rows = rows.withColumn("team_passing_yards", F.sum("passing_yards").over(passers_of_team))
    started = (c("player_id") == c("home_qb_id")) | (c("player_id") == c("away_qb_id"))
    rows = settle(rows.filter(started)).withColumns(
        {
            "total_epa": c("passing_epa") + c("rushing_epa"),
            "frac_team_yards": share(c("passing_yards"), c("team_passing_yards")),
        }
    )
    history = {"expanding_team_frac": expanding_fraction("frac_team_yards", 0.95)}
    rows = add_features(rows, ["player_id"], GAME_ORDER, history, **size)
    if next_gen is not None:
        rows = validated_join(rows, next_gen, ["season", "week", "player_id"], validate="one_to_one")
    return rows


def week_means(rows: DataFrame, col: str = "passing_yards", default: float = 250.0, **size) -> DataFrame:
    """League mean of a column before each week of a season: expanding over the season's earlier weeks,
    then carried forward over the calendar, then the default."""
    weeks = settle(rows.groupBy("season", "week").agg(F.avg(col).alias(col)))
    weeks = add_features(weeks, ["season"], ["week"], {"_mean": expanding_mean(col)}, **size)
    weeks = add_features(weeks, [], ["season", "week"], {"season_expanding_mean": fill_forward("_mean")}, **size)
    return weeks.withColumn("season_expanding_mean", F.coalesce("season_expanding_mean", F.lit(default))).drop("_mean")


def fill_with_medians(df: DataFrame, sources: Mapping[str, str], *, floor: int | None = None, **_) -> DataFrame:
    """Fill nulls of each key column with the overall median of its source column."""
    medians = overall_quantiles(df, {n: (source, 0.5) for n, source in sources.items()}, floor=floor)
    return df.withColumns({n: F.coalesce(c(n), medians[n]) for n in sources})


STARTER_EWMS = {  # feature: (column, alpha)
    "ewm_passing_yards": ("passing_yards", 0.08),
    "ewm_passing_epa": ("passing_epa", 0.08),
    "ewm_rushing_epa": ("rushing_epa", 0.0425),
    "ewm_total_epa": ("total_epa", 0.08),
    "ewm_passing_attempts": ("attempts", 0.08),
    "ewm_pass_completions": ("completions", 0.08),
    "ewm_interceptions": ("interceptions", 0.13),
}
LEAGUE_PRIORS = {  # adjusted feature: (average, column of the league prior, default, shrinkage constant)
    "adj_ewm_passing_epa": ("ewm_passing_epa", "passing_epa", 0.05, 3),
    "adj_ewm_passing_attempts": ("ewm_passing_attempts", "attempts", 40.0, 3),
    "adj_ewm_rushing_epa": ("ewm_rushing_epa", "rushing_epa", -3.75, 3),
    "adj_ewm_total_epa": ("ewm_total_epa", "total_epa", 2.0, 1),
}


def shrink(average: Column, prior: Column, games: Column, constant: float) -> Column:
    """Weight the average by games / (games + constant), the prior by the rest."""
    w = games.cast("double") / (games + F.lit(constant))
    return w * average + (1 - w) * prior


def starter_averages(rows: DataFrame, **size) -> DataFrame:
    """Exponentially weighted averages per starter, medians for debuts, regular season only."""
    feats = {n: Ewm(col, alpha=a) for n, (col, a) in STARTER_EWMS.items()}
    rows = settle(add_features(rows, ["player_id"], GAME_ORDER, feats, **size))
    rows = fill_with_medians(rows, {n: col for n, (col, _) in STARTER_EWMS.items()}, **size)
    return rows.filter(c("season_type") == "REG")


def shrunk_ewm(rows: DataFrame, **size) -> DataFrame:
    """Averages pulled toward league priors while a starter has few games, with trend and implied points.

    ``rows``: ``starter_averages``.
    """
    rows = settle(rows)
    weeks = week_means(rows, **size).select("season", "week", "season_expanding_mean")
    rows = rows.join(weeks, ["season", "week"], "left")
    rows = add_features(rows, ["player_id"], GAME_ORDER, {"games_started": running_count()}, **size)
    priors = {f"_prior_{col}": expanding_mean(col) for _, col, _, _ in LEAGUE_PRIORS.values()}
    rows = add_features(rows, [], PLAYER_ORDER, priors, **size)
    games = c("games_started")
    rows = rows.withColumn(
        "adj_ewm_passing_yards", shrink(c("ewm_passing_yards"), c("season_expanding_mean"), games, 3)
    )
    for name, (avg, col, default, k) in LEAGUE_PRIORS.items():
        rows = rows.withColumn(name, shrink(c(avg), F.coalesce(c(f"_prior_{col}"), F.lit(default)), games, k))
    rows = rows.drop(*priors).withColumns(
        {
            "adj_ewm_epa_per_att": share(c("adj_ewm_passing_epa"), c("adj_ewm_passing_attempts")),
            "adj_ewm_py_per_att": share(c("adj_ewm_passing_yards"), c("adj_ewm_passing_attempts")),
            "team_spread": team_spread(c("spread_line"), c("recent_team") == c("home_team")),
        }
    )
    rows = settle(rows.withColumn("implied_points", implied_points(c("total_line"), c("team_spread"))))
    feats = {
        "local_trend_ewm25": RollingSlope("adj_ewm_passing_yards", 25),
        "ewm_implied_points": Ewm("implied_points", alpha=0.08),
    }
    rows = add_features(rows, ["player_id"], GAME_ORDER, feats, **size)
    rows = rows.withColumn("ewm_implied_points", F.coalesce("ewm_implied_points", F.lit(22.0)))
    return rows.withColumn("implied_points_diff", c("implied_points") - c("ewm_implied_points"))


def opponent_defence(rows: DataFrame, alpha: float = 0.052, constant: float = 7, **size) -> DataFrame:
    """Passing yards the opposing defence has allowed, pulled toward the season's mean early in it."""
    rows = rows.withColumn("defteam", opponent(c("recent_team"), c("home_team"), c("away_team")))
    feats = {"defteam_ewm_passing_yards": Ewm("passing_yards", alpha=alpha)}
    rows = add_features(rows, ["defteam"], PLAYER_ORDER, feats, **size)
    prior = c("season_expanding_mean")
    rows = rows.withColumn("defteam_ewm_passing_yards", F.coalesce("defteam_ewm_passing_yards", prior))
    return rows.withColumn("adj_def_ewm_py", shrink(c("defteam_ewm_passing_yards"), prior, c("week"), constant))


# --- model tables ------------------------------------------------------------------------------------
def zscore_filter(df: DataFrame, keys: Sequence[str], col: str, above: float = -2.0) -> DataFrame:
    """Keep rows whose group z-score (sample deviation) exceeds a bound; an undefined score drops the row."""
    stats = {"_mean": F.avg(col), "_std": F.stddev_samp(col)}
    z = F.try_divide(c(col) - c("_mean"), c("_std"))
    return with_group(df, keys, stats).filter(z > above).drop(*stats)


def qb_model_table(qb: DataFrame, team_games: DataFrame, min_season: int = 2016, min_games: int = 6, **size) -> DataFrame:
    """``qb``: rolling passer features. Adds the opposing defence's recent pass EPA allowed."""
    feats = {"rolling_pass_def_epa": Ewm("def_pass_epa", span=15)}
    team_games = settle(team_games)
    defence = add_features(team_games, ["team"], GAME_ORDER, feats, **size)
    rows = settle(opponent_join(qb, defence, ["rolling_pass_def_epa", "spread_line"]))
    rows = keep_large_groups(rows.filter(c("season") >= min_season), ["starting_qb"], min_games, "game_id")
    rows = rows.withColumn("spread_line", -c("spread_line")).distinct()
    return round_all(rows.filter(c("dk_points") > 0), 3)


def receiver_model_table(
    rec: DataFrame, team_games: DataFrame, position: str = "WR", min_season: int = 2016, min_games: int = 4, **size
) -> DataFrame:
    """``rec``: receiver features. First-string players of one position with complete features."""
    needed = ["rolling_rec_dk_points", "rolling_targets", "rolling_rec_yards", "rolling_td", "rolling_target_share",
              "rec_dk_points", "rolling_snap_pct"]
    rows = keep_large_groups(rec.filter(c("season") >= min_season), ["player_id"], min_games, "game_id")
    lines = team_games.select("game_id", "team", "total_line", "spread_line")
    rows = rows.join(lines, ["game_id", "team"], "left").filter(c("position") == position).distinct()
    rows = settle(rows.na.drop("any", subset=needed))  # the score reads them twice
    rows = zscore_filter(rows, ["player_id"], "offense_pct")
    rows = settle(rows.filter(c("depth_team") == 1))
    rows = add_features(rows, ["player_id"], GAME_ORDER, {"last_game_dk": Lag("rec_dk_points")}, **size)
    return rows.na.drop()


BACK_MODEL_INPUTS = ["game_id", "player_id", "team", "season", "rolling_target_share", "rolling_targets", "rolling_td", "depth_team",
                     "rolling_rush_td", "rolling_rush_att_share", "total_dk", "depth_diff", "rolling_snap_pct", "total_line",
                     "offense_pct"]


def back_model_table(
    rb: DataFrame, team_games: DataFrame, min_season: int = 2016, min_games: int = 3, **_
) -> DataFrame:
    """``rb``: workload features. First-string backs who scored, with complete features."""
    needed = ["rolling_target_share", "rolling_targets", "rolling_td", "depth_team", "rolling_rush_td",
              "rolling_rush_att_share", "total_dk", "depth_diff", "rolling_snap_pct", "total_line", "spread_line"]
    rows = keep_large_groups(rb.filter(c("season") >= min_season), ["player_id"], min_games, "game_id")
    rows = rows.join(team_games.select("game_id", "team", "spread_line"), ["game_id", "team"], "left").distinct()
    rows = settle(rows.na.drop("any", subset=[n for n in needed if n in rows.columns]))  # the score reads them twice
    rows = zscore_filter(rows, ["player_id"], "offense_pct")
    return rows.filter((c("depth_team") == 1) & (c("total_dk") > 0))


def kicker_model_table(kickers: DataFrame, team_games: DataFrame, min_season: int = 2014, min_games: int = 3) -> DataFrame:
    rows = keep_large_groups(kickers.filter(c("season") >= min_season), ["kicker_player_id"], min_games, "game_id")
    lines = team_games.select("game_id", "team", "total_line", "spread_line")
    return rows.join(lines, ["game_id", "team"], "left").na.drop()
