"""Schedule tables: season records, home field, travel, odds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.functions.scalars import (
    HOME_LAT,
    HOME_LONG,
    HOME_SITE,
    NEUTRAL_SITE,
    OVERSEAS_KM,
    REFEREE_NAMES,
    STADIUM_NAMES,
    build_game_id,
    game_date,
    haversine,
    map_value,
    moneyline_probability,
    season_of,
    without_margin,
)
from yardline.operators.aggregates import first_known, mean_interval
from yardline.operators.joins import join_renamed
from yardline.operators.sets import home_away_rows, keep_first, pair_rows
from yardline.operators.windows import Lead, add_features, running_count
from yardline.session import settle


def c(name: str) -> Column:
    return F.col(name)


def clean_stadiums(stadiums: DataFrame, order: list[str]) -> DataFrame:
    """Trimmed names, first row of each."""
    return keep_first(stadiums.withColumn("stadium", F.trim("stadium")), ["stadium"], order)


def clean_schedule(schedule: DataFrame, stadiums: DataFrame | None = None) -> DataFrame:
    """Corrected stadium and referee names; coordinates when a stadium table is given."""
    rows = schedule.withColumns(
        {
            "stadium": map_value(c("stadium"), STADIUM_NAMES, c("stadium")),
            "referee": map_value(c("referee"), REFEREE_NAMES, c("referee")),
        }
    )
    return rows if stadiums is None else rows.join(stadiums.select("stadium", "lat", "long"), ["stadium"], "left")


def season_results(games: DataFrame) -> DataFrame:
    """Wins, ties, losses and coaches per season and team that played at home and away."""

    def side(name: str, other: str) -> DataFrame:
        won = (c(f"{name}_score") > c(f"{other}_score")).cast("int")
        tied = (c("home_score") == c("away_score")).cast("int")
        return games.groupBy("season", f"{name}_team").agg(
            F.sum(won).alias(f"{name}_win"), F.sum(tied).alias("tie"), F.count(F.lit(1)).alias("games")
        )

    both = join_renamed(side("home", "away"), side("away", "home"), {"season": "season", "home_team": "away_team"})
    coaches = games.groupBy("season", c("home_team").alias("team")).agg(
        F.sort_array(F.collect_set("home_coach")).alias("coaches")
    )
    wins, ties = c("home_win") + c("away_win"), c("tie_x") + c("tie_y")
    rows = both.select(
        "season",
        c("home_team").alias("team"),
        wins.alias("total_wins"),
        ties.alias("total_ties"),
        (c("games_x") + c("games_y") - wins - ties).alias("total_losses"),
    )
    return rows.join(coaches, ["season", "team"], "left")


def travel(games: DataFrame, order: list[str]) -> DataFrame:
    """Team rows with both sides' distance from their home stadium; overseas games count as neutral."""
    rows = home_away_rows(games)
    home = rows.filter(c("team_a_home") == 1).groupBy("season", "team_a").agg(
        first_known("stadium", order).alias("_stadium"),
        first_known("stadium_lat", order).alias("_lat"),
        first_known("stadium_long", order).alias("_long"),
    )
    site = F.when(c("_stadium") == NEUTRAL_SITE, HOME_SITE).otherwise(c("_stadium"))
    home = home.select(
        "season",
        c("team_a").alias("_team"),
        F.when(site == HOME_SITE, HOME_LAT).otherwise(c("_lat")).alias("_lat"),
        F.when(site == HOME_SITE, HOME_LONG).otherwise(c("_long")).alias("_long"),
    )
    for side in ("team_a", "team_b"):
        rows = rows.join(home.withColumnRenamed("_team", side), ["season", side], "left")
        km = haversine(c("_lat"), c("_long"), c("stadium_lat"), c("stadium_long"))
        rows = rows.withColumn(f"{side}_distance_home", km).drop("_lat", "_long")
    far = c("team_a_distance_home") >= OVERSEAS_KM
    return rows.withColumn("team_a_home", F.when(far, 0).otherwise(c("team_a_home")))


def home_advantage(games: DataFrame) -> DataFrame:
    """Home win rate and margin per season, with standard error and two-error bounds."""
    rows = home_away_rows(games).filter(c("team_a_home") == 1)
    rate = rows.groupBy("season").agg(F.avg("team_a_win").alias("home_win_rate"))
    return mean_interval(rows, ["season"], "team_a_mov").join(rate, ["season"], "left")


def week_numbers(dates: DataFrame, **size) -> DataFrame:
    """Week of the season per distinct date: how often its weekday has come round; Thursdays and Saturdays
    belong to the week of the next date. ``dates``: one row per (year, date_dt)."""
    dates = dates.withColumns({"weekday": F.date_format("date_dt", "EEEE"), "season": season_of(c("date_dt"))})
    dates = add_features(dates, ["season", "weekday"], ["date_dt"], {"weekday_count": running_count(1)}, **size)
    dates = add_features(dates, [], ["date_dt"], {"_next": Lead("weekday_count")}, **size)
    early = c("weekday").isin("Saturday", "Thursday")
    return dates.withColumn("week", F.when(early, c("_next")).otherwise(c("weekday_count"))).drop("_next")


def odds_table(lines: DataFrame, order: list[str], **size) -> DataFrame:
    """Two moneyline rows per game (away first) to one row with margin-free probability and game id.

    ``lines``: year, date (mmdd as a number), team, ml and the order columns.
    """
    rows = pair_rows(lines, order, "pair", floor=size.get("floor"))
    seq = F.struct(*order)
    games = rows.groupBy("pair").agg(
        F.min_by("year", seq).alias("year"),
        F.min_by("date", seq).alias("date"),
        F.min_by("team", seq).alias("away_team"),
        F.max_by("team", seq).alias("home_team"),
        F.min_by("ml", seq).alias("away_ml"),
        F.max_by("ml", seq).alias("home_ml"),
    )
    games = settle(games)  # read for the games and for their dates
    away, home = moneyline_probability(c("away_ml")), moneyline_probability(c("home_ml"))
    games = games.withColumns(
        {"date_dt": game_date(c("year"), c("date")), "home_win_proba_no_vig": without_margin(home, away)}
    )
    weeks = week_numbers(settle(games.select("date_dt").distinct()), **size).select("date_dt", "season", "week")
    games = games.join(weeks, ["date_dt"], "left")
    game_id = build_game_id(c("season"), c("week"), c("away_team"), c("home_team"))
    return games.select(game_id.alias("game_id"), "away_team", "home_team", "home_ml", "home_win_proba_no_vig")

