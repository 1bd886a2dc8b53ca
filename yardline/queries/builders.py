"""Builder queries: plays to player-game, team-game and drive tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.plans import builders as B
from yardline.queries.registry import Tables, query
from yardline.queries.views import PLAY_ORDER, dsum, isum

c = F.col


def processed(t: Tables):
    return B.play_features(t.plays, row_bound=t.play_rows)


@query("play_features", """
SELECT game_id, play_seq, play_tie, year, CAST(game_date AS VARCHAR) AS game_date, two_point_conv_result,
       spread_line, field_goal_result, time_between, play_type, air_yards_to_sticks, season, blocked_player_name,
       fg_0_39, fg_40_49, fg_50_on, extra_point_result FROM processed""", "spread_line")
def play_features(t: Tables):
    names = ["game_id", "play_seq", "play_tie", "year", "two_point_conv_result", "spread_line", "field_goal_result",
             "time_between", "play_type", "air_yards_to_sticks", "season", "blocked_player_name", "fg_0_39",
             "fg_40_49", "fg_50_on", "extra_point_result"]
    return processed(t).select(*names, c("game_date").cast("string").alias("game_date"))


@query("qb_pass", "SELECT * FROM qb_lines",
       "epa cpoe total_line temp wind comp_perc avg_ay_comp avg_ay_incomp epa_per_dropback")
def qb_pass(t: Tables):
    return B.qb_pass(processed(t))


@query("rushing", "SELECT * FROM rush_lines", "total_line rush_epa rush_yds_per_att success_perc rush_att_share")
def rushing(t: Tables):
    return B.rushing(t.plays)


@query("receiving", "SELECT * FROM rec_lines", "target_share aDOT yrds_per_rec air_yards_share yac_per_rec")
def receiving(t: Tables):
    return B.receiving(t.plays)


@query("opp_yards", "SELECT * FROM opp_lines")
def opp_yards(t: Tables):
    return B.opponent_yards(t.plays)


@query("def_stats", "SELECT * FROM def_lines")
def def_stats(t: Tables):
    return B.defence_stats(processed(t))


@query("kicker_stats", "SELECT * FROM kick_lines")
def kicker_stats(t: Tables):
    return B.kicker_stats(processed(t))


@query("team_yards", """
SELECT game_id, posteam AS team, CAST(sum(yards_gained) FILTER (WHERE pass_attempt = 1) AS BIGINT) AS pass_yards,
       CAST(sum(yards_gained) FILTER (WHERE rush_attempt = 1) AS BIGINT) AS rush_yards
FROM plays WHERE pass_attempt = 1 OR rush_attempt = 1 GROUP BY game_id, posteam""")
def team_yards(t: Tables):
    return B.team_yards(t.plays)


@query("team_scores", f"""
SELECT game_id, posteam AS team, {isum('touchdown')} AS off_td, {isum('field_goal_result')} AS fgs,
       {isum('two_point_conv_result')} AS two_pts_conv FROM processed WHERE td_team = posteam GROUP BY game_id, posteam""")
def team_scores(t: Tables):
    return B.team_scores(processed(t))


@query("game_results", "SELECT * FROM team_lines", "spread_line total_line")
def game_results(t: Tables):
    return B.game_results(processed(t), t.games)


@query("drive_stats", f"""
WITH d AS (
  SELECT game_id, posteam AS team, drive, {isum('time_between')} AS poss_time, {isum('rush_attempt')} AS rush_attempt,
         {isum('pass_attempt')} AS pass_attempt, {isum('yards_gained')} AS yards_gained, {isum('interception')} AS int,
         {isum('fumble')} AS fumble, {isum('sack')} AS sack, {isum('success')} AS success, {dsum('epa')} AS epa,
         arg_min(score_differential, ({PLAY_ORDER})) AS score_diff_start,
         arg_max(score_differential_post, ({PLAY_ORDER})) AS score_diff_end
  FROM processed GROUP BY game_id, posteam, drive)
SELECT d.*, CASE WHEN score_diff_end - score_diff_start >= 6 THEN 1 ELSE 0 END AS td,
       CASE WHEN score_diff_end - score_diff_start = 3 THEN 1 ELSE 0 END AS fg,
       rush_attempt + pass_attempt AS total_plays FROM d""", "epa")
def drive_stats(t: Tables):
    return B.drive_stats(processed(t))


def _side(side: str, other: str) -> str:
    has = f"posteam = {side}_team"
    return f"""{isum('yards_gained', f"{has} AND play_type_nfl = 'RUSH'")} AS {side}_rush_yards,
       {dsum('epa', f"{has} AND play_type_nfl = 'RUSH'")} AS {side}_rush_epa,
       {isum('yards_gained', f"{has} AND play_type_nfl = 'PASS'")} AS {side}_pass_yards,
       {dsum('epa', f"{has} AND play_type_nfl = 'PASS'")} AS {side}_pass_epa,
       count(*) FILTER (WHERE posteam = {other}_team AND play_type_nfl = 'SACK') AS {side}_team_sacks"""


@query("game_stats", f"""
SELECT game_id, home_team, away_team, {_side('home', 'away')}, {_side('away', 'home')}
FROM plays WHERE season >= 2016 GROUP BY game_id, home_team, away_team ORDER BY game_id""",
       "home_rush_epa home_pass_epa away_rush_epa away_pass_epa")
def game_stats(t: Tables):
    return B.game_stats(t.plays)
