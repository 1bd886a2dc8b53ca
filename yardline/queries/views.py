"""Reference SQL for the checking engine: builder results as views other statements can name, and text
helpers for features its SQL dialect has no function for."""

from __future__ import annotations

import re

from yardline.functions.scalars import ERF, ERF_SCALE
from yardline.queries import adapters


def isum(expr: str, where: str | None = None) -> str:
    """Integer sum, 0 for no values."""
    cond = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(coalesce(sum({expr}){cond}, 0) AS BIGINT)"


def dsum(expr: str, where: str | None = None) -> str:
    cond = f" FILTER (WHERE {where})" if where else ""
    return f"coalesce(sum({expr}){cond}, 0)"


def half_even(expr: str, places: int) -> str:
    scale = 10**places
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def ewm(src: str, keys: str, order: str, feats: dict[str, tuple[str, float]], shift: bool = True) -> str:
    """Exponentially weighted means as a self-join on row numbers, weights (1 - alpha)^distance."""
    ks = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"a.{k} = b.{k}" for k in ks)
    cols = []
    for name, (col, alpha) in feats.items():
        w = f"pow({1 - alpha!r}, a.rn - b.rn)"
        cols.append(f"sum(b.{col} * {w}) / sum(CASE WHEN b.{col} IS NOT NULL THEN {w} END) AS {name}")
    on = "b.rn < a.rn" if shift else "b.rn <= a.rn"
    group = ", ".join(f"a.{k}" for k in [*ks, "rn"])
    using = ", ".join([*ks, "rn"])
    return f"""(
  WITH r AS (SELECT s.*, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {src} AS s),
  e AS (SELECT {group}, {", ".join(cols)} FROM r AS a LEFT JOIN r AS b ON {same} AND {on} GROUP BY {group})
  SELECT r.* EXCLUDE (rn), {", ".join("e." + f for f in feats)} FROM r JOIN e USING ({using}))"""


def span(n: float) -> float:
    return 2 / (n + 1)


def normal_sql(z: str) -> str:
    """The same approximation as ``normal_cdf``."""
    t = f"(1 / (1 + {ERF_SCALE} * abs({z}) / sqrt(2)))"
    poly = "0.0::DOUBLE"
    for a in reversed(ERF):
        poly = f"(({poly} + {a}) * {t})"
    half = f"({poly} * exp(-({z}) * ({z}) / 2) / 2)"
    return f"CASE WHEN {z} < 0 THEN {half} ELSE 1 - {half} END"


PLAY_ORDER = "play_seq, play_tie"
GAME_ORDER = "season, week, game_id"

VIEWS: dict[str, str] = dict(adapters.VIEWS)

VIEWS["processed"] = f"""
SELECT p.* REPLACE (
         -spread_line AS spread_line,
         CASE two_point_conv_result WHEN 'success' THEN 1 WHEN 'failure' THEN 0 END AS two_point_conv_result,
         CASE WHEN field_goal_result = 'made' THEN 1 ELSE 0 END AS field_goal_result,
         CASE WHEN extra_point_result = 'good' THEN 1 ELSE 0 END AS extra_point_result,
         CASE WHEN two_point_attempt = 1 THEN 'two_point_att' ELSE play_type END AS play_type,
         CASE WHEN blocked_player_name IS NULL THEN 0 ELSE 1 END AS blocked_player_name),
       CAST(year(game_date) AS INT) AS year,
       air_yards - ydstogo AS air_yards_to_sticks,
       coalesce(game_seconds_remaining - lead(game_seconds_remaining) OVER
         (PARTITION BY game_id ORDER BY {PLAY_ORDER}), 0) AS time_between,
       CASE WHEN play_type = 'field_goal' AND two_point_attempt = 0 AND kick_distance <= 39 THEN 1 ELSE 0 END AS fg_0_39,
       CASE WHEN play_type = 'field_goal' AND two_point_attempt = 0 AND kick_distance >= 40 AND kick_distance <= 49
            THEN 1 ELSE 0 END AS fg_40_49,
       CASE WHEN play_type = 'field_goal' AND two_point_attempt = 0 AND kick_distance >= 50 THEN 1 ELSE 0 END AS fg_50_on
FROM plays AS p
"""

_THROW = "pass_attempt = 1 AND play_type <> 'two_point_att' AND sack = 0"
VIEWS["qb_lines"] = f"""
SELECT s.* REPLACE (
         CASE WHEN strpos(player, '.') > 0
              THEN concat(split_part(player, '.', 1), '.', ltrim(split_part(player, '.', 2))) ELSE player END AS player),
       td.touchdown,
       {half_even(ratio("com", "att + sack"), 3)} * 100 AS comp_perc,
       {half_even(ratio("ay_completions", "com"), 1)} AS avg_ay_comp,
       {half_even(ratio("ay_incompletions", "att + sack - com"), 1)} AS avg_ay_incomp,
       {half_even(ratio("epa", "att + sack"), 3)} AS epa_per_dropback
FROM (
  SELECT game_id, passer_player_name AS player, posteam AS team,
         arg_min(passer_player_id, ({PLAY_ORDER})) FILTER (WHERE {_THROW}) AS player_id,
         arg_min(season_type, ({PLAY_ORDER})) FILTER (WHERE {_THROW}) AS season_type,
         max(home_team) AS home_team, max(away_team) AS away_team,
         {isum("pass_attempt", _THROW)} AS att, {isum("complete_pass", _THROW)} AS com,
         {isum("yards_gained", _THROW)} AS pass_yards, {isum("air_yards", _THROW)} AS air_yards,
         {isum("yards_after_catch", _THROW)} AS yards_after_catch,
         {isum("air_yards_to_sticks", _THROW)} AS "AYTS", {isum("interception", _THROW)} AS interception,
         {isum("success", _THROW)} AS success, {dsum("epa", _THROW)} AS epa, {dsum("cpoe", _THROW)} / 100 AS cpoe,
         max(total_line) FILTER (WHERE {_THROW}) AS total_line, max(temp) FILTER (WHERE {_THROW}) AS temp,
         max(wind) FILTER (WHERE {_THROW}) AS wind, {isum("sack")} AS sack,
         CASE WHEN count(*) FILTER (WHERE complete_pass = 1) > 0 THEN {isum("air_yards", "complete_pass = 1")} END
           AS ay_completions,
         CASE WHEN count(*) FILTER (WHERE complete_pass = 0 AND play_type <> 'two_point_att') > 0
              THEN {isum("air_yards", "complete_pass = 0 AND play_type <> 'two_point_att'")} END AS ay_incompletions
  FROM processed WHERE passer_player_name IS NOT NULL
  GROUP BY game_id, passer_player_name, posteam HAVING count(*) FILTER (WHERE {_THROW}) > 0) AS s
LEFT JOIN (
  SELECT game_id, passer_player_id AS player_id, {isum("touchdown")} AS touchdown
  FROM processed WHERE {_THROW} AND interception = 0 GROUP BY game_id, passer_player_id) AS td
USING (game_id, player_id)
"""

VIEWS["rush_lines"] = f"""
SELECT s.*, {half_even(ratio("rush_yds", "rush_att"), 1)} AS rush_yds_per_att,
       {half_even(ratio("success", "rush_att"), 3)} AS success_perc,
       {half_even(ratio("rush_att", "team_rush_atts"), 2)} AS rush_att_share
FROM (
  SELECT t.*, CAST(sum(rush_att) OVER (PARTITION BY game_id, team) AS BIGINT) AS team_rush_atts
  FROM (
    SELECT game_id, rusher_player_id AS player_id, posteam AS team, {isum("rush_attempt")} AS rush_att,
           arg_min(rusher_player_name, ({PLAY_ORDER})) AS player, {isum("yards_gained")} AS rush_yds,
           {isum("success")} AS success, {isum("touchdown")} AS rush_td, avg(total_line) AS total_line,
           {dsum("epa")} AS rush_epa, {isum("fumble_lost")} AS fumbles,
           max(home_team) AS home_team, max(away_team) AS away_team
    FROM plays WHERE rush_attempt = 1 GROUP BY game_id, rusher_player_id, posteam) AS t) AS s
"""

VIEWS["rec_lines"] = f"""
SELECT s.* EXCLUDE (n), {half_even(ratio("targets", "n"), 3)} * 100 AS target_share,
       {ratio("air_yards", "targets")} AS "aDOT", {half_even(ratio("rec_yards", "rec"), 1)} AS yrds_per_rec,
       {half_even(ratio("air_yards", "team_air_yards"), 3)} * 100 AS air_yards_share,
       {half_even(ratio("yac", "rec"), 1)} AS yac_per_rec
FROM (
  SELECT t.*, sum(targets) OVER (PARTITION BY game_id, team) AS n,
         CAST(sum(air_yards) OVER (PARTITION BY game_id, team) AS BIGINT) AS team_air_yards
  FROM (
    SELECT game_id, receiver_player_id AS player_id, posteam AS team, min(receiver_player_name) AS player,
           count(pass_attempt) AS targets, {isum("complete_pass")} AS rec, {isum("air_yards")} AS air_yards,
           {isum("yards_after_catch")} AS yac, {isum("yards_gained")} AS rec_yards, {isum("touchdown")} AS td
    FROM plays WHERE qb_dropback = 1 AND receiver_player_id IS NOT NULL
    GROUP BY game_id, receiver_player_id, posteam) AS t) AS s
"""

VIEWS["kick_lines"] = f"""
SELECT game_id, kicker_player_id, min(kicker_player_name) AS player, min(posteam) AS team,
       {isum("field_goal_result")} AS fgs, {isum("extra_point_result")} AS pats, {isum("fg_0_39")} AS fg_0_39,
       {isum("fg_40_49")} AS fg_40_49, {isum("fg_50_on")} AS fg_50_on
FROM processed
WHERE play_desc LIKE '%GOOD%' AND play_type IN ('field_goal', 'extra_point') AND kicker_player_id IS NOT NULL
GROUP BY game_id, kicker_player_id
"""

VIEWS["def_lines"] = f"""
SELECT game_id, defteam AS team, {isum("interception")} AS def_int, min(season) AS season,
       {isum("return_touchdown")} AS def_td, {isum("fumble_lost")} AS fumble_lost, {isum("sack")} AS def_sack,
       {isum("safety")} AS safety, {isum("blocked_player_name")} AS kick_blocked
FROM processed WHERE play_desc IS NULL OR play_desc NOT LIKE '%Aborted%' GROUP BY game_id, defteam
"""

VIEWS["opp_lines"] = """
SELECT game_id, defteam AS team,
       CAST(sum(yards_gained) FILTER (WHERE pass_attempt = 1) AS BIGINT) AS opp_pass_yds,
       CAST(sum(yards_gained) FILTER (WHERE rush_attempt = 1) AS BIGINT) AS opp_rush_yds
FROM plays WHERE pass_attempt = 1 OR rush_attempt = 1 GROUP BY game_id, defteam
"""

VIEWS["team_lines"] = f"""
WITH yards AS (
  SELECT game_id, posteam AS team, CAST(sum(yards_gained) FILTER (WHERE pass_attempt = 1) AS BIGINT) AS pass_yards,
         CAST(sum(yards_gained) FILTER (WHERE rush_attempt = 1) AS BIGINT) AS rush_yards
  FROM plays GROUP BY game_id, posteam),
scores AS (
  SELECT game_id, posteam AS team, {isum("touchdown")} AS off_td, {isum("field_goal_result")} AS fgs,
         {isum("two_point_conv_result")} AS two_pts_conv
  FROM processed WHERE td_team = posteam GROUP BY game_id, posteam),
m AS (
  SELECT game_id, posteam AS team, max(year) AS year, max(season) AS season, max(week) AS week,
         max(season_type) AS season_type,
         max(home_team) AS home_team, max(away_team) AS away_team, max(home_score) AS home_score,
         max(away_score) AS away_score, max(spread_line) AS spread, max(total_line) AS total_line,
         CASE WHEN posteam = max(home_team) THEN 1 ELSE 0 END AS home
  FROM processed GROUP BY game_id, posteam)
SELECT m.* EXCLUDE (spread), CASE WHEN home = 1 THEN spread ELSE -spread END AS spread_line,
       m.away_score - m.home_score AS actual_spread,
       CASE WHEN home = 1 THEN m.home_score ELSE m.away_score END AS points,
       CASE WHEN home = 1 THEN m.away_score ELSE m.home_score END AS opp_points,
       m.home_score + m.away_score AS actual_total,
       CASE WHEN m.home_score + m.away_score > m.total_line THEN 1 ELSE 0 END AS over,
       yards.rush_yards, yards.pass_yards, o.opp_rush_yds, o.opp_pass_yds, off_td, fgs, two_pts_conv,
       g.home_rest, g.away_rest, g.home_coach, g.away_coach,
       CASE WHEN home = 1 THEN g.home_rest ELSE g.away_rest END AS rest,
       CASE WHEN home = 1 THEN g.away_rest ELSE g.home_rest END AS opp_rest,
       CASE WHEN home = 1 THEN g.home_coach ELSE g.away_coach END AS coach,
       CASE WHEN home = 1 THEN g.away_coach ELSE g.home_coach END AS opp_coach
FROM m LEFT JOIN yards USING (game_id, team) LEFT JOIN scores USING (game_id, team)
LEFT JOIN opp_lines AS o USING (game_id, team) LEFT JOIN games AS g USING (game_id)
"""

VIEWS["qb_scored"] = """
SELECT q.* REPLACE (coalesce(touchdown, 0) AS touchdown, coalesce(temp, 0) AS temp, coalesce(wind, 0) AS wind,
                    coalesce(ay_completions, 0) AS ay_completions, coalesce(ay_incompletions, 0) AS ay_incompletions,
                    coalesce(avg_ay_comp, 0) AS avg_ay_comp, coalesce(avg_ay_incomp, 0) AS avg_ay_incomp,
                    coalesce(comp_perc, 0) AS comp_perc),
       coalesce(r.rush_att, 0) AS rush_att, coalesce(r.rush_yds, 0) AS rush_yds, coalesce(r.fumbles, 0) AS fumbles,
       coalesce(r.rush_att_share, 0) AS rush_att_share, coalesce(r.rush_td, 0) AS rush_td,
       coalesce(r.rush_epa, 0) AS rush_epa,
       CAST(split_part(game_id, '_', 1) AS INT) AS season, CAST(split_part(game_id, '_', 2) AS INT) AS week,
       coalesce(q.touchdown, 0) * 4.0::DOUBLE + pass_yards * 0.04::DOUBLE - interception * 1.0::DOUBLE + coalesce(r.rush_td, 0) * 6.0::DOUBLE
         + coalesce(r.rush_yds, 0) * 0.1::DOUBLE - coalesce(r.fumbles, 0) * 1.0::DOUBLE
         + CASE WHEN pass_yards >= 300 THEN 3.0::DOUBLE ELSE 0 END
         + CASE WHEN coalesce(r.rush_yds, 0) >= 100 THEN 3.0::DOUBLE ELSE 0 END AS dk_points,
       coalesce(q.touchdown, 0) * 4.0::DOUBLE + pass_yards * 0.04::DOUBLE - interception * 1.0::DOUBLE + coalesce(r.rush_td, 0) * 6.0::DOUBLE
         + coalesce(r.rush_yds, 0) * 0.1::DOUBLE - coalesce(r.fumbles, 0) * 2.0::DOUBLE AS fd_points
FROM qb_lines AS q LEFT JOIN (
  SELECT game_id, player_id, rush_att, rush_yds, fumbles, rush_att_share, rush_td, rush_epa FROM rush_lines) AS r
USING (game_id, player_id)
"""

VIEWS["rush_scored"] = """
SELECT r.*, CAST(split_part(game_id, '_', 1) AS INT) AS season, CAST(split_part(game_id, '_', 2) AS INT) AS week,
       rush_yds * 0.1::DOUBLE + rush_td * 6 - fumbles + CASE WHEN rush_yds >= 100 THEN 3 ELSE 0 END AS rush_dk_points,
       rush_yds * 0.1::DOUBLE + rush_td * 6 - fumbles * 2 AS rush_fd_points
FROM rush_lines AS r
"""

VIEWS["rec_scored"] = """
SELECT r.*, CASE WHEN rec_yards >= 100 THEN 1 ELSE 0 END AS yds_100,
       rec_yards * 0.1::DOUBLE + td * 6 + rec + CASE WHEN rec_yards >= 100 THEN 3 ELSE 0 END AS rec_dk_points,
       rec_yards * 0.1::DOUBLE + td * 6 + rec * 0.5::DOUBLE AS rec_fd_points
FROM rec_lines AS r
"""

VIEWS["receivers"] = """
SELECT s.game_id, s.player_id, s.team, s.season, s.week, s.player AS full_name, d.position, d.depth_team,
       CASE WHEN s.season = 2021 THEN s.offense_pct * 100 ELSE s.offense_pct END AS offense_pct,
       coalesce(targets, 0) AS targets, coalesce(rec, 0) AS rec, coalesce(air_yards, 0) AS air_yards,
       coalesce(yac, 0) AS yac, coalesce(rec_yards, 0) AS rec_yards, coalesce(td, 0) AS td,
       coalesce(target_share, 0) AS target_share, coalesce("aDOT", 0) AS "aDOT",
       coalesce(yrds_per_rec, 0) AS yrds_per_rec, coalesce(air_yards_share, 0) AS air_yards_share,
       coalesce(yac_per_rec, 0) AS yac_per_rec, coalesce(yds_100, 0) AS yds_100,
       coalesce(rec_dk_points, 0) AS rec_dk_points, rec_fd_points, team_air_yards
FROM snaps AS s JOIN depth AS d USING (player_id, season, week)
LEFT JOIN rec_scored AS r USING (game_id, player_id, team)
WHERE s.offense_pct IS NOT NULL AND d.position IN ('RB', 'WR', 'TE')
"""

_REC_SPANS = {
    "rolling_targets": ("targets", 5), "rolling_receptions": ("rec", 10), "rolling_air_yards": ("air_yards", 12),
    "rolling_rec_yards": ("rec_yards", 12), "rolling_target_share": ("target_share", 4), "rolling_td": ("td", 12),
    "rolling_rec_dk_points": ("rec_dk_points", 12),
}
VIEWS["receivers_rolling"] = f"""
SELECT x.* REPLACE (coalesce(rolling_rec_dk_points, 0) AS rolling_rec_dk_points),
       avg("aDOT") OVER (PARTITION BY player_id ORDER BY {GAME_ORDER} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
         AS "rolling_aDOT"
FROM {ewm("receivers", "player_id", GAME_ORDER, {k: (v, span(n)) for k, (v, n) in _REC_SPANS.items()})} AS x
"""

VIEWS["starter_lines"] = f"""
WITH ids AS (
  SELECT p.*, coalesce(a.game_id, h.game_id) AS game_id
  FROM passers AS p
  LEFT JOIN games AS a ON a.season = p.season AND a.week = p.week AND a.away_team = p.recent_team
  LEFT JOIN games AS h ON h.season = p.season AND h.week = p.week AND h.home_team = p.recent_team),
w AS (
  SELECT i.*, sum(passing_yards) OVER (PARTITION BY season, week, recent_team) AS team_passing_yards FROM ids AS i)
SELECT w.*, g.home_team, g.away_team, g.spread_line, g.total_line, g.temp, g.wind,
       passing_epa + rushing_epa AS total_epa,
       passing_yards / nullif(team_passing_yards, 0) AS frac_team_yards
FROM w JOIN games AS g USING (game_id) WHERE player_id = g.home_qb_id OR player_id = g.away_qb_id
"""

_ST = {
    "ewm_passing_yards": ("passing_yards", 0.08), "ewm_passing_epa": ("passing_epa", 0.08),
    "ewm_rushing_epa": ("rushing_epa", 0.0425), "ewm_total_epa": ("total_epa", 0.08),
    "ewm_passing_attempts": ("attempts", 0.08), "ewm_pass_completions": ("completions", 0.08),
    "ewm_interceptions": ("interceptions", 0.13),
}
_medians = ",\n".join(
    f"coalesce({k}, (SELECT quantile_cont({v}, 0.5) FROM starter_lines)) AS {k}" for k, (v, _) in _ST.items()
)
VIEWS["starter_ewm"] = f"""
SELECT x.* REPLACE ({_medians}) FROM {ewm("starter_lines", "player_id", GAME_ORDER, _ST)} AS x
WHERE season_type = 'REG'
"""

VIEWS["week_prior"] = """
WITH m AS (SELECT season, week, avg(passing_yards) AS py FROM starter_ewm GROUP BY season, week),
e AS (SELECT season, week, avg(py) OVER (PARTITION BY season ORDER BY week
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS v FROM m)
SELECT season, week, coalesce(last_value(v IGNORE NULLS) OVER (ORDER BY season, week
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 250) AS season_expanding_mean
FROM e
"""


def tidy(expr: str, places: int) -> str:
    return half_even(f"round({expr}, 9)", places)


def average_rank(keys: str, col: str) -> str:
    """Descending rank with shared ties, from the plain rank and the size of the tie."""
    return (f"(rank() OVER (PARTITION BY {keys} ORDER BY {col} DESC) "
            f"+ (count(*) OVER (PARTITION BY {keys}, {col}) - 1) / 2.0::DOUBLE)")


_RB_BASE = """(
  SELECT r.game_id, r.player_id, r.team, r.player, r.season, r.week, r.rush_att, r.rush_yds, r.rush_td, r.rush_att_share,
         r.rush_dk_points, r.total_line, r.rush_dk_points + q.rec_dk_points AS total_dk,
         r.rush_fd_points + q.rec_fd_points AS total_fd_points, q.position, q.depth_team, q.offense_pct,
         coalesce(q.targets, 0) AS targets, coalesce(q.rec, 0) AS rec, coalesce(q.air_yards, 0) AS air_yards,
         coalesce(q.rec_yards, 0) AS rec_yards, coalesce(q.target_share, 0) AS target_share, coalesce(q.td, 0) AS td,
         coalesce(q.rec_dk_points, 0) AS rec_dk_points
  FROM rush_scored AS r LEFT JOIN receivers AS q USING (game_id, player_id))"""
_RB_FIRST = {
    "rolling_total_dk": ("total_dk", span(15)), "rolling_total_fd": ("total_fd_points", span(15)),
    "rolling_rush_att": ("rush_att", span(6)), "rolling_rush_yds": ("rush_yds", span(15)),
    "rolling_rush_td": ("rush_td", span(15)), "share_raw": ("rush_att_share", span(4)),
    "rolling_rush_dk_pts": ("rush_dk_points", span(15)),
} | {k: (v, span(n)) for k, (v, n) in _REC_SPANS.items()}
_RB_SECOND = f"""(
  SELECT x.*, rush_att + targets AS player_touches, {average_rank("game_id, team", "rush_att + targets")} AS workload_rank,
         CAST(sum(rush_att + targets) OVER (PARTITION BY game_id, team) AS BIGINT) AS total_team_rb_touches
  FROM {ewm(_RB_BASE, "player_id", GAME_ORDER, _RB_FIRST)} AS x WHERE position = 'RB')"""
_RB_PLAYER = {
    "snap_raw": ("offense_pct", span(4)), "touches_raw": ("player_touches", span(5)),
    "workload_raw": ("workload_rank", span(5)), "rolling_depth": ("depth_team", span(5)),
}
_RB_THIRD = ewm(_RB_SECOND, "player_id", GAME_ORDER, _RB_PLAYER)
VIEWS["rb_frame"] = f"""
SELECT y.* EXCLUDE (share_raw, snap_raw, touches_raw, workload_raw, slot_raw),
       {tidy("share_raw", 1)} * 100 AS rolling_rush_att_share, {tidy("snap_raw", 1)} AS rolling_snap_pct,
       {tidy("touches_raw", 1)} AS rolling_player_touches, {tidy("workload_raw", 1)} AS rolling_workload,
       {tidy("slot_raw", 1)} AS team_rank_avg_touches, {tidy("slot_raw", 1)} - {tidy("touches_raw", 1)} AS touch_diff,
       workload_rank - {tidy("workload_raw", 1)} AS workload_diff, {tidy("depth_team - rolling_depth", 3)} AS depth_diff
FROM {ewm(_RB_THIRD, "team, workload_rank", GAME_ORDER + ", player_id", {"slot_raw": ("player_touches", span(5))})} AS y
"""

_WR_ONE = f"""(
  SELECT x.*, CAST(sum(targets) OVER (PARTITION BY game_id, team, position) AS BIGINT) AS position_targets,
         CAST(sum(targets) OVER (PARTITION BY game_id, team) AS BIGINT) AS total_wr_te_targets,
         {average_rank("game_id, team", "targets")} AS target_workload,
         CAST(sum(targets) OVER (PARTITION BY game_id, team, position, depth_team) AS BIGINT) AS slot_targets
  FROM receivers_rolling AS x WHERE position IN ('WR', 'TE'))"""
_WR_TWO = ewm(_WR_ONE, "player_id", GAME_ORDER, {"rolling_snap_pct": ("offense_pct", span(4)), "rolling_depth": ("depth_team", span(5))})
_WR_THREE = ewm(_WR_TWO, "team", GAME_ORDER + ", player_id", {"work_raw": ("target_workload", span(5)), "sum_raw": ("slot_targets", span(5))})
_SLOTS = """(SELECT season, week, game_id, team, position, depth_team, max(slot_targets) AS pos_depth_targets,
                    coalesce(sum(rolling_targets), 0) AS players FROM three GROUP BY ALL)"""
VIEWS["wr_frame"] = f"""
WITH three AS (SELECT * FROM {_WR_THREE}),
shifted AS (SELECT * FROM {ewm(_SLOTS, "team, position, depth_team", GAME_ORDER, {"level": ("pos_depth_targets", span(5))})}),
current AS (SELECT * FROM {ewm(_SLOTS, "team, position, depth_team", GAME_ORDER, {"level_now": ("pos_depth_targets", span(5))}, shift=False)})
SELECT t.* EXCLUDE (work_raw, sum_raw, slot_targets, full_name), full_name AS player,
       {tidy("work_raw", 1)} AS team_rank_avg_workload, {tidy("sum_raw", 1)} AS rolling_sum_depth,
       s.pos_depth_targets, {tidy("s.level", 1)} AS rolling_pos_depth_targets,
       {tidy("n.level_now", 1)} AS rolling_pos_depth_targets_no_shift, {tidy("s.players", 1)} AS rolling_depth_target_sum,
       {tidy(tidy("s.level", 1) + " - " + tidy("s.players", 1), 1)} AS rolling_target_diff,
       {tidy("t.depth_team - rolling_depth", 3)} AS depth_diff
FROM three AS t JOIN shifted AS s USING (game_id, team, position, depth_team)
JOIN current AS n USING (game_id, team, position, depth_team)
"""

_KICK = """(SELECT k.*, CAST(split_part(game_id, '_', 1) AS INT) AS season, CAST(split_part(game_id, '_', 2) AS INT) AS week,
  CAST(pats + fg_0_39 * 3 + fg_40_49 * 4 + fg_50_on * 5 AS DOUBLE) AS kicker_dk_points,
  CAST(pats + fg_0_39 * 3 + fg_40_49 * 4 + fg_50_on * 5 AS DOUBLE) AS kicker_fd_points FROM kick_lines AS k)"""
_KICK_COLS = {"rolling_pat": "pats", "rolling_39": "fg_0_39", "rolling_49": "fg_40_49", "rolling_50": "fg_50_on",
              "rolling_dk_points": "kicker_dk_points", "rolling_fd_points": "kicker_fd_points"}
VIEWS["kick_frame"] = f"""
SELECT x.* REPLACE ({", ".join(f"{tidy(k, 2)} AS {k}" for k in _KICK_COLS)})
FROM {ewm(_KICK, "kicker_player_id, team", GAME_ORDER, {k: (v, span(15)) for k, v in _KICK_COLS.items()})} AS x
"""

_QB = """(SELECT q.*, CAST(success AS DOUBLE) / nullif(att, 0) AS pass_success_perc, epa + rush_epa AS total_epa FROM qb_scored AS q)"""
_QB_EWM = {
    "rolling_pass_attempts": ("att", 9), "rolling_pass_yards": ("pass_yards", 15), "rolling_air_yards": ("air_yards", 15),
    "rolling_ints": ("interception", 15), "rolling_pass_tds": ("touchdown", 15), "rolling_rush_att": ("rush_att", 15),
    "rolling_rush_yds": ("rush_yds", 15), "rolling_epa_total": ("total_epa", 15), "rolling_pass_epa": ("epa", 10),
    "rolling_dk_points": ("dk_points", 12),
}
_QB_WIN = f"OVER (PARTITION BY player ORDER BY {GAME_ORDER}, player_id ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING)"
VIEWS["qb_frame"] = f"""
SELECT * EXCLUDE (player), player AS starting_qb FROM (
  SELECT x.*, avg(pass_success_perc) {_QB_WIN} AS rolling_pass_success, avg(rush_td) {_QB_WIN} AS rolling_rush_tds,
         avg(rush_att_share) {_QB_WIN} AS rolling_rush_att_share
  FROM {ewm(_QB, "player", GAME_ORDER + ", player_id", {k: (v, span(n)) for k, (v, n) in _QB_EWM.items()})} AS x)
WHERE att >= 5
"""


def _named(sql: str) -> str:
    """Fill a view's placeholders with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def with_views(sql: str) -> str:
    """Prefix a statement with the views it mentions, directly or through another view."""
    needed: list[str] = []

    def visit(text: str, inside: tuple[str, ...]) -> None:
        for name in VIEWS:
            if name not in needed and name not in inside and re.search(rf"\b{name}\b", text):
                visit(_named(VIEWS[name]), (*inside, name))
                needed.append(name)

    visit(sql, ())
    body = sql.strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS (\n{_named(VIEWS[n]).strip()}\n)" for n in needed)
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
