"""Feature queries: rolling player and team features, starters, model tables, odds."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.operators import aggregates as A
from yardline.plans import builders as B
from yardline.plans import features as X
from yardline.plans import schedule
from yardline.queries.builders import processed
from yardline.queries.registry import Tables, query
from yardline.queries.scalars import probability_sql
from yardline.queries.views import GAME_ORDER, ewm, span, tidy
from yardline.queries.windows import WEEKS_SQL

c = F.col
QB_COLUMNS = ["game_id", "player_id", "starting_qb", "att", "dk_points", "rolling_pass_attempts", "rolling_pass_yards",
              "rolling_air_yards", "rolling_ints", "rolling_pass_tds", "rolling_rush_att", "rolling_rush_yds",
              "rolling_epa_total", "rolling_pass_epa", "rolling_dk_points", "rolling_pass_success", "rolling_rush_tds",
              "rolling_rush_att_share"]


def receivers(t: Tables):
    return X.receiver_frame(t.snaps, t.depth, X.score_receivers(B.receiving(t.plays)))


def rushers(t: Tables):
    return B.with_time(X.score_rushers(B.rushing(t.plays)))


def qb_frame(t: Tables):
    return X.qb_rolling(B.qb_games(processed(t)), min_att=5)


def team_lines(t: Tables):
    lines = t.games.select("game_id", "season", "week", "home_team", "away_team", "total_line", "spread_line",
                           F.explode(F.array("home_team", "away_team")).alias("team"))
    return lines


def starters(t: Tables):
    return X.starters(t.passers, t.games)


def starter_ewm(t: Tables):
    return X.starter_averages(starters(t))


_NEXT_GEN = """SELECT season, week, passer_player_id AS player_id, avg(air_yards) AS avg_intended_air_yards,
  avg(cpoe) AS completion_percentage_above_expectation FROM {plays} WHERE passer_player_id IS NOT NULL GROUP BY season, week, passer_player_id"""


@query("starters_next_gen", f"""
SELECT game_id, player_id, passing_yards, avg_intended_air_yards, completion_percentage_above_expectation
FROM starter_lines LEFT JOIN ({_NEXT_GEN.format(plays="plays")}) USING (season, week, player_id)""",
       "passing_yards avg_intended_air_yards completion_percentage_above_expectation")
def starters_next_gen(t: Tables):
    """Starters with the tracking numbers of their week, joined one to one."""
    tracking = t.spark.sql(_NEXT_GEN, plays=t.plays)
    rows = X.starters(t.passers, t.games, tracking)
    return rows.select("game_id", "player_id", "passing_yards", "avg_intended_air_yards", "completion_percentage_above_expectation")


@query("fantasy_points", """
SELECT 'pass' AS kind, game_id, player_id, dk_points, fd_points FROM qb_scored
UNION ALL SELECT 'rush', game_id, player_id, rush_dk_points, rush_fd_points FROM rush_scored
UNION ALL SELECT 'rec', game_id, player_id, rec_dk_points, rec_fd_points FROM rec_scored
UNION ALL SELECT 'kick', game_id, kicker_player_id, CAST(pats + fg_0_39 * 3 + fg_40_49 * 4 + fg_50_on * 5 AS DOUBLE),
  CAST(pats + fg_0_39 * 3 + fg_40_49 * 4 + fg_50_on * 5 AS DOUBLE) FROM kick_lines""", "dk_points fd_points")
def fantasy_points(t: Tables):
    plays = processed(t)

    def shape(df, kind, player, dk, fd):
        return df.select(F.lit(kind).alias("kind"), "game_id", c(player).alias("player_id"),
                         c(dk).alias("dk_points"), c(fd).alias("fd_points"))

    rows = shape(X.score_passers(B.qb_games(plays)), "pass", "player_id", "dk_points", "fd_points")
    rows = rows.unionByName(shape(X.score_rushers(B.rushing(t.plays)), "rush", "player_id", "rush_dk_points", "rush_fd_points"))
    rows = rows.unionByName(shape(X.score_receivers(B.receiving(t.plays)), "rec", "player_id", "rec_dk_points", "rec_fd_points"))
    kick = X.score_kickers(B.kicker_stats(plays))
    return rows.unionByName(shape(kick, "kick", "kicker_player_id", "kicker_dk_points", "kicker_fd_points"))


@query("qb_rolling", f"SELECT {', '.join(QB_COLUMNS)} FROM qb_frame", " ".join(QB_COLUMNS[4:]))
def qb_rolling(t: Tables):
    return qb_frame(t).select(*QB_COLUMNS)


@query("team_rolling", f"""
WITH r AS (SELECT *, CASE WHEN home_team = team THEN away_team ELSE home_team END AS opp_team FROM team_lines)
SELECT game_id, team,
  CASE WHEN count(pass_yards) OVER w >= 6 THEN avg(pass_yards) OVER w END AS team_rolling_pass_yds,
  CASE WHEN count(rush_yards) OVER w >= 6 THEN avg(rush_yards) OVER w END AS team_rolling_run_yds,
  CASE WHEN count(opp_pass_yds) OVER o >= 6 THEN avg(opp_pass_yds) OVER o END AS opp_rolling_pass_yds,
  CASE WHEN count(opp_rush_yds) OVER o >= 6 THEN avg(opp_rush_yds) OVER o END AS opp_rolling_rush_yds FROM r
WINDOW w AS (PARTITION BY team ORDER BY {GAME_ORDER} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING),
       o AS (PARTITION BY opp_team ORDER BY {GAME_ORDER} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""",
       "team_rolling_pass_yds team_rolling_run_yds opp_rolling_pass_yds opp_rolling_rush_yds")
def team_rolling(t: Tables):
    rows = B.game_results(processed(t), t.games)
    attempts = t.plays.groupBy("game_id", c("posteam").alias("team")).agg(
        A.total("pass_attempt").alias("pass_attempt"), A.total("rush_attempt").alias("rush_attempt")
    )
    rows = rows.join(attempts, ["game_id", "team"], "left")
    rows = rows.withColumn("opp_team", X.opponent(c("team"), c("home_team"), c("away_team")))
    rows = X.team_rolling(rows, row_bound=t.play_rows)
    return rows.select("game_id", "team", "team_rolling_pass_yds", "team_rolling_run_yds", "opp_rolling_pass_yds",
                       "opp_rolling_rush_yds")


REC_OUT = ["game_id", "player_id", "team", "season", "week", "full_name", "position", "depth_team", "offense_pct",
           "targets", "rec", "air_yards", "yac", "rec_yards", "td", "target_share", "aDOT", "yrds_per_rec",
           "air_yards_share", "yac_per_rec", "rec_dk_points"]


@query("receiver_frame", f"SELECT {', '.join(REC_OUT)} FROM receivers".replace("aDOT", '"aDOT"'),
       "depth_team offense_pct target_share aDOT yrds_per_rec air_yards_share yac_per_rec rec_dk_points")
def receiver_frame(t: Tables):
    return receivers(t).select(*REC_OUT)


ROLL_OUT = ["rolling_targets", "rolling_receptions", "rolling_air_yards", "rolling_rec_yards", "rolling_target_share",
            "rolling_td", "rolling_rec_dk_points", "rolling_aDOT"]


@query("receiver_rolling", f"SELECT game_id, player_id, {', '.join(ROLL_OUT)} FROM receivers_rolling".replace(
    "rolling_aDOT", '"rolling_aDOT"'), " ".join(ROLL_OUT))
def receiver_rolling(t: Tables):
    return X.receiver_rolling(receivers(t)).select("game_id", "player_id", *ROLL_OUT)


RB_OUT = ["total_dk", "rolling_total_dk", "rolling_total_fd", "rolling_rush_att", "rolling_rush_yds", "rolling_rush_td",
          "rolling_rush_att_share", "rolling_rush_dk_pts", "rolling_targets", "rolling_td", "workload_rank",
          "rolling_snap_pct", "rolling_player_touches", "touch_diff", "rolling_workload", "workload_diff",
          "rolling_depth", "depth_diff", "team_rank_avg_touches"]


@query("rb_workload", f"SELECT game_id, player_id, team, player_touches, total_team_rb_touches, {', '.join(RB_OUT)} FROM rb_frame",
       " ".join(RB_OUT))
def rb_workload(t: Tables):
    rows = X.rb_workload(rushers(t), receivers(t))
    return rows.select("game_id", "player_id", "team", "player_touches", "total_team_rb_touches", *RB_OUT)


WR_OUT = ["rolling_targets", "target_workload", "rolling_snap_pct", "rolling_depth", "depth_diff",
          "team_rank_avg_workload", "rolling_sum_depth", "rolling_pos_depth_targets",
          "rolling_pos_depth_targets_no_shift", "rolling_depth_target_sum", "rolling_target_diff"]


@query("wr_depth_targets", f"""
SELECT game_id, player_id, team, position, position_targets, total_wr_te_targets, pos_depth_targets, {', '.join(WR_OUT)}
FROM wr_frame""", " ".join(WR_OUT))
def wr_depth_targets(t: Tables):
    rows = X.wr_depth_targets(X.receiver_rolling(receivers(t)))
    return rows.select("game_id", "player_id", "team", "position", "position_targets", "total_wr_te_targets",
                       "pos_depth_targets", *WR_OUT)


KICK_OUT = ["kicker_dk_points", "rolling_pat", "rolling_39", "rolling_49", "rolling_50", "rolling_dk_points", "rolling_fd_points"]


@query("kicker_rolling", f"SELECT game_id, kicker_player_id, team, {', '.join(KICK_OUT)} FROM kick_frame", " ".join(KICK_OUT))
def kicker_rolling(t: Tables):
    rows = X.kicker_rolling(B.with_time(B.kicker_stats(processed(t))))
    return rows.select("game_id", "kicker_player_id", "team", *KICK_OUT)


_DEF_WIN = f"OVER (PARTITION BY team ORDER BY {GAME_ORDER} ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING)"


@query("defense_points", f"""
WITH d AS (
  SELECT d.game_id, d.team, d.season, t.week, d.def_int, d.def_sack, t.opp_points,
         CAST(def_int * 2 + def_sack + safety * 2 + kick_blocked * 2 + def_td * 6
           + CASE WHEN opp_points <= 6 THEN 7 WHEN opp_points <= 13 THEN 4 WHEN opp_points <= 20 THEN 1
                  WHEN opp_points <= 27 THEN 0 WHEN opp_points <= 34 THEN -1 WHEN opp_points <= 100 THEN -4 ELSE 0 END AS DOUBLE)
           AS def_dk_pts, t.total_line / 2 + t.spread_line / 2 AS opp_implied_score
  FROM def_lines AS d LEFT JOIN (SELECT game_id, team, CAST(split_part(game_id, '_', 2) AS INT) AS week, opp_points,
    total_line, spread_line FROM team_lines) AS t USING (game_id, team))
SELECT game_id, team, def_dk_pts, opp_implied_score,
  CASE WHEN count(opp_points) {_DEF_WIN} >= 15 THEN avg(opp_points) {_DEF_WIN} END AS rolling_opp_points,
  CASE WHEN count(def_sack) {_DEF_WIN} >= 15 THEN avg(def_sack) {_DEF_WIN} END AS rolling_sack,
  CASE WHEN count(def_int) {_DEF_WIN} >= 15 THEN avg(def_int) {_DEF_WIN} END AS rolling_int,
  CASE WHEN count(def_dk_pts) {_DEF_WIN} >= 15 THEN avg(def_dk_pts) {_DEF_WIN} END AS rolling_dk_pts
FROM d""",
       "def_dk_pts opp_implied_score rolling_opp_points rolling_sack rolling_int rolling_dk_pts")
def defense_points(t: Tables):
    plays = processed(t)
    defence = B.with_time(B.defence_stats(plays))
    rows = X.defence_points(defence, B.game_results(plays, t.games), row_bound=t.play_rows)
    return rows.select("game_id", "team", "def_dk_pts", "opp_implied_score", "rolling_opp_points", "rolling_sack",
                       "rolling_int", "rolling_dk_pts")


_SPRIOR = f"OVER (PARTITION BY player_id ORDER BY {GAME_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("starter_share", f"""
SELECT game_id, player_id, recent_team, team_passing_yards, total_epa, frac_team_yards,
       CASE WHEN count(frac_team_yards) {_SPRIOR} = 0 THEN 1.0::DOUBLE
            ELSE CAST(count(*) FILTER (WHERE frac_team_yards > 0.95) {_SPRIOR} AS DOUBLE)
                 / row_number() OVER (PARTITION BY player_id ORDER BY {GAME_ORDER}) END AS expanding_team_frac
FROM starter_lines""", "team_passing_yards total_epa frac_team_yards expanding_team_frac")
def starter_share(t: Tables):
    return starters(t).select("game_id", "player_id", "recent_team", "team_passing_yards", "total_epa",
                              "frac_team_yards", "expanding_team_frac")


_G = f"OVER (ORDER BY {GAME_ORDER}, player_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_SHRUNK = f"""
WITH s AS (
  SELECT e.*, w.season_expanding_mean, row_number() OVER (PARTITION BY player_id ORDER BY {GAME_ORDER}) - 1 AS g,
         coalesce(avg(passing_epa) {_G}, 0.05) AS p_epa, coalesce(avg(attempts) {_G}, 40) AS p_att,
         coalesce(avg(rushing_epa) {_G}, -3.75) AS p_rush, coalesce(avg(total_epa) {_G}, 2) AS p_total,
         total_line / 2 - (CASE WHEN recent_team = home_team THEN -spread_line ELSE spread_line END) / 2 AS implied_points
  FROM starter_ewm AS e LEFT JOIN week_prior AS w USING (season, week)),
a AS (
  SELECT s.*, g / (g + 3.0::DOUBLE) * ewm_passing_yards + 3 / (g + 3.0::DOUBLE) * season_expanding_mean AS adj_ewm_passing_yards,
         g / (g + 3.0::DOUBLE) * ewm_passing_epa + 3 / (g + 3.0::DOUBLE) * p_epa AS adj_ewm_passing_epa,
         g / (g + 3.0::DOUBLE) * ewm_passing_attempts + 3 / (g + 3.0::DOUBLE) * p_att AS adj_ewm_passing_attempts,
         g / (g + 3.0::DOUBLE) * ewm_rushing_epa + 3 / (g + 3.0::DOUBLE) * p_rush AS adj_ewm_rushing_epa,
         g / (g + 1.0::DOUBLE) * ewm_total_epa + 1 / (g + 1.0::DOUBLE) * p_total AS adj_ewm_total_epa FROM s),
i AS (SELECT game_id, player_id, ewm_implied FROM {ewm('s', 'player_id', GAME_ORDER, {'ewm_implied': ('implied_points', 0.08)})})
SELECT game_id, player_id, g AS games_started, season_expanding_mean, adj_ewm_passing_yards, adj_ewm_passing_epa,
       adj_ewm_passing_attempts, adj_ewm_rushing_epa, adj_ewm_total_epa,
       adj_ewm_passing_yards / nullif(adj_ewm_passing_attempts, 0) AS adj_ewm_py_per_att,
       CASE WHEN g = 0 THEN 0 ELSE regr_slope(adj_ewm_passing_yards, CAST(g AS DOUBLE)) OVER (PARTITION BY player_id
         ORDER BY {GAME_ORDER} ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) END AS local_trend_ewm25,
       implied_points, coalesce(ewm_implied, 22) AS ewm_implied_points,
       implied_points - coalesce(ewm_implied, 22) AS implied_points_diff
FROM a JOIN i USING (game_id, player_id)"""
SHRUNK_OUT = ["season_expanding_mean", "adj_ewm_passing_yards", "adj_ewm_passing_epa", "adj_ewm_passing_attempts",
              "adj_ewm_rushing_epa", "adj_ewm_total_epa", "adj_ewm_py_per_att", "local_trend_ewm25", "implied_points",
              "ewm_implied_points", "implied_points_diff"]


@query("shrunk_ewm", _SHRUNK, " ".join(SHRUNK_OUT))
def shrunk_ewm(t: Tables):
    return X.shrunk_ewm(starter_ewm(t)).select("game_id", "player_id", "games_started", *SHRUNK_OUT)


_STARTED = """(SELECT e.*, w.season_expanding_mean, CASE WHEN home_team = recent_team THEN away_team ELSE home_team END AS defteam
  FROM starter_ewm AS e LEFT JOIN week_prior AS w USING (season, week))"""


@query("opp_def_ewm", f"""
SELECT game_id, player_id, defteam, coalesce(d, season_expanding_mean) AS defteam_ewm_passing_yards,
       week / (week + 7.0::DOUBLE) * coalesce(d, season_expanding_mean) + 7 / (week + 7.0::DOUBLE) * season_expanding_mean
         AS adj_def_ewm_py
FROM {ewm(_STARTED, 'defteam', GAME_ORDER + ', player_id', {'d': ('passing_yards', 0.052)})}""",
       "defteam_ewm_passing_yards adj_def_ewm_py")
def opp_def_ewm(t: Tables):
    rows = starter_ewm(t)
    weeks = X.week_means(rows).select("season", "week", "season_expanding_mean")
    rows = X.opponent_defence(rows.join(weeks, ["season", "week"], "left"))
    return rows.select("game_id", "player_id", "defteam", "defteam_ewm_passing_yards", "adj_def_ewm_py")


_DEF_EPA = """(SELECT game_id, defteam AS team, season, week, coalesce(sum(epa) FILTER (WHERE pass_attempt = 1), 0) AS def_pass_epa
  FROM plays GROUP BY game_id, defteam, season, week)"""
MODEL_OUT = ["dk_points", "spread_line", "rolling_pass_def_epa", "rolling_pass_tds", "rolling_dk_points", "rolling_rush_tds"]


@query("model_table", f"""
WITH d AS (SELECT * FROM {ewm(_DEF_EPA, 'team', GAME_ORDER, {'rolling_pass_def_epa': ('def_pass_epa', span(15))})}),
q AS (SELECT f.*, g.spread_line, d.rolling_pass_def_epa, count(*) OVER (PARTITION BY starting_qb) AS n
      FROM (SELECT *, CASE WHEN home_team = team THEN away_team ELSE home_team END AS opp FROM qb_frame WHERE season >= 2016) AS f
      JOIN games AS g USING (game_id) LEFT JOIN d ON d.game_id = f.game_id AND d.team = f.opp)
SELECT game_id, player_id, starting_qb, {tidy('dk_points', 3)} AS dk_points, {tidy('-spread_line', 3)} AS spread_line,
       {', '.join(f'{tidy(n, 3)} AS {n}' for n in MODEL_OUT[2:])} FROM q WHERE n >= 6 AND dk_points > 0""",
       " ".join(MODEL_OUT))
def model_table(t: Tables):
    """Passer model table: rolling features with the opposing defence's recent EPA allowed."""
    allowed = t.plays.groupBy("game_id", c("defteam").alias("team")).agg(
        A.total_where(c("pass_attempt") == 1, "epa").alias("def_pass_epa")
    )
    lines = t.games.select("game_id", "spread_line")
    teams = B.with_time(allowed).join(lines, ["game_id"])
    return X.qb_model_table(qb_frame(t), teams).select("game_id", "player_id", "starting_qb", *MODEL_OUT)


WR_MODEL = ["rec_dk_points", "last_game_dk", "rolling_targets", "rolling_snap_pct", "total_line", "spread_line"]


def _receiver_model_sql(position: str) -> str:
    return f"""
WITH f AS (SELECT w.*, count(*) OVER (PARTITION BY player_id) AS n FROM wr_frame AS w WHERE season >= 2016),
k AS (SELECT f.*, g.total_line, g.spread_line FROM f JOIN games AS g USING (game_id)
      WHERE n >= 4 AND position = '{position}' AND rolling_targets IS NOT NULL AND rolling_snap_pct IS NOT NULL),
z AS (SELECT k.*, (offense_pct - avg(offense_pct) OVER (PARTITION BY player_id))
        / nullif(stddev_samp(offense_pct) OVER (PARTITION BY player_id), 0) AS z FROM k),
l AS (SELECT z.*, lag(rec_dk_points) OVER (PARTITION BY player_id ORDER BY {GAME_ORDER}) AS last_game_dk
      FROM z WHERE z > -2 AND depth_team = 1)
SELECT game_id, player_id, {', '.join(WR_MODEL)} FROM l
WHERE last_game_dk IS NOT NULL AND rec_fd_points IS NOT NULL AND team_air_yards IS NOT NULL
  AND rolling_pos_depth_targets IS NOT NULL AND rolling_target_diff IS NOT NULL AND "rolling_aDOT" IS NOT NULL
  AND depth_diff IS NOT NULL AND rolling_sum_depth IS NOT NULL AND team_rank_avg_workload IS NOT NULL"""


def _receiver_model(t: Tables, position: str):
    rec = X.wr_depth_targets(X.receiver_rolling(receivers(t)))
    rows = X.receiver_model_table(rec, team_lines(t), position)
    return rows.select("game_id", "player_id", *WR_MODEL)


@query("model_table_wr", _receiver_model_sql("WR"), " ".join(WR_MODEL))
def model_table_wr(t: Tables):
    return _receiver_model(t, "WR")


@query("model_table_te", _receiver_model_sql("TE"), " ".join(WR_MODEL))
def model_table_te(t: Tables):
    return _receiver_model(t, "TE")


RB_MODEL = ["total_dk", "rolling_target_share", "rolling_targets", "rolling_td", "rolling_rush_td",
            "rolling_rush_att_share", "rolling_snap_pct", "total_line", "spread_line"]


@query("model_table_rb", f"""
WITH f AS (SELECT r.*, count(*) OVER (PARTITION BY player_id) AS n FROM rb_frame AS r WHERE season >= 2016),
k AS (SELECT f.*, g.spread_line FROM f JOIN games AS g USING (game_id) WHERE n >= 3 AND rolling_targets IS NOT NULL
      AND rolling_rush_td IS NOT NULL AND total_dk IS NOT NULL AND depth_diff IS NOT NULL AND rolling_snap_pct IS NOT NULL),
z AS (SELECT k.*, (offense_pct - avg(offense_pct) OVER (PARTITION BY player_id))
        / nullif(stddev_samp(offense_pct) OVER (PARTITION BY player_id), 0) AS z FROM k)
SELECT game_id, player_id, {', '.join(RB_MODEL)} FROM z WHERE z > -2 AND depth_team = 1 AND total_dk > 0""", " ".join(RB_MODEL))
def model_table_rb(t: Tables):
    rb = X.rb_workload(rushers(t), receivers(t), keep=X.BACK_MODEL_INPUTS)
    return X.back_model_table(rb, team_lines(t)).select("game_id", "player_id", *RB_MODEL)


K_MODEL = ["kicker_dk_points", "rolling_50", "rolling_49", "rolling_39", "rolling_pat", "rolling_dk_points",
           "total_line", "spread_line"]


@query("model_table_kicker", f"""
WITH f AS (SELECT k.*, count(*) OVER (PARTITION BY kicker_player_id) AS n FROM kick_frame AS k WHERE season >= 2014)
SELECT game_id, kicker_player_id, {', '.join(K_MODEL)}
FROM f JOIN (SELECT game_id, total_line, spread_line FROM games) AS g USING (game_id)
WHERE n >= 3 AND rolling_pat IS NOT NULL""", " ".join(K_MODEL))
def model_table_kicker(t: Tables):
    kickers = X.kicker_rolling(B.with_time(B.kicker_stats(processed(t))))
    return X.kicker_model_table(kickers, team_lines(t)).select("game_id", "kicker_player_id", *K_MODEL)


@query("home_advantage", """
SELECT season, avg(m) AS mean, stddev_pop(m) / sqrt(count(m)) AS se, avg(m) - 2 * stddev_pop(m) / sqrt(count(m)) AS low,
       avg(m) + 2 * stddev_pop(m) / sqrt(count(m)) AS high, avg(CASE WHEN m > 0 THEN 1 ELSE 0 END) AS home_win_rate
FROM (SELECT season, home_score - away_score AS m FROM games) GROUP BY season""", "mean se low high home_win_rate")
def home_advantage(t: Tables):
    return schedule.home_advantage(t.games)


LINES_SQL = """
SELECT CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) <= 2 THEN 1 ELSE 0 END AS INT) AS year,
       CAST(month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS date, o_orderkey AS seq, s.side,
       concat('T', CAST((o_custkey + s.side) % 32 AS VARCHAR)) AS team,
       CAST(CASE WHEN (o_orderkey + s.side) % 2 = 0 THEN 105 + o_custkey % 200 ELSE -105 - o_custkey % 200 END AS INT) AS ml,
       CAST(o_orderdate AS DATE) AS d
FROM orders, (SELECT 0 AS side UNION ALL SELECT 1) AS s"""


@query("odds_table", f"""
WITH lines AS ({LINES_SQL}),
weeks AS ({WEEKS_SQL.format(date='d', table='lines')}),
g AS (
  SELECT seq, d, max(CASE WHEN side = 0 THEN team END) AS away_team, max(CASE WHEN side = 1 THEN team END) AS home_team,
         max(CASE WHEN side = 0 THEN ml END) AS away_ml, max(CASE WHEN side = 1 THEN ml END) AS home_ml
  FROM lines GROUP BY seq, d),
p AS (SELECT g.*, {probability_sql('away_ml')} AS a, {probability_sql('home_ml')} AS h FROM g)
SELECT concat_ws('_', CAST(season AS VARCHAR), CASE WHEN week < 10 THEN '0' || week ELSE CAST(week AS VARCHAR) END,
         away_team, home_team) AS game_id, away_team, home_team, home_ml, h / (h + a) AS home_win_proba_no_vig
FROM p JOIN weeks USING (d)""", "home_win_proba_no_vig")
def odds_table(t: Tables):
    """Two consecutive moneyline rows per order date (away first) to one row per game."""
    month, day, key = F.month("o_orderdate"), F.dayofmonth("o_orderdate"), c("o_orderkey")
    side = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", side)
    size = c("o_custkey") % 200
    lines = rows.select(
        (F.year("o_orderdate") - F.when(month <= 2, 1).otherwise(0)).alias("year"),
        (month * 100 + day).alias("date"),
        key.alias("seq"),
        "side",
        F.concat(F.lit("T"), ((c("o_custkey") + c("side")) % 32).cast("string")).alias("team"),
        F.when((key + c("side")) % 2 == 0, 105 + size).otherwise(-105 - size).cast("int").alias("ml"),
    )
    return schedule.odds_table(lines, ["seq", "side"])
