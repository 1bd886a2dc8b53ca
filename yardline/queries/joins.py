"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.functions import scalars as S
from yardline.operators import joins
from yardline.operators.windows import Ewm, add_features
from yardline.plans import schedule
from yardline.plans.builders import receiving, rushing, team_yards, with_time
from yardline.plans.features import GAME_ORDER
from yardline.queries.registry import Tables, query
from yardline.queries.views import ewm, span
from yardline.session import settle

c = F.col


@query("left_join", """
SELECT c.c_custkey, c_name, o_orderkey, o_totalprice FROM customer AS c LEFT JOIN orders ON o_custkey = c_custkey""",
       "o_totalprice")
def left_join(t: Tables):
    orders = t.orders.select(c("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return t.customer.select("c_custkey", "c_name").join(orders, ["c_custkey"], "left")


@query("inner_join_renamed", """
SELECT h.season, home_team, away_team, h.n AS n_x, a.n AS n_y FROM
  (SELECT season, home_team, count(*) AS n FROM games GROUP BY season, home_team) AS h
JOIN (SELECT season, away_team, count(*) AS n FROM games GROUP BY season, away_team) AS a
ON h.season = a.season AND home_team = away_team""")
def inner_join_renamed(t: Tables):
    home = t.games.groupBy("season", "home_team").agg(F.count(F.lit(1)).alias("n"))
    away = t.games.groupBy("season", "away_team").agg(F.count(F.lit(1)).alias("n"))
    return joins.join_renamed(home, away, {"season": "season", "home_team": "away_team"})


@query("left_join_suffix", """
SELECT game_id, player_id, r.team, r.player, r.rush_yds, q.team AS team_merged, q.player AS player_merged, q.rec_yards
FROM rush_lines AS r LEFT JOIN rec_lines AS q USING (game_id, player_id)""")
def left_join_suffix(t: Tables):
    rush = rushing(t.plays).select("game_id", "player_id", "team", "player", "rush_yds")
    rec = receiving(t.plays).select("game_id", "player_id", "team", "player", "rec_yards")
    return joins.join_suffixed(rush, rec, ["game_id", "player_id"])


@query("validated_join", """
SELECT o_orderkey, o_custkey AS c_custkey, c_name, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def validated_join(t: Tables):
    orders = t.orders.select("o_orderkey", c("o_custkey").alias("c_custkey"))
    return joins.validated_join(orders, t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_custkey"])


@query("broadcast_lookup", """
SELECT p.game_id, play_seq, play_tie, posteam, coalesce(home_coach, 'NA') AS coach
FROM plays AS p LEFT JOIN games AS g ON g.game_id = p.game_id AND g.home_team = p.posteam""")
def broadcast_lookup(t: Tables):
    """Lookup on a composite key; Spark broadcasts the table when its measured size allows."""
    dim = t.games.select("game_id", c("home_team").alias("posteam"), "home_coach")
    rows = t.plays.select("game_id", "play_seq", "play_tie", "posteam")
    return joins.lookup(rows, dim, ["game_id", "posteam"], "home_coach", "coach", "NA").drop("home_coach")


@query("priority_lookup", """
SELECT season, week, player_id, recent_team, coalesce(a.game_id, h.game_id, 'NA') AS game_id FROM passers AS p
LEFT JOIN (SELECT season, week, away_team AS recent_team, game_id FROM games) AS a USING (season, week, recent_team)
LEFT JOIN (SELECT season, week, home_team AS recent_team, game_id FROM games) AS h USING (season, week, recent_team)""")
def priority_lookup(t: Tables):
    home = t.games.select("season", "week", c("home_team").alias("recent_team"), "game_id")
    away = t.games.select("season", "week", c("away_team").alias("recent_team"), "game_id")
    rows = t.passers.select("season", "week", "player_id", "recent_team")
    return joins.priority_lookup(rows, away, home, ["season", "week", "recent_team"], "game_id", "game_id", "NA")


@query("value_map", """
SELECT game_id, CASE referee WHEN 'Adrian Hall' THEN 'Adrian Hill' WHEN 'Bill Vinocich' THEN 'Bill Vinovich'
         WHEN 'Gene Stetatore' THEN 'Gene Steratore' WHEN 'John Perry' THEN 'John Parry' ELSE referee END AS referee,
       stadium, CASE roof WHEN 'dome' THEN 1 WHEN 'outdoors' THEN 0 END AS indoors,
       CASE referee WHEN 'Jerome Boger' THEN 'JB' END AS short FROM games""")
def value_map(t: Tables):
    rows = schedule.clean_schedule(t.games)
    return rows.select(
        "game_id", "referee", "stadium", S.map_value(c("roof"), {"dome": 1, "outdoors": 0}).alias("indoors"),
        S.map_value(c("referee"), {"Jerome Boger": "JB"}).alias("short"),
    )


_ALLOWED = """(SELECT p.game_id, p.defteam AS team, CAST(split_part(p.game_id, '_', 1) AS INT) AS season,
  CAST(split_part(p.game_id, '_', 2) AS INT) AS week, CAST(sum(yards_gained) AS BIGINT) AS allowed
  FROM plays AS p GROUP BY p.game_id, p.defteam)"""


@query("opponent_join", f"""
WITH d AS (SELECT * FROM {ewm(_ALLOWED, "team", "season, week, game_id", {"rolling_allowed": ("allowed", span(15))})})
SELECT y.game_id, y.team, y.pass_yards, CASE WHEN g.home_team = y.team THEN g.away_team ELSE g.home_team END AS opp_team,
       d.rolling_allowed
FROM (SELECT game_id, posteam AS team, CAST(sum(yards_gained) FILTER (WHERE pass_attempt = 1) AS BIGINT) AS pass_yards
      FROM plays WHERE pass_attempt = 1 OR rush_attempt = 1 GROUP BY game_id, posteam) AS y
LEFT JOIN games AS g ON g.game_id = y.game_id
LEFT JOIN d ON d.game_id = y.game_id
  AND d.team = CASE WHEN g.home_team = y.team THEN g.away_team ELSE g.home_team END""", "rolling_allowed")
def opponent_join(t: Tables):
    """A team's yards beside what its opponent's defence had been allowing."""
    allowed = t.plays.groupBy("game_id", c("defteam").alias("team")).agg(F.sum("yards_gained").alias("allowed"))
    feats = {"rolling_allowed": Ewm("allowed", span=15)}
    defence = add_features(settle(with_time(allowed)), ["team"], GAME_ORDER, feats)
    own = team_yards(t.plays).join(t.games.select("game_id", "home_team", "away_team"), ["game_id"], "left")
    out = joins.opponent_join(own, defence, ["rolling_allowed"])
    return out.select("game_id", "team", "opp_team", "pass_yards", "rolling_allowed")
