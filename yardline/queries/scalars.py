"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.functions import scalars as S
from yardline.plans import schedule
from yardline.queries.registry import Tables, query
from yardline.queries.rows import unpivot_sql

c = F.col


@query("game_id_parts", """
SELECT game_id, CAST(split_part(game_id, '_', 1) AS INT) AS season, CAST(split_part(game_id, '_', 2) AS INT) AS week,
       split_part(game_id, '_', 3) AS away, split_part(game_id, '_', 4) AS home FROM games""")
def game_id_parts(t: Tables):
    p = [S.id_part(c("game_id"), i) for i in range(4)]
    return t.games.select("game_id", p[0].cast("int").alias("season"), p[1].cast("int").alias("week"),
                          p[2].alias("away"), p[3].alias("home"))


@query("build_game_id", """
SELECT o_orderkey, concat_ws('_', CAST(year(o_orderdate) AS VARCHAR),
         CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 2 THEN lpad(CAST(o_custkey AS VARCHAR), 2, '0')
              ELSE CAST(o_custkey AS VARCHAR) END, o_orderstatus, o_orderpriority) AS game_id FROM orders""")
def build_game_id(t: Tables):
    gid = S.build_game_id(F.year("o_orderdate"), c("o_custkey"), c("o_orderstatus"), c("o_orderpriority"))
    return t.orders.select("o_orderkey", gid.alias("game_id"))


@query("string_clean", r"""
SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS trimmed, ltrim(concat('  ', c_mktsegment)) AS left_trimmed,
       replace(replace(concat(c_name, '\', chr(10)), '\', ''), chr(10), '') AS plain,
       split_part('1|season/team[' || c_nationkey || ':' || c_mktsegment, ':', 2) AS term FROM customer""")
def string_clean(t: Tables):
    label = F.concat(F.lit("1|season/team["), c("c_nationkey").cast("string"), F.lit(":"), c("c_mktsegment"), F.lit("]"))
    raw = F.concat(c("c_name"), F.lit("\\"), F.lit("\n"))
    return t.customer.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), c("c_name"), F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), c("c_mktsegment"))).alias("left_trimmed"),
        F.replace(F.replace(raw, F.lit("\\")), F.lit("\n")).alias("plain"),
        F.rtrim(F.substring_index(label, ":", -1), F.lit("]")).alias("term"),
    )


@query("name_normalise", """
SELECT DISTINCT passer_player_id, CASE WHEN strpos(passer_player_name, '.') > 0
  THEN concat(split_part(passer_player_name, '.', 1), '.', ltrim(split_part(passer_player_name, '.', 2)))
  ELSE passer_player_name END AS player FROM plays WHERE passer_player_name IS NOT NULL""")
def name_normalise(t: Tables):
    rows = t.plays.filter(c("passer_player_name").isNotNull()).select("passer_player_id", "passer_player_name").distinct()
    return rows.select("passer_player_id", S.normalise_name(c("passer_player_name")).alias("player"))


@query("date_from_parts", """
SELECT o_orderkey, CAST(d AS VARCHAR) AS game_date,
       CAST(CASE WHEN month(d) <= 2 THEN year(d) - 1 ELSE year(d) END AS INT) AS season
FROM (SELECT o_orderkey, CASE WHEN month(o_orderdate) <= 2
             THEN make_date(year(o_orderdate) + 1, month(o_orderdate),
                            CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN 28 ELSE day(o_orderdate) END)
             ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)""")
def date_from_parts(t: Tables):
    leap = (F.month("o_orderdate") == 2) & (F.dayofmonth("o_orderdate") == 29)
    mmdd = F.month("o_orderdate") * 100 + F.when(leap, 28).otherwise(F.dayofmonth("o_orderdate"))
    rows = t.orders.select("o_orderkey", S.game_date(F.year("o_orderdate"), mmdd).alias("d"))
    return rows.select("o_orderkey", c("d").cast("string").alias("game_date"), S.season_of(c("d")).alias("season"))


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       dayname(o_orderdate) AS weekday FROM orders""")
def date_parts(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"), F.date_format(d, "EEEE").alias("weekday"))


@query("math_scalars", """
SELECT event_id, abs(value - 50) AS distance, ln(value + 1) AS log_value, sqrt(value) AS root, pow(value, 2) AS squared,
       round_even(value * 10, 0) / 10 AS rounded, value * user_id AS interaction FROM events""",
       "distance log_value root squared rounded interaction")
def math_scalars(t: Tables):
    v = c("value")
    return t.events.select(
        "event_id", F.abs(v - 50).alias("distance"), F.log(v + 1).alias("log_value"), F.sqrt(v).alias("root"),
        F.pow(v, 2.0).alias("squared"), S.half_even(v, 1).alias("rounded"), (v * c("user_id")).alias("interaction"),
    )


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"(2 * 6371 * asin(sqrt({h})))"


@query("haversine", f"SELECT game_id, {haversine_sql('25.95796', '-80.239311', 'lat', 'long')} AS km FROM games", "km")
def haversine(t: Tables):
    km = S.haversine(F.lit(25.95796), F.lit(-80.239311), c("lat"), c("long"))
    return t.games.select("game_id", km.alias("km"))


_FIRST_HOME = """
SELECT season, home_team AS team,
       CASE WHEN stadium IN ('Wembley Stadium', 'Hard Rock Stadium') THEN 25.95796::DOUBLE ELSE lat END AS lat,
       CASE WHEN stadium IN ('Wembley Stadium', 'Hard Rock Stadium') THEN -80.239311::DOUBLE ELSE long END AS long
FROM (SELECT g.*, row_number() OVER (PARTITION BY season, home_team ORDER BY week, game_id) AS rn FROM games AS g)
WHERE rn = 1"""


@query("travel_distance", f"""
WITH sites AS ({_FIRST_HOME}),
sides AS ({unpivot_sql(1)} UNION ALL {unpivot_sql(0)}),
km AS (
  SELECT s.*, {haversine_sql('a.lat', 'a.long', 'stadium_lat', 'stadium_long')} AS team_a_distance_home,
         {haversine_sql('b.lat', 'b.long', 'stadium_lat', 'stadium_long')} AS team_b_distance_home
  FROM sides AS s LEFT JOIN sites AS a ON a.season = s.season AND a.team = team_a
  LEFT JOIN sites AS b ON b.season = s.season AND b.team = team_b)
SELECT game_id, team_a, team_b, CASE WHEN team_a_distance_home >= 4400 THEN 0 ELSE team_a_home END AS team_a_home,
       team_a_distance_home, team_b_distance_home FROM km""", "team_a_distance_home team_b_distance_home")
def travel_distance(t: Tables):
    rows = schedule.travel(t.games, ["week", "game_id"])
    return rows.select("game_id", "team_a", "team_b", "team_a_home", "team_a_distance_home", "team_b_distance_home")


def probability_sql(ml: str) -> str:
    return f"(CASE WHEN {ml} < 0 THEN -{ml} / (100.0::DOUBLE - {ml}) ELSE 100.0::DOUBLE / (100 + {ml}) END)"


@query("moneyline_prob", f"""
SELECT game_id, {probability_sql('home_ml')} AS home_proba, {probability_sql('away_ml')} AS away_proba FROM games""",
       "home_proba away_proba")
def moneyline_prob(t: Tables):
    return t.games.select("game_id", S.moneyline_probability(c("home_ml")).alias("home_proba"),
                          S.moneyline_probability(c("away_ml")).alias("away_proba"))


@query("moneyline_no_vig", f"""
WITH p AS (SELECT game_id, {probability_sql('home_ml')} AS h, {probability_sql('away_ml')} AS a FROM games)
SELECT game_id, h / (h + a) AS home_proba, a / (h + a) AS away_proba FROM p""", "home_proba away_proba")
def moneyline_no_vig(t: Tables):
    h, a = S.moneyline_probability(c("home_ml")), S.moneyline_probability(c("away_ml"))
    return t.games.select("game_id", S.without_margin(h, a).alias("home_proba"), S.without_margin(a, h).alias("away_proba"))


@query("implied_points", """
SELECT game_id, team, spread, total_line / 2 - spread / 2 AS implied FROM (
  SELECT game_id, home_team AS team, -spread_line AS spread, total_line FROM games
  UNION ALL SELECT game_id, away_team, spread_line, total_line FROM games)""", "spread implied")
def implied_points(t: Tables):
    sides = F.explode(F.array("home_team", "away_team")).alias("team")
    rows = t.games.select("game_id", sides, "home_team", "spread_line", "total_line")
    rows = rows.withColumn("spread", S.team_spread(c("spread_line"), c("team") == c("home_team")))
    return rows.select("game_id", "team", "spread", S.implied_points(c("total_line"), c("spread")).alias("implied"))


@query("flags", """
SELECT game_id, play_seq, play_tie, CASE WHEN blocked_player_name IS NULL THEN 0 ELSE 1 END AS blocked,
       CASE WHEN field_goal_result = 'made' THEN 1 ELSE 0 END AS made,
       CASE WHEN extra_point_result = 'good' THEN 1 ELSE 0 END AS good FROM plays""")
def flags(t: Tables):
    return t.plays.select(
        "game_id", "play_seq", "play_tie",
        S.flag(c("blocked_player_name").isNotNull()).alias("blocked"),
        S.flag(c("field_goal_result") == "made").alias("made"),
        S.flag(c("extra_point_result") == "good").alias("good"),
    )
