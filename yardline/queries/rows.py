"""Projections, filters, ordering, splitting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.functions.scalars import band_score
from yardline.operators import columns, joins, sets
from yardline.operators.windows import add_features, expanding_mean
from yardline.queries.registry import Tables, query

c = F.col
PLAY = ["play_seq", "play_tie"]


@query("project", """
SELECT o_orderkey AS order_key, o_custkey AS team, o_totalprice * 0.5::DOUBLE + 10 AS adjusted,
       o_totalprice / 4 AS quarter, lower(o_orderpriority) AS priority FROM orders""", "adjusted quarter")
def project(t: Tables):
    rows = t.orders.withColumnsRenamed({"o_orderkey": "ORDER_KEY", "o_custkey": "TEAM"})
    rows = rows.withColumns(
        {"ADJUSTED": c("o_totalprice") * 0.5 + 10, "QUARTER": c("o_totalprice") / 4, "PRIORITY": F.lower("o_orderpriority")}
    )
    return columns.lower_names(rows.select("ORDER_KEY", "TEAM", "ADJUSTED", "QUARTER", "PRIORITY"))


@query("drop_columns", """
SELECT l_orderkey, l_suppkey, l_partkey, l_quantity FROM lineitem""", "l_quantity")
def drop_columns(t: Tables):
    rows = t.lineitem.drop("l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    return columns.drop_matching(rows, "line", "ship")


@query("filter_bool", """
SELECT game_id, play_seq, play_tie, yards_gained FROM plays
WHERE pass_attempt = 1 AND play_type <> 'two_point_att' AND sack = 0 AND (yards_gained > 10 OR interception = 1)""")
def filter_bool(t: Tables):
    kept = (c("pass_attempt") == 1) & ~(c("play_type") == "two_point_att") & (c("sack") == 0)
    kept = kept & ((c("yards_gained") > 10) | (c("interception") == 1))
    return t.plays.filter(kept).select("game_id", *PLAY, "yards_gained")


@query("filter_isin", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase', 'view')", "value")
def filter_isin(t: Tables):
    return t.events.filter(c("event_type").isin("click", "purchase", "view")).select(
        "event_id", "user_id", "event_type", "value"
    )


@query("filter_between", "SELECT event_id, value FROM events WHERE value >= 10 AND value <= 50", "value")
def filter_between(t: Tables):
    return t.events.filter(c("value").between(10, 50)).select("event_id", "value")


@query("filter_contains", """
SELECT game_id, play_seq, play_tie, CASE WHEN play_desc LIKE '%GOOD%' THEN 1 ELSE 0 END AS good FROM plays
WHERE play_desc IS NULL OR play_desc NOT LIKE '%Aborted%'""")
def filter_contains(t: Tables):
    aborted = F.coalesce(c("play_desc").contains("Aborted"), F.lit(False))
    good = F.coalesce(c("play_desc").contains("GOOD"), F.lit(False)).cast("int")
    return t.plays.filter(~aborted).select("game_id", *PLAY, good.alias("good"))


@query("filter_expr", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_expr(t: Tables):
    return t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "c_mktsegment")


@query("case_when", """
SELECT game_id, play_seq, play_tie, CASE WHEN yards_gained >= 20 THEN 1 ELSE 0 END AS big_play,
       CASE WHEN home_team = posteam THEN away_team ELSE home_team END AS opp_team,
       CASE WHEN yards_gained < 0 THEN 0 ELSE yards_gained END AS yards_floor FROM plays""")
def case_when(t: Tables):
    return t.plays.select(
        "game_id",
        *PLAY,
        F.when(c("yards_gained") >= 20, 1).otherwise(0).alias("big_play"),
        F.when(c("home_team") == c("posteam"), c("away_team")).otherwise(c("home_team")).alias("opp_team"),
        F.greatest(c("yards_gained"), F.lit(0)).alias("yards_floor"),
    )


@query("masked_update", """
SELECT c_custkey, CASE WHEN c_nationkey = 3 AND c_acctbal < 0 THEN 24 ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_mktsegment = 'FURNITURE' AND c_nationkey <> 5 THEN 'none' ELSE c_name END AS c_name FROM customer""")
def masked_update(t: Tables):
    rows = columns.mask(t.customer, "c_name", (c("c_mktsegment") == "FURNITURE") & (c("c_nationkey") != 5), "none")
    rows = columns.mask(rows, "c_nationkey", (c("c_nationkey") == 3) & (c("c_acctbal") < 0), 24)
    return rows.select("c_custkey", "c_nationkey", "c_name")


@query("band_score", """
SELECT game_id, home_team, away_score,
       CASE WHEN away_score <= 6 THEN 7 WHEN away_score <= 13 THEN 4 WHEN away_score <= 20 THEN 1
            WHEN away_score <= 27 THEN 0 WHEN away_score <= 34 THEN -1 ELSE -4 END AS band FROM games""")
def bands(t: Tables):
    return t.games.select("game_id", "home_team", "away_score", band_score(c("away_score")).alias("band"))


@query("drop_nulls", """
SELECT game_id, play_seq, play_tie, air_yards, receiver_player_id FROM plays
WHERE air_yards IS NOT NULL AND receiver_player_id IS NOT NULL""")
def drop_nulls(t: Tables):
    rows = t.plays.select("game_id", *PLAY, "air_yards", "receiver_player_id")
    return rows.na.drop("any", subset=["air_yards", "receiver_player_id"])


@query("fill_map", """
SELECT game_id, play_seq, play_tie, coalesce(air_yards, 0) AS air_yards,
       coalesce(receiver_player_id, 'none') AS receiver_player_id, coalesce(temp, 72) AS temp,
       coalesce(wind, 0) AS wind FROM plays""", "temp wind")
def fill_map(t: Tables):
    rows = t.plays.select("game_id", *PLAY, "air_yards", "receiver_player_id", "temp", "wind")
    return columns.fill_nulls(rows, {"air_yards": 0, "receiver_player_id": "none", "temp": 72.0, "wind": 0.0})


@query("fill_median", """
WITH x AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM x)) AS value FROM x""", "value")
def fill_median(t: Tables):
    rows = t.events.select("event_id", F.when(c("event_type") != "error", c("value")).alias("value"))
    return columns.fill_median(rows, ["value"])


@query("fill_column", """
SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN value END, CAST(user_id AS DOUBLE)) AS value FROM events""", "value")
def fill_column(t: Tables):
    known = F.when(c("event_type") != "error", c("value")).alias("value")
    rows = t.events.select("event_id", known, c("user_id").cast("double").alias("user"))
    return columns.fill_from(rows, "value", "user").drop("user")


@query("fill_ramp", """
WITH w AS (
  SELECT season, week, avg(home_score + away_score) AS points FROM games GROUP BY season, week),
e AS (
  SELECT season, week, avg(points) OVER (PARTITION BY week ORDER BY season
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS week_avg FROM w),
k AS (SELECT e.*, row_number() OVER (PARTITION BY week_avg IS NULL ORDER BY season, week) AS k FROM e)
SELECT season, week, coalesce(week_avg, CASE WHEN k <= 18 THEN 250.0::DOUBLE - 35.0::DOUBLE * (k - 1) / 17 END) AS week_avg FROM k""", "week_avg")
def fill_ramp(t: Tables):
    weeks = t.games.groupBy("season", "week").agg(F.avg(c("home_score") + c("away_score")).alias("points"))
    weeks = add_features(weeks, ["week"], ["season"], {"week_avg": expanding_mean("points")}, row_bound=t.play_rows)
    return columns.fill_ramp(weeks.drop("points"), "week_avg", ["season", "week"], 250.0, 215.0, 18)


@query("round_all", """
SELECT event_id, user_id, round_even(value * 10, 0) / 10 AS value FROM events""", "value")
def round_all(t: Tables):
    return columns.round_all(t.events.select("event_id", "user_id", "value"), 1)


@query("sort_multi", "SELECT event_id, user_id, value FROM events ORDER BY user_id ASC, value DESC, event_id ASC", "value")
def sort_multi(t: Tables):
    rows = t.events.select("event_id", "user_id", "value")
    return rows.orderBy(c("user_id").asc(), c("value").desc(), c("event_id").asc())


@query("top_k", """
SELECT user_id, avg(value) AS mean_value FROM events GROUP BY user_id
ORDER BY round(avg(value), 6) DESC, user_id LIMIT 60""", "mean_value")
def top_k(t: Tables):
    """The 60 players with the highest mean."""
    rows = t.events.groupBy("user_id").agg(F.avg("value").alias("mean_value"))
    return rows.orderBy(F.round("mean_value", 6).desc(), "user_id").limit(60)


@query("chrono_split", """
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS p, count(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN p <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS part FROM r""")
def chrono_split(t: Tables):
    rows = sets.chrono_split(t.events.select("event_id", "ts"), ["ts", "event_id"], fraction=0.9)
    return rows.select("event_id", "part")


@query("time_series_folds", """
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS p, count(*) OVER () AS n FROM events),
s AS (SELECT r.*, CAST(floor(n / 16.0) AS BIGINT) AS b FROM r)
SELECT event_id, CAST(CASE WHEN p <= n - 15 * b THEN 0 ELSE floor((p - (n - 15 * b) - 1) / CAST(b AS DOUBLE)) + 1 END AS INT) AS fold FROM s""")
def time_series_folds(t: Tables):
    return sets.time_folds(t.events.select("event_id", "ts"), ["ts", "event_id"], 15).select("event_id", "fold")


_HASH = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"


@query("kfold", f"SELECT event_id, CAST({_HASH.format(seed=4416)} % 8 AS INT) AS fold FROM events")
def kfold(t: Tables):
    return t.events.select("event_id", sets.hash_fold(["event_id"], 8, 4416).alias("fold"))


@query("random_split", f"""
SELECT event_id, CASE WHEN {_HASH.format(seed=0)} % 1000 < 800 THEN 'train' ELSE 'test' END AS part FROM events""")
def random_split(t: Tables):
    return sets.random_split(t.events.select("event_id"), ["event_id"], 0.8)


@query("union_all", """
SELECT game_id, home_team AS team, 1 AS home, home_score AS score FROM games
UNION ALL SELECT game_id, away_team, 0, away_score FROM games""")
def union_all(t: Tables):
    home = t.games.select("game_id", c("home_team").alias("team"), F.lit(1).alias("home"), c("home_score").alias("score"))
    away = t.games.select(c("away_score").alias("score"), "game_id", c("away_team").alias("team"), F.lit(0).alias("home"))
    return home.unionByName(away)


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t: Tables):
    return t.events.select("user_id", "event_type").dropDuplicates()


@query("dedupe_keep_first", """
SELECT l_orderkey, l_partkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1""", "l_quantity")
def dedupe_keep_first(t: Tables):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rows = sets.keep_first(t.lineitem.select("l_orderkey", "l_quantity", *order), ["l_orderkey"], order)
    return rows.select("l_orderkey", "l_partkey", "l_quantity")


@query("except_ids", "SELECT c_custkey AS team FROM customer EXCEPT SELECT o_custkey FROM orders")
def except_ids(t: Tables):
    teams = t.customer.select(c("c_custkey").alias("team"))
    return joins.missing_keys(teams, t.orders.select(c("o_custkey").alias("team")), "team")


def unpivot_sql(home: int) -> str:
    a, b, sign = ("home", "away", "-") if home else ("away", "home", "")
    return f"""
SELECT game_id, season, total_line, referee, stadium, CAST(split_part(game_id, '_', 2) AS INT) AS week,
       lat AS stadium_lat, long AS stadium_long, {a}_team AS team_a, {b}_team AS team_b, {home} AS team_a_home,
       {a}_score AS team_a_score, {b}_score AS team_b_score, {a}_coach AS team_a_coach, {b}_coach AS team_b_coach,
       {a}_rest AS team_a_rest, {b}_rest AS team_b_rest, {sign}spread_line AS spread_line,
       {a}_rest - {b}_rest AS team_a_rest_edge, home_score + away_score AS total_score,
       CASE WHEN {a}_score > {b}_score THEN 1 ELSE 0 END AS team_a_win, {a}_score - {b}_score AS team_a_mov
FROM games"""


@query("home_away_unpivot", f"{unpivot_sql(1)} UNION ALL {unpivot_sql(0)}",
       "total_line stadium_lat stadium_long spread_line")
def home_away_unpivot(t: Tables):
    return sets.home_away_rows(t.games)


@query("ordinal_encode", """
SELECT o.o_orderkey, o_custkey, code FROM orders AS o JOIN (
  SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS code
  FROM (SELECT DISTINCT o_custkey FROM orders)) USING (o_custkey)""")
def ordinal_encode(t: Tables):
    codes = sets.ordinal_codes(t.orders, "o_custkey", "code")
    return joins.lookup(t.orders.select("o_orderkey", "o_custkey"), codes, ["o_custkey"], "code")


@query("pair_rows", """
SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / 2.0) AS BIGINT) AS pair FROM events""")
def pair_rows(t: Tables):
    return sets.pair_rows(t.events.select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "pair")
