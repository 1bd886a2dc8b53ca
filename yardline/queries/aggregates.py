"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.operators import aggregates as A
from yardline.plans import evaluate, schedule
from yardline.plans.builders import PLAY_ID
from yardline.queries.registry import Tables, query
from yardline.queries.views import PLAY_ORDER as SQL_ORDER
from yardline.queries.views import dsum, isum

c = F.col


@query("agg_sum", f"""
SELECT game_id, posteam, {isum('yards_gained')} AS yards, {dsum('epa')} AS epa, {isum('air_yards')} AS air_yards
FROM plays GROUP BY game_id, posteam""", "epa")
def agg_sum(t: Tables):
    return t.plays.groupBy("game_id", "posteam").agg(
        A.total("yards_gained").alias("yards"), A.total("epa").alias("epa"), A.total("air_yards").alias("air_yards")
    )


@query("agg_multi", f"""
SELECT game_id, posteam, {isum('pass_attempt')} AS attempts, max(total_line) AS total_line, avg(epa) AS mean_epa,
       count(receiver_player_id) AS targets, arg_min(play_type, ({SQL_ORDER})) AS first_type,
       arg_max(play_type, ({SQL_ORDER})) AS last_type FROM plays GROUP BY game_id, posteam""", "total_line mean_epa")
def agg_multi(t: Tables):
    return t.plays.groupBy("game_id", "posteam").agg(
        A.total("pass_attempt").alias("attempts"),
        F.max("total_line").alias("total_line"),
        F.avg("epa").alias("mean_epa"),
        F.count("receiver_player_id").alias("targets"),
        A.first_known("play_type", PLAY_ID).alias("first_type"),
        A.last_known("play_type", PLAY_ID).alias("last_type"),
    )


@query("agg_first", f"""
SELECT game_id, posteam, receiver_player_id AS first_receiver FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id, posteam ORDER BY {SQL_ORDER}) AS rn FROM plays) WHERE rn = 1""")
def agg_first(t: Tables):
    """Value of the first row, null included."""
    return t.plays.groupBy("game_id", "posteam").agg(
        A.first_value("receiver_player_id", PLAY_ID).alias("first_receiver")
    )


@query("agg_first_last", f"""
SELECT game_id, posteam, arg_min(receiver_player_id, ({SQL_ORDER})) AS first_receiver,
       arg_max(receiver_player_id, ({SQL_ORDER})) AS last_receiver FROM plays GROUP BY game_id, posteam""")
def agg_first_last(t: Tables):
    return t.plays.groupBy("game_id", "posteam").agg(
        A.first_known("receiver_player_id", PLAY_ID).alias("first_receiver"),
        A.last_known("receiver_player_id", PLAY_ID).alias("last_receiver"),
    )


@query("agg_max", """
SELECT game_id, posteam, max(season) AS season, max(season_type) AS season_type, max(home_team) AS home_team,
       max(home_score) AS home_score, max(spread_line) AS spread_line FROM plays GROUP BY game_id, posteam""", "spread_line")
def agg_max(t: Tables):
    names = ["season", "season_type", "home_team", "home_score", "spread_line"]
    return t.plays.groupBy("game_id", "posteam").agg(*[F.max(n).alias(n) for n in names])


@query("agg_count", """
SELECT game_id, count(*) AS n_plays, count(receiver_player_id) AS n_targets FROM plays GROUP BY game_id""")
def agg_count(t: Tables):
    return t.plays.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("n_plays"), F.count("receiver_player_id").alias("n_targets")
    )


@query("agg_mean", """
SELECT event_type, avg(value) AS mean_value FROM events GROUP BY event_type ORDER BY mean_value""", "mean_value")
def agg_mean(t: Tables):
    return t.events.groupBy("event_type").agg(F.avg("value").alias("mean_value")).orderBy("mean_value")


@query("season_results", """
WITH h AS (SELECT season, home_team AS team, count(*) AS n,
             count(*) FILTER (WHERE home_score > away_score) AS w, count(*) FILTER (WHERE home_score = away_score) AS d,
             list_sort(list(DISTINCT home_coach)) AS coaches FROM games GROUP BY season, home_team),
a AS (SELECT season, away_team AS team, count(*) AS n,
        count(*) FILTER (WHERE away_score > home_score) AS w, count(*) FILTER (WHERE home_score = away_score) AS d
      FROM games GROUP BY season, away_team)
SELECT season, team, h.w + a.w AS total_wins, h.d + a.d AS total_ties, h.n + a.n - h.w - a.w - h.d - a.d AS total_losses,
       array_to_string(coaches, ',') AS coaches FROM h JOIN a USING (season, team)""")
def season_results(t: Tables):
    rows = schedule.season_results(t.games)
    return rows.withColumn("coaches", F.array_join("coaches", ","))


@query("mean_se_interval", """
SELECT season, avg(m) AS mean, stddev_pop(m) / sqrt(count(m)) AS se, avg(m) - 2 * stddev_pop(m) / sqrt(count(m)) AS low,
       avg(m) + 2 * stddev_pop(m) / sqrt(count(m)) AS high
FROM (SELECT season, home_score - away_score AS m FROM games) GROUP BY season""", "mean se low high")
def mean_se_interval(t: Tables):
    rows = t.games.withColumn("m", c("home_score") - c("away_score"))
    return A.mean_interval(rows, ["season"], "m")


@query("mean_ci_by_group", """
SELECT event_type, count(value) AS n, avg(value) AS mean,
       avg(value) - 1.96 * stddev_samp(value) / sqrt(count(value)) AS low,
       avg(value) + 1.96 * stddev_samp(value) / sqrt(count(value)) AS high FROM events GROUP BY event_type""", "mean low high")
def mean_ci_by_group(t: Tables):
    return A.mean_ci(t.events, ["event_type"], "value")


@query("agg_distinct_list", """
SELECT season, CAST(substr(home_team, 2) AS INT) // 25 AS league, array_to_string(list_sort(list(DISTINCT home_team)), ',') AS teams,
       min(home_team) AS first_team FROM games GROUP BY ALL""")
def agg_distinct_list(t: Tables):
    """Teams of each season and league; a league has 25, so the lists stay short."""
    league = F.floor(F.substring("home_team", 2, 6).cast("int") / 25).cast("int").alias("league")
    teams = t.games.groupBy("season", league).agg(F.sort_array(F.collect_set("home_team")).alias("teams"))
    return teams.select("season", "league", F.array_join("teams", ",").alias("teams"), F.element_at("teams", 1).alias("first_team"))


@query("min_games_filter", """
SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 65)""")
def min_games_filter(t: Tables):
    return A.keep_large_groups(t.events.select("event_id", "user_id"), ["user_id"], 65)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(t: Tables):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("group_share", """
SELECT event_id, value / nullif(sum(value) OVER (PARTITION BY user_id), 0) AS share FROM events""", "share")
def group_share(t: Tables):
    rows = A.with_group(t.events.select("event_id", "user_id", "value"), ["user_id"], {"whole": F.sum("value")})
    return rows.select("event_id", A.share(c("value"), c("whole")).alias("share"))


@query("global_stats", """
SELECT count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std FROM events""",
       "mean median std")
def global_stats(t: Tables):
    median = A.quantiles(t.events, [], "value", {"m": 0.5})
    one = t.events.agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return one.withColumn("median", median.scalar())


@query("quantiles", """
SELECT event_type, quantile_cont(value, 0.1) AS q10, quantile_cont(value, 0.5) AS median,
       quantile_cont(value, 0.8) AS q80, quantile_cont(value, 0.95) AS q95 FROM events GROUP BY event_type""",
       "q10 median q80 q95")
def quantiles(t: Tables):
    return A.quantiles(t.events, ["event_type"], "value", {"q10": 0.1, "median": 0.5, "q80": 0.8, "q95": 0.95})


@query("two_level_agg", """
WITH p AS (SELECT user_id, event_type, sum(value) AS part FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, part, sum(part) OVER (PARTITION BY user_id) AS whole FROM p""", "part whole")
def two_level_agg(t: Tables):
    parts = t.events.groupBy("user_id", "event_type").agg(F.sum("value").alias("part"))
    return A.with_group(parts, ["user_id"], {"whole": F.sum("part")})


@query("coverage_by_decile", """
WITH x AS (SELECT value, user_id * 0.01::DOUBLE AS low, user_id * 0.01::DOUBLE + 60 AS high, (value * 7 + user_id) / 3 AS pred FROM events),
e AS (SELECT quantile_cont(pred, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM x)
SELECT CAST(1 + len(list_filter(edges, lambda q: q < pred)) AS INT) AS bin, count(*) AS n,
       avg(CASE WHEN value >= low AND value <= high THEN 1 ELSE 0 END) AS coverage, avg(high - low) AS width
FROM x, e GROUP BY bin""", "coverage width")
def coverage_by_decile(t: Tables):
    rows = t.events.select(
        "value", (c("user_id") * 0.01).alias("low"), (c("user_id") * 0.01 + 60).alias("high"),
        ((c("value") * 7 + c("user_id")) / 3).alias("pred"),
    )
    return evaluate.coverage_by_bin(rows, "value", "low", "high", "pred")
