"""Ratings, shrinkage and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.operators import sets
from yardline.plans import evaluate as E
from yardline.plans import ratings as R
from yardline.queries.registry import Tables, query
from yardline.queries.views import normal_sql

c = F.col


def _srs_sql() -> str:
    """Twelve synchronous passes, each centred, as chained statements."""
    parts = ["""sides AS (
  SELECT season, home_team AS team, away_team AS opp, home_score AS pf, away_score AS pa FROM games
  UNION ALL SELECT season, away_team, home_team, away_score, home_score FROM games)""",
             "base AS (SELECT season, team, count(*) AS n, avg(pf) AS pts_for, avg(pa) AS pts_against, "
             "avg(pf) - avg(pa) AS mov FROM sides GROUP BY season, team)",
             "v0 AS (SELECT season, team, 0.0::DOUBLE AS adj FROM base)"]
    for i in range(1, 13):
        parts.append(f"""v{i} AS MATERIALIZED (SELECT season, team, r - avg(r) OVER (PARTITION BY season) AS adj FROM (
  SELECT s.season, s.team, avg(b.mov + v.adj) AS r FROM sides AS s
  JOIN base AS b ON b.season = s.season AND b.team = s.opp
  JOIN v{i - 1} AS v ON v.season = s.season AND v.team = s.opp GROUP BY s.season, s.team))""")
    return "WITH " + ",\n".join(parts) + """
SELECT season, team, n AS games_played, pts_for, pts_against, mov AS init_mov, adj, mov + adj AS final_srs
FROM base JOIN v12 USING (season, team)"""


SRS_OUT = "pts_for pts_against init_mov adj final_srs"


def srs(t: Tables):
    return R.simple_ratings(sets.home_away_rows(t.games))


@query("srs_rating", _srs_sql(), SRS_OUT)
def srs_rating(t: Tables):
    return srs(t).withColumnRenamed("games", "games_played")


_MARGIN = """(SELECT season, team, avg(m) AS theta FROM (
  SELECT season, home_team AS team, home_score - away_score AS m FROM games
  UNION ALL SELECT season, away_team, away_score - home_score FROM games) GROUP BY season, team)"""


@query("james_stein", f"""
SELECT season, team, theta, (1 - (count(*) OVER (PARTITION BY season) - 2) * var_samp(theta) OVER (PARTITION BY season)
         / sum(theta * theta) OVER (PARTITION BY season)) * theta AS js FROM {_MARGIN}""", "theta js")
def james_stein(t: Tables):
    rows = sets.home_away_rows(t.games).groupBy("season", c("team_a").alias("team"))
    rows = rows.agg(F.avg("team_a_mov").alias("theta"))
    return R.james_stein(rows, "theta", F.var_samp("theta"), by=["season"])


@query("partial_pool", """
WITH g AS (SELECT season, count(*) AS n, avg(home_score - away_score) AS mean, var_samp(home_score - away_score) AS v
           FROM games GROUP BY season),
w AS (SELECT sum(v * (n - 1)) / sum(n - 1) FILTER (WHERE v IS NOT NULL) AS within, avg(mean) AS grand,
             var_samp(mean) AS raw, avg(1.0::DOUBLE / n) AS inv FROM g),
b AS (SELECT w.*, greatest(raw - within * inv, 0) AS between_var FROM w)
SELECT season, n, mean, between_var / (between_var + within / n) AS weight,
       grand + between_var / (between_var + within / n) * (mean - grand) AS pooled_mean FROM g, b""",
       "mean weight pooled_mean")
def partial_pool(t: Tables):
    rows = t.games.select("season", (c("home_score") - c("away_score")).alias("mov"))
    return R.partial_pool(rows, "season", "mov")


_LABELS = """(SELECT '1|season/' || term || '[' || season || ':' || team || ']' AS label, avg(points) AS mean FROM (
  SELECT 'team_a' AS term, season, home_team AS team, home_score AS points FROM games
  UNION ALL SELECT 'team_a', season, away_team, away_score FROM games
  UNION ALL SELECT 'team_b', season, home_team, away_score FROM games
  UNION ALL SELECT 'team_b', season, away_team, home_score FROM games) GROUP BY term, season, team)"""


@query("posterior_terms", f"""
WITH parts AS (SELECT regexp_extract(label, '/(\\w+)\\[', 1) AS term, CAST(regexp_extract(label, '\\[(\\d+):', 1) AS INT) AS season,
                      regexp_extract(label, ':(.+)\\]', 1) AS team, mean FROM {_LABELS})
SELECT season, team, max(mean) FILTER (term = 'team_a') AS off_mean, max(mean) FILTER (term = 'team_b') AS def_mean,
       max(mean) FILTER (term = 'team_a') - max(mean) FILTER (term = 'team_b') AS total_edge
FROM parts WHERE season >= 2022 GROUP BY season, team""", "off_mean def_mean total_edge")
def posterior_terms(t: Tables):
    """Labelled estimates such as ``1|season/team_a[2016:T1]`` split into term, season and team; of the seasons from
    2022 on, offence beside defence."""
    sides = sets.home_away_rows(t.games)
    labels = []
    for term, value in (("team_a", "team_a_score"), ("team_b", "team_b_score")):
        est = sides.groupBy("season", c("team_a").alias("team")).agg(F.avg(value).alias("mean"))
        label = F.concat(F.lit(f"1|season/{term}["), c("season").cast("string"), F.lit(":"), c("team"), F.lit("]"))
        labels.append(est.select(label.alias("label"), "mean"))
    return R.posterior_edges(labels[0].unionByName(labels[1]), first_season=2022)


@query("error_metrics", """
SELECT event_type, count(value) AS n, avg(abs(value - p)) AS mae, avg(pow(value - p, 2)) AS mse, avg(value - p) AS mean_residual
FROM (SELECT event_type, value, CAST(user_id % 80 AS DOUBLE) AS p FROM events) GROUP BY event_type""", "mae mse mean_residual")
def error_metrics(t: Tables):
    rows = t.events.withColumn("p", c("user_id") % 80)
    return E.error_metrics(rows, "value", "p", ["event_type"])


@query("t_statistic", f"""
WITH s AS (SELECT count(r) AS n, avg(r) AS mean, avg(r) / (stddev_samp(r) / sqrt(count(r))) AS t, count(r) - 1 AS df
           FROM (SELECT value - 40 AS r FROM events)),
z AS (SELECT s.*, -((8 * df + 1) / (8 * df + 3) * sqrt(df * ln(1 + t * t / df))) AS z FROM s)
SELECT n, mean, t, df, 2 * ({normal_sql("z")}) AS p FROM z""", "mean t p")
def t_statistic(t: Tables):
    return E.t_statistic(t.events.select((c("value") - 40).alias("r")), "r")


_INTERVAL = "SELECT event_id, value, user_id * 0.01::DOUBLE AS low, 30 + user_id * 0.01::DOUBLE AS high FROM events"


@query("conformal_interval", f"""
WITH x AS ({_INTERVAL}),
r AS (SELECT x.*, greatest(low - value, 0) + greatest(value - high, 0) AS resid FROM x),
k AS (SELECT resid AS adj FROM (SELECT resid, row_number() OVER (ORDER BY resid) AS p, count(*) OVER () AS n FROM r)
      WHERE p = ceil(0.9 * (n + 1)))
SELECT event_id, low - adj AS conformed_low, high + adj AS conformed_high,
       CASE WHEN round(value, 6) BETWEEN round(low - adj, 6) AND round(high + adj, 6) THEN 1 ELSE 0 END AS inside_conformed
FROM x, k""", "conformed_low conformed_high")
def conformal_interval(t: Tables):
    low = c("user_id") * 0.01
    rows = t.events.select("event_id", "value", low.alias("low"), (30 + low).alias("high"))
    out = E.conformal_interval(rows, "value", "low", "high", 0.9)
    inside = F.round("value", 6).between(F.round("conformed_low", 6), F.round("conformed_high", 6)).cast("int")
    return out.select("event_id", "conformed_low", "conformed_high", inside.alias("inside_conformed"))


def draws(t: Tables):
    return t.draws.select("row_id", "value")


def actuals(t: Tables):
    """The value to judge draws by: a player's first event."""
    first = t.events.groupBy(c("user_id").alias("row_id"))
    return first.agg(F.min_by("value", F.struct("ts", "event_id")).alias("actual"))


_ACTUALS = "SELECT user_id AS row_id, arg_min(value, (ts, event_id)) AS actual FROM events GROUP BY user_id"
SUMMARY_OUT = "mean median q10 q80 q90 q95 actual"


@query("simulation_summary", f"""
WITH a AS ({_ACTUALS}),
s AS (SELECT row_id, avg(value) AS mean, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.1) AS q10,
        quantile_cont(value, 0.8) AS q80, quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.95) AS q95
      FROM draws GROUP BY row_id)
SELECT s.*, actual, CASE WHEN actual > median THEN 1 ELSE 0 END AS over_median,
       CASE WHEN actual > q80 THEN 1 ELSE 0 END AS over_q80, CASE WHEN actual > q90 THEN 1 ELSE 0 END AS over_q90,
       CASE WHEN actual > q95 THEN 1 ELSE 0 END AS over_q95, CASE WHEN actual < q10 THEN 1 ELSE 0 END AS under_q10
FROM s JOIN a USING (row_id)""", SUMMARY_OUT)
def simulation_summary(t: Tables):
    return E.simulation_summary(draws(t), actuals(t))


@query("simulation_rates", f"""
WITH a AS ({_ACTUALS}),
s AS (SELECT row_id, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.1) AS q10,
        quantile_cont(value, 0.8) AS q80, quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.95) AS q95
      FROM draws GROUP BY row_id)
SELECT count(*) AS n, avg(CASE WHEN actual > median THEN 1 ELSE 0 END) AS over_median,
       avg(CASE WHEN actual > q80 THEN 1 ELSE 0 END) AS over_q80, avg(CASE WHEN actual > q90 THEN 1 ELSE 0 END) AS over_q90,
       avg(CASE WHEN actual > q95 THEN 1 ELSE 0 END) AS over_q95, avg(CASE WHEN actual < q10 THEN 1 ELSE 0 END) AS under_q10
FROM s JOIN a USING (row_id)""", "over_median over_q80 over_q90 over_q95 under_q10")
def simulation_rates(t: Tables):
    return E.summary_rates(E.simulation_summary(draws(t), actuals(t)))


@query("calibration_curve", f"""
WITH a AS ({_ACTUALS}),
lv AS (SELECT CAST(i AS INT) AS i, least(1.0::DOUBLE, 0.1::DOUBLE + 0.9::DOUBLE * i / 74) AS level FROM range(75) AS r(i)),
o AS (SELECT row_id, value, row_number() OVER (PARTITION BY row_id ORDER BY value) - 1 AS p,
             count(*) OVER (PARTITION BY row_id) AS n FROM draws),
q AS (SELECT l.i, l.level, x.row_id,
        max(CASE WHEN p = floor(l.level * (n - 1)) THEN value END) AS lo,
        max(CASE WHEN p = ceil(l.level * (n - 1)) THEN value END) AS hi,
        max(l.level * (n - 1) - floor(l.level * (n - 1))) AS f
      FROM lv AS l, o AS x GROUP BY l.i, l.level, x.row_id)
SELECT i, level, avg(CASE WHEN actual <= lo + f * (hi - lo) + 1e-9 THEN 1 ELSE 0 END) AS share
FROM q JOIN a USING (row_id) GROUP BY i, level""", "level share")
def calibration_curve(t: Tables):
    # draws and actuals have two decimals; the hair keeps equality out of reach of float noise
    shifted = actuals(t).withColumn("actual", c("actual") - 1e-9)
    return E.calibration_curve(draws(t), shifted)
