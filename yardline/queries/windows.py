"""Window queries: players are ``user_id`` ordered by (ts, event_id). The stat is the root of the value, null
for error events: roots have no short decimals, so no mean of them sits on a rounding tie."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.operators import aggregates as A
from yardline.operators import windows as W
from yardline.plans import evaluate, features, schedule
from yardline.plans.builders import adjusted_epa as adjusted
from yardline.plans.builders import play_features
from yardline.queries.registry import Tables, query
from yardline.queries.views import PLAY_ORDER, ewm, half_even, span

c = F.col
ORDER = ["ts", "event_id"]
X = "(SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN sqrt(value) END AS x FROM events)"
OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id"
PRIOR = f"{OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def series(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "ts", F.when(c("event_type") != "error", F.sqrt("value")).alias("x"))


def per_player(t: Tables, **feats) -> DataFrame:
    return W.add_features(series(t), ["user_id"], ORDER, feats).drop("ts", "x")


@query("lag_one", f"SELECT event_id, user_id, lag(x) {OVER}) AS last_x FROM {X}", "last_x")
def lag_one(t: Tables):
    return per_player(t, last_x=W.Lag("x"))


@query("lead_diff", f"""
SELECT game_id, play_seq, play_tie, CAST(coalesce(game_seconds_remaining - lead(game_seconds_remaining)
  OVER (PARTITION BY game_id ORDER BY {PLAY_ORDER}), 0) AS INT) AS time_between FROM plays""")
def lead_diff(t: Tables):
    rows = t.plays.select("game_id", "play_seq", "play_tie", "game_seconds_remaining")
    feats = {"next": W.Lead("game_seconds_remaining")}
    rows = W.add_features(rows, ["game_id"], ["play_seq", "play_tie"], feats)
    gap = F.coalesce(c("game_seconds_remaining") - c("next"), F.lit(0))
    return rows.select("game_id", "play_seq", "play_tie", gap.alias("time_between"))


@query("rolling_mean_full", f"""
SELECT event_id, user_id, CASE WHEN count(x) {OVER} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) >= 6
  THEN avg(x) {OVER} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS roll6,
  CASE WHEN count(x) {OVER} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) >= 10
  THEN avg(x) {OVER} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) END AS roll10 FROM {X}""", "roll6 roll10")
def rolling_mean_full(t: Tables):
    return per_player(t, roll6=W.RollingMean("x", 6), roll10=W.RollingMean("x", 10))


@query("rolling_mean_partial", f"""
SELECT event_id, user_id, avg(x) {OVER} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS roll12 FROM {X}""", "roll12")
def rolling_mean_partial(t: Tables):
    return per_player(t, roll12=W.RollingMean("x", 12, partial=True))


@query("ewm_mean", f"""
SELECT event_id, user_id, a08, s12 FROM {ewm(X, 'user_id', 'ts, event_id', {'a08': ('x', 0.08), 's12': ('x', span(12))})}""",
       "a08 s12")
def ewm_mean(t: Tables):
    return per_player(t, a08=W.Ewm("x", alpha=0.08), s12=W.Ewm("x", span=12))


@query("ewm_current", f"""
SELECT event_id, user_id, s5 FROM {ewm(X, 'user_id', 'ts, event_id', {'s5': ('x', span(5))}, shift=False)}""", "s5")
def ewm_current(t: Tables):
    return per_player(t, s5=W.Ewm("x", span=5, shift=False))


@query("ewm_com", f"""
SELECT event_id, user_id, c08 FROM {ewm(X, 'user_id', 'ts, event_id', {'c08': ('x', 1 / 1.08)})}""", "c08")
def ewm_com(t: Tables):
    return per_player(t, c08=W.Ewm("x", com=0.08))


@query("expanding_mean", f"SELECT event_id, user_id, avg(x) {PRIOR} AS mean_x FROM {X}", "mean_x")
def expanding_mean(t: Tables):
    return per_player(t, mean_x=W.expanding_mean("x"))


@query("global_expanding_mean", f"""
SELECT event_id, coalesce(avg(x) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.05)
  AS mean_x FROM {X}""", "mean_x")
def global_expanding_mean(t: Tables):
    """Mean of everything before the row, over the whole table."""
    rows = W.add_features(series(t).drop("user_id"), [], ORDER, {"mean_x": W.expanding_mean("x")})
    return rows.select("event_id", F.coalesce("mean_x", F.lit(0.05)).alias("mean_x"))


@query("expanding_max", f"SELECT event_id, user_id, coalesce(max(x) {PRIOR}, 350) AS max_x FROM {X}", "max_x")
def expanding_max(t: Tables):
    return per_player(t, max_x=W.expanding_max("x")).withColumn("max_x", F.coalesce("max_x", F.lit(350.0)))


@query("expanding_fraction", f"""
SELECT event_id, user_id, CASE WHEN count(x) {PRIOR} = 0 THEN 1.0::DOUBLE
  ELSE CAST(count(*) FILTER (WHERE x > 6) {PRIOR} AS DOUBLE) / row_number() {OVER}) END AS frac FROM {X}""", "frac")
def expanding_fraction(t: Tables):
    return per_player(t, frac=W.expanding_fraction("x", 6.0))


@query("cumsum", f"SELECT event_id, user_id, sum(x) {OVER} ROWS UNBOUNDED PRECEDING) AS sum_x FROM {X}", "sum_x")
def cumsum(t: Tables):
    return per_player(t, sum_x=W.cumulative_sum("x"))


@query("cumcount", f"""
SELECT event_id, user_id, row_number() {OVER}) - 1 AS from_zero, row_number() {OVER}) AS from_one FROM {X}""")
def cumcount(t: Tables):
    return per_player(t, from_zero=W.running_count(0), from_one=W.running_count(1))


@query("avg_rank", """
WITH p AS (SELECT game_id, posteam, receiver_player_id, count(*) AS targets FROM plays
           WHERE receiver_player_id IS NOT NULL GROUP BY game_id, posteam, receiver_player_id)
SELECT a.game_id, a.posteam, a.receiver_player_id, a.targets,
       count(*) FILTER (WHERE b.targets > a.targets) + (count(*) FILTER (WHERE b.targets = a.targets) + 1) / 2.0::DOUBLE AS rank
FROM p AS a JOIN p AS b USING (game_id, posteam) GROUP BY ALL""", "rank")
def avg_rank(t: Tables):
    rows = t.plays.filter(c("receiver_player_id").isNotNull()).groupBy("game_id", "posteam", "receiver_player_id")
    rows = rows.agg(F.count(F.lit(1)).alias("targets"))
    return A.average_rank(rows, ["game_id", "posteam"], "targets", "rank")


@query("rolling_slope", f"""
WITH r AS (SELECT event_id, user_id, ts, x, row_number() {OVER}) AS rn FROM {X})
SELECT event_id, user_id, CASE WHEN count(x) {OVER} ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) < 2 THEN 0
  ELSE regr_slope(x, CAST(rn AS DOUBLE)) {OVER} ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) END AS slope FROM r""", "slope")
def rolling_slope(t: Tables):
    return per_player(t, slope=W.RollingSlope("x", 25))


@query("ffill", f"""
SELECT event_id, last_value(x IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS x FROM {X}""", "x")
def ffill(t: Tables):
    rows = W.add_features(series(t), [], ORDER, {"filled": W.fill_forward("x")})
    return rows.select("event_id", c("filled").alias("x"))


@query("bfill", f"""
SELECT event_id, user_id, first_value(x IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x FROM {X}""", "x")
def bfill(t: Tables):
    rows = W.add_features(series(t), ["user_id"], ORDER, {"filled": W.fill_forward("x")}, descending=True)
    return rows.select("event_id", "user_id", c("filled").alias("x"))


@query("qcut_decile", """
WITH e AS (SELECT quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM events)
SELECT event_id, CAST(1 + len(list_filter(edges, lambda q: q < value)) AS INT) AS decile FROM events, e""")
def qcut_decile(t: Tables):
    return evaluate.quantile_bins(t.events.select("event_id", "value"), "value", 10, "decile").drop("value")


@query("zscore_filter", """
SELECT event_id, user_id, value FROM (
  SELECT *, (value - avg(value) OVER (PARTITION BY user_id)) / nullif(stddev_samp(value) OVER (PARTITION BY user_id), 0) AS z
  FROM events) WHERE z > -1""", "value")
def zscore_filter(t: Tables):
    return features.zscore_filter(t.events.select("event_id", "user_id", "value"), ["user_id"], "value", -1.0)


WEEKS_SQL = """
SELECT d, season, CAST(CASE WHEN wd IN ('Saturday', 'Thursday') THEN lead(n) OVER (ORDER BY d) ELSE n END AS BIGINT) AS week
FROM (SELECT d, wd, season, row_number() OVER (PARTITION BY season, wd ORDER BY d) AS n FROM (
  SELECT d, dayname(d) AS wd, CAST(CASE WHEN month(d) <= 2 THEN year(d) - 1 ELSE year(d) END AS INT) AS season
  FROM (SELECT DISTINCT CAST({date} AS DATE) AS d FROM {table})))"""


@query("week_number", f"SELECT CAST(d AS VARCHAR) AS date, season, week FROM ({WEEKS_SQL.format(date='o_orderdate', table='orders')})")
def week_number(t: Tables):
    dates = t.orders.select(F.to_date("o_orderdate").alias("date_dt")).distinct()
    return schedule.week_numbers(dates).select(c("date_dt").cast("string").alias("date"), "season", "week")


def _adjusted_sql() -> str:
    order = f"ORDER BY game_date, game_id, {PLAY_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    league = f"avg(epa) OVER (PARTITION BY season, play_type {order})"
    off = f"avg(epa) OVER (PARTITION BY season, posteam, play_type {order})"
    deff = f"avg(epa) OVER (PARTITION BY season, defteam, play_type {order})"
    return f"""
SELECT game_id, play_seq, play_tie, season_epa_play, {half_even('off - season_epa_play', 3)} AS team_adjusted_off_epa,
       {half_even('def - season_epa_play', 3)} AS team_adjusted_def_epa FROM (
  SELECT *, {league} AS season_epa_play, {off} AS off, {deff} AS def FROM processed WHERE play_type IN ('pass', 'run'))"""


@query("adjusted_epa", _adjusted_sql(), "season_epa_play team_adjusted_off_epa team_adjusted_def_epa")
def adjusted_epa(t: Tables):
    plays = play_features(t.plays, row_bound=t.play_rows)
    rows = adjusted(plays, keep=["play_seq", "play_tie"], row_bound=t.play_rows)
    return rows.select("game_id", "play_seq", "play_tie", "season_epa_play",
                       "team_adjusted_off_epa", "team_adjusted_def_epa")
