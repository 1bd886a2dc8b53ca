"""Encoding, scaling and regression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardline.operators import sets
from yardline.plans import evaluate as E
from yardline.plans import models as M
from yardline.plans import ratings as R
from yardline.plans.features import GAME_ORDER, opponent_defence, shrunk_ewm
from yardline.plans.wide import walk_forward_wide
from yardline.queries.features import starter_ewm
from yardline.queries.registry import Tables, query
from yardline.session import settle

c = F.col
ORDER = ["ts", "event_id"]


@query("target_encode", """
WITH m AS (SELECT avg(sqrt(value)) AS mean FROM events)
SELECT event_id, event_type, (coalesce(sum(sqrt(value)) OVER w, 0) + mean) / (count(value) OVER w + 1) AS event_type_encoded
FROM events, m WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
       "event_type_encoded")
def target_encode(t: Tables):
    rows = t.events.select("event_id", "event_type", "ts", F.sqrt("value").alias("value"))
    return M.target_encode(rows, "event_type", "value", ORDER).select("event_id", "event_type", "event_type_encoded")


@query("rare_bucket", """
SELECT o_orderkey, CASE WHEN count(*) OVER (PARTITION BY o_custkey) >= 6 THEN CAST(o_custkey AS VARCHAR) ELSE 'rare' END
  AS team_bucket FROM orders""")
def rare_bucket(t: Tables):
    rows = t.orders.select("o_orderkey", c("o_custkey").cast("string").alias("team"))
    return M.rare_bucket(rows, "team", 6).drop("team")


_KINDS = ("click", "error", "purchase", "signup", "view")


@query("one_hot", f"""
WITH x AS (SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'odd' || event_id WHEN event_id % 10 <> 4 THEN event_type END AS kind FROM events)
SELECT event_id, {', '.join(f"CASE WHEN kind = '{k}' THEN 1.0::DOUBLE ELSE 0 END AS kind_{k}" for k in _KINDS)},
       CASE WHEN kind IN {_KINDS} THEN 0.0::DOUBLE ELSE 1 END AS kind_rare FROM x""",
       " ".join(f"kind_{k}" for k in (*_KINDS, "rare")))
def one_hot(t: Tables):
    """Event types as columns; types seen once, and missing ones, are rare."""
    last = c("event_id") % 10
    kind = F.when(last == 3, F.concat(F.lit("odd"), c("event_id").cast("string"))).when(last != 4, c("event_type"))
    rows, names = M.one_hot(t.events.select("event_id", kind.alias("kind")), ["kind"])
    return rows.select("event_id", *names)


@query("standardise", """
SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value_scaled FROM events""", "value_scaled")
def standardise(t: Tables):
    return M.standardise(t.events.select("event_id", "value"), ["value"]).drop("value")


@query("robust_scale", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS lo, quantile_cont(value, 0.5) AS mid, quantile_cont(value, 0.75) AS hi FROM events)
SELECT event_id, (value - mid) / (hi - lo) AS value_scaled FROM events, q""", "value_scaled")
def robust_scale(t: Tables):
    return M.robust_scale(t.events.select("event_id", "value"), ["value"]).drop("value")


FEATURES = ["ewm_passing_yards", "ewm_passing_attempts", "ewm_interceptions", "total_line", "spread_line"]
Y = "passing_yards"
X = "ewm_passing_yards"


def model_rows(t: Tables):
    """Starters with averages; the frame the regression jobs share."""
    keep = ["game_id", "player_id", "season", "week", Y, *FEATURES]
    rows = starter_ewm(t).select(*[n for n in keep if n != "game_id"], "game_id")
    return rows.withColumn("total_line", c("total_line").cast("double"))


IDS = ["game_id", "player_id"]


@query("random_intercept")
def random_intercept(t: Tables):
    """Passing yards on averages with an intercept per player; one row per player."""
    _, effects = R.random_intercept(model_rows(t), "player_id", Y, FEATURES)
    return effects


@query("count_glm")
def count_glm(t: Tables):
    rows = model_rows(t).withColumn("completions", F.greatest(c(Y) / 10, F.lit(0.0)).cast("int"))
    _, out = M.count_glm(rows, FEATURES, "completions")
    return out.select(*IDS, "completions", "count_pred")


@query("ridge_grid")
def ridge_grid(t: Tables):
    """Error per penalty and time block for a standardised ridge."""
    rows = sets.time_folds(settle(model_rows(t)), [*GAME_ORDER, "player_id"], 15)
    return M.time_series_scores(rows, FEATURES, Y, "fold", [0.1, 1, 10, 100, 500, 1000])


@query("time_series_models")
def time_series_models(t: Tables):
    """Error of gamma and Huber regressions per time block, each fitted on all blocks before."""
    rows = model_rows(t).filter(c(Y) > 0)
    rows = sets.time_folds(settle(rows), [*GAME_ORDER, "player_id"], 15)
    return M.time_series_model_scores(rows, FEATURES, Y, "fold")


@query("gamma_line_scores", f"""
WITH r AS (SELECT season, {Y} AS y FROM starter_ewm WHERE {Y} > 0),
f AS (SELECT DISTINCT season AS fold FROM r),
m AS (SELECT f.fold, avg(y) AS mean FROM f JOIN r ON r.season < f.fold GROUP BY f.fold)
SELECT 'gamma' AS model, CAST(fold AS INT) AS fold, count(*) AS n, avg(abs(y - mean)) AS mae FROM r JOIN m ON m.fold = r.season GROUP BY fold""", "mae")
def gamma_line_scores(t: Tables):
    """A gamma regression on nothing but the intercept predicts the mean of the seasons before."""
    rows = model_rows(t).filter(c(Y) > 0).withColumns({"fold": c("season").cast("int"), "none": F.lit(0.0)})
    return M.time_series_model_scores(rows, ["none"], Y, "fold", models=("gamma",))


@query("gamma_regression")
def gamma_regression(t: Tables):
    return M.gamma_regression(model_rows(t), FEATURES, Y).select(*IDS, Y, "gamma_pred")


@query("huber_regression")
def huber_regression(t: Tables):
    return M.huber_regression(model_rows(t), FEATURES, Y).select(*IDS, Y, "huber_preds")


@query("elastic_net")
def elastic_net(t: Tables):
    return M.elastic_net(model_rows(t), FEATURES, Y).select(*IDS, Y, "en_preds")


@query("quantile_regression")
def quantile_regression(t: Tables):
    """5, 50 and 95 % quantile predictions."""
    rows = settle(model_rows(t))
    for p, coefs in M.quantile_regression(rows, FEATURES, Y).items():
        rows = M.predict_linear(rows, FEATURES, coefs, f"q{round(p * 100)}")
    return rows.select(*IDS, Y, "q5", "q50", "q95")


@query("out_of_fold")
def out_of_fold(t: Tables):
    rows = model_rows(t).withColumn("fold", sets.hash_fold(IDS, 8, 4416))
    return M.out_of_fold(rows, FEATURES, Y, "fold").select(*IDS, "fold", Y, "oof")


@query("walk_forward")
def walk_forward(t: Tables):
    """Ridge refitted every week on everything played before."""
    return M.walk_forward(model_rows(t), FEATURES, Y).select(*IDS, "season", "week", Y, "preds")


NUMBERS = ["adj_ewm_passing_yards", "adj_ewm_passing_attempts", "wind", "temp", "total_line", "team_spread", "adj_def_ewm_py",
           "local_trend_ewm25", "ewm_interceptions", "adj_ewm_py_per_att"]


def weekly_rows(t: Tables):
    """Starters with the ten numbers and the three categories of the weekly models."""
    rows = opponent_defence(shrunk_ewm(starter_ewm(t)))
    rows = rows.withColumns({"wind": F.coalesce(c("wind").cast("double"), F.lit(0.0)), "temp": F.coalesce(c("temp").cast("double"), F.lit(72.0))})
    return rows.select(*IDS, "season", "week", "roof", Y, *[c(n).cast("double").alias(n) for n in NUMBERS])


def weekly_models(t: Tables):
    return walk_forward_wide(weekly_rows(t), NUMBERS, ["season", "roof"], "player_id", Y, IDS)


@query("walk_forward_models")
def walk_forward_models(t: Tables):
    """Three models refitted every week and their mean: ten numbers, season, roof, and an effect for every player; penalties by
    cross-validation."""
    out = weekly_models(t)
    return out.select(*IDS, "season", "week", Y, "ridge_preds", "en_preds", "huber_preds", "ensemble", "ridge_alpha", "en_alpha", "en_ratio")


@query("walk_forward_player_line", f"""
WITH r AS (SELECT game_id, player_id, season, week, {Y}, {X} FROM starter_ewm),
w AS (SELECT season, week, row_number() OVER (ORDER BY season, week) AS i FROM (SELECT DISTINCT season, week FROM r)),
p AS (SELECT w.season, w.week, r.player_id, count(*) AS n, sum({X}) AS x, sum({X} * {X}) AS xx, sum({Y}) AS y, sum({X} * {Y}) AS xy
      FROM w JOIN r ON (r.season, r.week) < (w.season, w.week) WHERE w.i > 51 GROUP BY w.season, w.week, r.player_id),
s AS (SELECT season, week, sum(n) - sum(n * n / (n + 10.0::DOUBLE)) AS a, sum(x) - sum(n * x / (n + 10)) AS b,
             sum(xx) - sum(x * x / (n + 10)) + 10 * (sum(xx) / sum(n) - pow(sum(x) / sum(n), 2)) AS c,
             sum(y) - sum(n * y / (n + 10)) AS d, sum(xy) - sum(x * y / (n + 10)) AS e FROM p GROUP BY season, week),
f AS (SELECT season, week, (d * c - e * b) / (a * c - b * b) AS base, (e * a - d * b) / (a * c - b * b) AS slope FROM s)
SELECT r.game_id, r.player_id, r.season, r.week, r.{Y}, f.base + f.slope * r.{X}
       + coalesce((p.y - p.n * f.base - p.x * f.slope) / (p.n + 10), 0) AS preds
FROM r JOIN f USING (season, week) LEFT JOIN p ON p.season = r.season AND p.week = r.week AND p.player_id = r.player_id""", "preds")
def walk_forward_player_line(t: Tables):
    """A line and an effect for every player, refitted every week."""
    out = walk_forward_wide(model_rows(t), [X], [], "player_id", Y, IDS, alphas=(10.0,), at_least=1, models=("ridge",))
    return out.select(*IDS, "season", "week", Y, c("ridge_preds").alias("preds"))


@query("stacked_models")
def stacked_models(t: Tables):
    """A linear and three quantile combinations of the weekly models, out of fold, and the interval made to cover nine in ten."""
    rows = weekly_models(t).withColumn("fold", sets.hash_fold(IDS, 8, 4416))
    rows = settle(M.stack(rows, ["huber_preds", "ridge_preds", "en_preds"], Y, "fold"))
    out = E.conformal_interval(rows, Y, "oof_5", "oof_95", 0.9)
    return out.select(*IDS, "season", "week", "fold", Y, "oof", "oof_5", "oof_50", "oof_95", "conformed_low", "conformed_high", "inside_conformed")


STACKED = ["ewm_passing_yards", "total_line"]


_LEVELS = "(VALUES (5, 0.05::DOUBLE), (50, 0.5::DOUBLE), (95, 0.95::DOUBLE)) AS v(name, level)"


@query("fold_quantile_coverage", f"""
SELECT fold, CAST(name AS INT) AS name, level, true AS covered
FROM (SELECT DISTINCT CAST(CAST('0x' || substr(md5(game_id || '|' || player_id || '|4416'), 1, 8) AS BIGINT) % 8 AS INT) AS fold
      FROM starter_ewm), {_LEVELS}""")
def fold_quantile_coverage(t: Tables):
    """The fit of a fold leaves as many rows of the other folds below it as its level says, but for those it passes through (one per
    coefficient) and a half per cent."""
    rows = settle(model_rows(t).withColumn("fold", sets.hash_fold(IDS, 8, 4416)))
    fits = M.fold_quantiles(rows, STACKED, Y, "fold").withColumnRenamed("fold", "of")
    met = rows.crossJoin(F.broadcast(fits)).filter(c("fold") != c("of"))  # eight fits
    n, p, entries = F.count(c(Y)), len(STACKED) + 1, []
    for i, (name, level) in enumerate(((5, 0.05), (50, 0.5), (95, 0.95))):
        below = F.sum(F.when(c(Y) <= M.linear_prediction(STACKED, F.slice("_coefs", i * p + 1, p)) + 1e-6, 1).otherwise(0))
        covered = F.abs(below - level * n) <= 0.005 * n + p
        entries.append(F.struct(F.lit(name).alias("name"), F.lit(level).alias("level"), covered.alias("covered")))
    return met.groupBy(c("of").alias("fold")).agg(F.array(*entries).alias("e")).select("fold", F.inline("e"))


@query("boosted_trees")
def boosted_trees(t: Tables):
    return M.boosted_trees(model_rows(t), FEATURES, Y).select(*IDS, Y, "boost_pred")


def _gamma_sql(shape: str, x: str) -> str:
    """The incomplete gamma function, term by term."""
    return f"""(CASE WHEN {x} <= 0 THEN 0 ELSE least(1, list_sum(list_transform(range(0, 500),
      lambda i: exp(-least({x}, 200) + ({shape} + i) * ln(least({x}, 200)) - lgamma({shape} + i + 1))))) END)"""


_P = """CASE WHEN {0} < 0.2 THEN 1 ELSE greatest(0, least(1, list_sum(list_transform(range(1, 41),
  lambda k: (CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0::DOUBLE * k * k * {0} * {0}))))) END"""


@query("ks_distance", f"""
WITH m AS (SELECT count(value) AS n, avg(value) AS mean, var_pop(value) AS var FROM events),
k AS (SELECT value AS x, count(*) AS k FROM events WHERE value IS NOT NULL GROUP BY value),
e AS (SELECT x, k, sum(k) OVER (ORDER BY x) AS upto, n, (x - mean) / sqrt(var) AS z, mean * mean / var AS shape, x * mean / var AS g FROM k, m),
f AS (SELECT e.*, 0.5 + (CASE WHEN z < 0 THEN -1 ELSE 1 END) * {_gamma_sql("0.5::DOUBLE", "(z * z / 2)")} / 2 AS a, {_gamma_sql("shape", "g")} AS b FROM e),
d AS (SELECT CAST(sum(k) AS BIGINT) AS n, max(greatest(upto / n - a, a - (upto - k) / n)) AS normal_distance,
             max(greatest(upto / n - b, b - (upto - k) / n)) AS gamma_distance FROM f),
s AS (SELECT *, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * normal_distance AS u, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * gamma_distance AS v FROM d)
SELECT n, normal_distance, gamma_distance, {_P.format("u")} AS normal_p, {_P.format("v")} AS gamma_p FROM s""",
       "normal_distance gamma_distance normal_p gamma_p")
def ks_distance(t: Tables):
    return M.ks_distance(t.events, "value")


@query("boosted_gamma")
def boosted_gamma(t: Tables):
    """Deviance of gamma boosting on four fifths of the starters and on the others, round by round."""
    rows = model_rows(t)
    train = sets.hash_number(IDS, 0) % 5 != 0
    losses, _ = M.boosted_gamma(rows, FEATURES, Y, train, "player_id", GAME_ORDER)
    schema = "round int, train_deviance double, held_out_deviance double"
    return t.spark.createDataFrame([(i, *loss) for i, loss in enumerate(losses)], schema)


@query("boosted_gamma_rows", f"""
SELECT game_id, player_id, CAST('0x' || substr(md5(game_id || '|' || player_id || '|0'), 1, 8) AS BIGINT) % 5 <> 0 AS trained, true AS better
FROM starter_ewm WHERE {Y} > 0""")
def boosted_gamma_rows(t: Tables):
    """Rows of both parts; training ends with less deviance than it began with, and held-out rows with no more than a hundredth above."""
    rows = model_rows(t)
    train = sets.hash_number(IDS, 0) % 5 != 0
    losses, out = M.boosted_gamma(rows, FEATURES, Y, train, "player_id", GAME_ORDER, rounds=10)
    better = bool(losses) and losses[-1][0] < losses[0][0] and losses[-1][1] <= losses[0][1] * 1.01
    return out.select(*IDS, c("_fitted").alias("trained"), F.lit(better).alias("better"))


HALF = 6


def _smooth_sql() -> str:
    cols, sums = [], {"n": [], "x": [], "xx": [], "y": [], "xy": []}
    for d in range(-HALF, HALF + 1):
        v = f"v{d + HALF}"
        cols.append(f"{'lag' if d < 0 else 'lead'}({Y}, {abs(d)}) OVER (PARTITION BY player_id ORDER BY {', '.join(GAME_ORDER)}) AS {v}")
        w = f"CASE WHEN {v} IS NULL THEN 0.0::DOUBLE ELSE {(1 - (abs(d) / (HALF + 1)) ** 3) ** 3!r} END"
        for name, term in (("n", w), ("x", f"{w} * {d}"), ("xx", f"{w} * {d * d}"), ("y", f"{w} * coalesce({v}, 0)"), ("xy", f"{w} * coalesce({v}, 0) * {d}")):
            sums[name].append(term)
    return f"""
WITH v AS (SELECT player_id, {', '.join(GAME_ORDER)}, {Y}, {', '.join(cols)} FROM starter_ewm WHERE {Y} IS NOT NULL),
s AS (SELECT *, {', '.join(f"{' + '.join(terms)} AS s_{name}" for name, terms in sums.items())} FROM v)
SELECT player_id, {', '.join(GAME_ORDER)}, {Y}, CASE WHEN s_n * s_xx - s_x * s_x > 1e-9
  THEN (s_y * s_xx - s_x * s_xy) / (s_n * s_xx - s_x * s_x) ELSE s_y / s_n END AS smooth FROM s"""


@query("local_line", _smooth_sql(), "smooth")
def local_line(t: Tables):
    """Passing yards of every starter, smoothed by lines over a fixed number of neighbouring games."""
    rows = settle(model_rows(t).select("player_id", *GAME_ORDER, Y))
    return M.local_smooth(rows, ["player_id"], GAME_ORDER, Y, HALF)


_THIRD = """
WITH s AS (SELECT player_id, season, week, game_id, passing_yards AS y, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY player_id) AS n
           FROM starter_ewm WHERE passing_yards IS NOT NULL WINDOW w AS (PARTITION BY player_id ORDER BY season, week, game_id)),
k AS (SELECT *, least(n, greatest(2, CAST(floor(0.7 * n + 1e-10) AS BIGINT))) AS k FROM s),
l AS (SELECT *, least(greatest(0, CAST(ceil(i - k / 2) AS BIGINT)), n - k) AS l FROM k),
h AS (SELECT *, greatest(i - l, l + k - 1 - i) AS h FROM l),
{passes}
SELECT player_id, season, week, game_id, h.y AS passing_yards, {last}.fit AS smooth
FROM h JOIN {last} USING (player_id, i)"""


def _lowess_sql(robust: int = 3) -> str:
    """The plain passes: every place against every place of its window."""
    parts, weight = [], "SELECT player_id, i, 1.0::DOUBLE AS w FROM h"
    for p in range(robust + 1):
        parts.append(f"w{p} AS ({weight})")
        parts.append(f"""m{p} AS (SELECT a.player_id, a.i, any_value(a.y) AS y, sum(v) AS s0, sum(v * d) AS s1, sum(v * d * d) AS s2, sum(v * z) AS t0, sum(v * d * z) AS t1
  FROM (SELECT a.player_id, a.i, a.y, b.y AS z, CAST(b.i - a.i AS DOUBLE) / a.h AS d,
               pow(1 - pow(abs(CAST(b.i - a.i AS DOUBLE)) / a.h, 3), 3) * w.w AS v
        FROM h a JOIN h b ON b.player_id = a.player_id AND b.i >= a.l AND b.i < a.l + a.k JOIN w{p} w ON w.player_id = b.player_id AND w.i = b.i
        WHERE a.n > 2) AS a GROUP BY a.player_id, a.i)""")
        parts.append(f"""f{p} AS (SELECT player_id, i, y, CASE WHEN s0 * s2 - s1 * s1 > 1e-9 * s0 * s0 THEN (t0 * s2 - s1 * t1) / (s0 * s2 - s1 * s1)
  WHEN s0 > 1e-12 THEN t0 / s0 ELSE y END AS fit FROM m{p} UNION ALL SELECT player_id, i, y, y FROM h WHERE n < 3)""")
        weight = f"""SELECT player_id, i, pow(1 - pow(CASE WHEN o > 0.999 THEN 1 WHEN o <= 0.001 THEN 0 ELSE o END, 2), 2) AS w
  FROM (SELECT player_id, i, abs(y - fit) / nullif(6 * median(abs(y - fit)) OVER (PARTITION BY player_id), 0) AS o FROM f{p})"""
    return _THIRD.format(passes=",\n".join(parts), last=f"f{robust}")


@query("lowess", _lowess_sql(), "smooth")
def lowess(t: Tables):
    """Smoothed passing yards of every starter: lines over 0.7 of their games, three passes against outliers."""
    return M.lowess(model_rows(t).select("player_id", *GAME_ORDER, Y), ["player_id"], GAME_ORDER, Y)


@query("out_of_fold_line", f"""
WITH r AS (SELECT game_id, player_id, {Y}, {X}, CAST(CAST('0x' || substr(md5(game_id || '|' || player_id || '|4416'), 1, 8)
             AS BIGINT) % 8 AS INT) AS fold FROM starter_ewm),
c AS (SELECT f.fold, regr_slope(r.{Y}, r.{X}) AS b, regr_intercept(r.{Y}, r.{X}) AS a
      FROM (SELECT DISTINCT fold FROM r) AS f JOIN r ON r.fold <> f.fold GROUP BY f.fold)
SELECT game_id, player_id, fold, {Y}, a + b * {X} AS oof FROM r JOIN c USING (fold)""", "oof")
def out_of_fold_line(t: Tables):
    """Out-of-fold predictions from one feature."""
    rows = model_rows(t).withColumn("fold", sets.hash_fold(IDS, 8, 4416))
    return M.out_of_fold(rows, [X], Y, "fold").select(*IDS, "fold", Y, "oof")


@query("walk_forward_line", f"""
WITH r AS (SELECT game_id, player_id, season, week, {Y}, {X} FROM starter_ewm),
w AS (SELECT season, week, row_number() OVER (ORDER BY season, week) AS i FROM (SELECT DISTINCT season, week FROM r)),
c AS (SELECT w.season, w.week, regr_slope(p.{Y}, p.{X}) AS b, regr_intercept(p.{Y}, p.{X}) AS a
      FROM w JOIN r AS p ON (p.season, p.week) < (w.season, w.week) WHERE w.i > 51 GROUP BY w.season, w.week)
SELECT game_id, player_id, season, week, {Y}, a + b * {X} AS preds FROM r JOIN c USING (season, week)""", "preds")
def walk_forward_line(t: Tables):
    """One-feature line refitted every week on everything played before."""
    return M.walk_forward(model_rows(t), [X], Y, alphas=(0.0,)).select(*IDS, "season", "week", Y, "preds")


def _equations(rows, residual, size):
    """What the score equations of a fit leave, as a share of their terms, to three places: 0 at the optimum."""
    terms = {"intercept": F.lit(1.0)} | {x: c(x).cast("double") for x in FEATURES}
    left = [F.struct(F.lit(n).alias("term"), F.round(F.abs(F.sum(residual * x)) / F.sum(F.abs(size * x)), 3).alias("left"))
            for n, x in terms.items()]
    return rows.agg(F.array(*left).alias("e")).select(F.inline("e"))


_ZEROS = " UNION ALL ".join(f"SELECT '{n}' AS term, 0.0::DOUBLE AS \"left\"" for n in ["intercept", *FEATURES])


@query("count_glm_equations", _ZEROS)
def count_glm_equations(t: Tables):
    """Checks the optimum of the Poisson fit, not single predictions."""
    rows = model_rows(t).withColumn("completions", F.greatest(c(Y) / 10, F.lit(0.0)).cast("int"))
    _, out = M.count_glm(rows, FEATURES, "completions")
    return _equations(out, c("completions") - c("count_pred"), c("count_pred"))


def counted_rows(t: Tables):
    return model_rows(t).withColumn("completions", F.greatest(c(Y) / 10, F.lit(0.0)).cast("int"))


@query("count_model")
def count_model(t: Tables):
    """Counts that vary more than their mean, with an effect of the player; the estimated size beside every prediction."""
    fixed, out = M.negative_binomial(counted_rows(t), FEATURES, "completions", "player_id", [*GAME_ORDER])
    return out.select(*IDS, "completions", "player_id_encoded", "count_pred", F.lit(fixed.get("size")).cast("double").alias("size"))


@query("count_model_equations", f"{_ZEROS} UNION ALL SELECT 'player_id_encoded', 0.0::DOUBLE UNION ALL SELECT 'size', 0.0::DOUBLE")
def count_model_equations(t: Tables):
    """Checks the optimum of the count model in all parameters: the size's equation by sums of reciprocals over each count."""
    fixed, out = M.negative_binomial(counted_rows(t), FEATURES, "completions", "player_id", [*GAME_ORDER])
    n, mean, size = c("completions").cast("double"), c("count_pred"), F.lit(fixed["size"])
    weight = size / (size + mean)
    terms = {"intercept": F.lit(1.0)} | {x: c(x).cast("double") for x in [*FEATURES, "player_id_encoded"]}
    left = [F.struct(F.lit(x).alias("term"), F.round(F.abs(F.sum((n - mean) * weight * v)) / F.sum(F.abs(mean * weight * v)), 3).alias("left"))
            for x, v in terms.items()]
    # digamma(count + size) - digamma(size) = 1 / size + ... + 1 / (size + count - 1)
    steps = F.when(c("completions") > 0, F.aggregate(F.sequence(F.lit(0), c("completions") - 1), F.lit(0.0), lambda s, i: s + 1 / (size + i))).otherwise(0.0)
    past = F.log(weight) + 1 - (n + size) / (size + mean)
    left.append(F.struct(F.lit("size").alias("term"), F.round(F.abs(F.sum(steps + past)) / F.sum(steps + F.abs(past)), 3).alias("left")))
    return out.agg(F.array(*left).alias("e")).select(F.inline("e"))


@query("gamma_equations", _ZEROS)
def gamma_equations(t: Tables):
    """Checks the optimum of the gamma fit, not single predictions."""
    out = M.gamma_regression(model_rows(t), FEATURES, Y)
    return _equations(out, (c(Y) - c("gamma_pred")) / c("gamma_pred"), F.lit(1.0))


@query("quantile_coverage", """
SELECT * FROM (VALUES ('q5', 0.05::DOUBLE, true), ('q50', 0.5::DOUBLE, true), ('q95', 0.95::DOUBLE, true)) AS v(name, level, covered)""")
def quantile_coverage(t: Tables):
    """A quantile fit leaves as many rows below it as its level says, but for those it passes through (one per
    coefficient) and a half per cent."""
    rows = quantile_regression(t)
    levels = {"q5": 0.05, "q50": 0.5, "q95": 0.95}
    n = F.count(c(Y))
    entries = []
    for name, p in levels.items():
        below = F.sum(F.when(c(Y) <= c(name), 1).otherwise(0))
        slack = 0.005 * n + len(FEATURES) + 1
        entries.append(F.struct(F.lit(name).alias("name"), F.lit(p).alias("level"), (F.abs(below - p * n) <= slack).alias("covered")))
    return rows.filter(c("q50").isNotNull()).agg(F.array(*entries).alias("e")).select(F.inline("e"))
