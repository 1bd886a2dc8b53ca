"""Column expressions: dates and ids, odds, distance, scoring."""

from __future__ import annotations

import math
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371

# Name corrections.
STADIUM_NAMES = {
    "Hubert H. Humphrey Metrodome": "Hubert H Humphrey Metrodome",
    "Foxboro Stadium": "Foxboro",
    "Veterans Stadium": "Nassau Veterans Memorial Coliseum",
    "3Com Park": "Candlestick Park",
}
REFEREE_NAMES = {
    "Adrian Hall": "Adrian Hill",
    "Bill Vinocich": "Bill Vinovich",
    "Gene Stetatore": "Gene Steratore",
    "John Perry": "John Parry",
}
PASSER_NAMES = {
    "Ty.Taylor": "T.Taylor",
    "Aa.Rodgers": "A.Rodgers",
    "Alex Smith": "A.Smith",
    "Jos.Smith": "J.Smith",
}
# Franchise moves as (old code, new code, first season under the new code).
FRANCHISE_MOVES = [("OAK", "LV", 2020), ("STL", "LA", 2016), ("SD", "LAC", 2017)]
# The neutral site whose home team plays elsewhere, and that stadium's coordinates.
NEUTRAL_SITE, HOME_SITE, HOME_LAT, HOME_LONG = "Wembley Stadium", "Hard Rock Stadium", 25.95796, -80.239311
OVERSEAS_KM = 4400
# Points a defence scores by points allowed, as (low, high, score).
POINTS_ALLOWED = [(None, 6, 7), (7, 13, 4), (14, 20, 1), (21, 27, 0), (28, 34, -1), (35, 100, -4)]


def half_even(x: Column, places: int) -> Column:
    """Round half to even on the scaled value, as array libraries do."""
    scale = float(10**places)
    return F.rint(x.cast("double") * F.lit(scale)) / F.lit(scale)


def flag(cond: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(cond, 1).otherwise(0)


def id_part(game_id: Column, i: int) -> Column:
    return F.split_part(game_id, F.lit("_"), F.lit(i + 1))


def zfill(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole."""
    text = value.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def build_game_id(season: Column, week: Column, away: Column, home: Column) -> Column:
    return F.concat_ws("_", season.cast("string"), zfill(week, 2), away, home)


def map_value(col: Column, mapping: dict, default: Column | None = None) -> Column:
    """Replace by lookup; values outside the mapping become ``default`` (null when omitted)."""
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    found = F.try_element_at(pairs, col)
    return found if default is None else F.coalesce(found, default)


def franchise(team: Column, season: Column) -> Column:
    return reduce(
        lambda out, m: F.when((team == m[0]) & (season < m[2]), m[1]).otherwise(out), FRANCHISE_MOVES, team
    )


def normalise_name(name: Column) -> Column:
    """First two dot-separated parts, blanks after the dot removed; names without a dot stay."""
    parts = F.split(name, r"\.")
    return F.when(F.size(parts) > 1, F.concat_ws(".", parts[0], F.ltrim(parts[1]))).otherwise(name)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2.0)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def moneyline_probability(line: Column) -> Column:
    """Win probability implied by a moneyline, bookmaker margin included."""
    size = F.abs(line).cast("double")
    share = size / (size + 100)
    return F.when(line < 0, share).otherwise(1 - share)


def without_margin(p: Column, other: Column) -> Column:
    return p / (p + other)


def band_score(points: Column, bands=POINTS_ALLOWED) -> Column:
    """Step function over inclusive bands; 0 outside all of them."""
    out = F.lit(0)
    for low, high, score in reversed(bands):
        inside = points <= high if low is None else points.between(low, high)
        out = F.when(inside, score).otherwise(out)
    return out


def team_spread(spread: Column, is_home: Column) -> Column:
    return F.when(is_home, -spread).otherwise(spread)


def implied_points(total: Column, spread: Column) -> Column:
    return total / 2 - spread / 2


def opponent(team: Column, home: Column, away: Column) -> Column:
    return F.when(home == team, away).otherwise(home)


def game_date(year: Column, mmdd: Column) -> Column:
    """Date from a number like 1107; January and February belong to the next year."""
    text = mmdd.cast("string")
    month = F.substr(text, F.lit(1), F.length(text) - 2).cast("int")
    day = F.right(text, F.lit(2)).cast("int")
    return F.make_date(F.when(month.isin(1, 2), year + 1).otherwise(year), month, day)


def season_of(date: Column) -> Column:
    return F.when(F.month(date).isin(1, 2), F.year(date) - 1).otherwise(F.year(date))


def interval_residual(low: Column, high: Column, actual: Column) -> Column:
    """How far a value lies outside an interval; 0 inside."""
    return F.greatest(low - actual, F.lit(0.0)) + F.greatest(actual - high, F.lit(0.0))


# Fantasy scoring coefficients per stat; a bonus is (stat, at least, points).
SCORING = {
    "pass_dk": ({"touchdown": 4, "pass_yards": 0.04, "interception": -1, "rush_td": 6, "rush_yds": 0.1, "fumbles": -1},
                [("pass_yards", 300, 3), ("rush_yds", 100, 3)]),
    "pass_fd": ({"touchdown": 4, "pass_yards": 0.04, "interception": -1, "rush_td": 6, "rush_yds": 0.1, "fumbles": -2}, []),
    "rush_dk": ({"rush_yds": 0.1, "rush_td": 6, "fumbles": -1}, [("rush_yds", 100, 3)]),
    "rush_fd": ({"rush_yds": 0.1, "rush_td": 6, "fumbles": -2}, []),
    "rec_dk": ({"rec_yards": 0.1, "td": 6, "rec": 1}, [("rec_yards", 100, 3)]),
    "rec_fd": ({"rec_yards": 0.1, "td": 6, "rec": 0.5}, []),
    "kick": ({"pats": 1, "fg_0_39": 3, "fg_40_49": 4, "fg_50_on": 5}, []),
    "defence": ({"def_int": 2, "def_sack": 1, "safety": 2, "kick_blocked": 2, "def_td": 6}, []),
}


def fantasy_points(rule: str) -> Column:
    weights, bonuses = SCORING[rule]
    terms = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
    terms += [flag(F.col(c) >= at) * F.lit(float(p)) for c, at, p in bonuses]
    return reduce(lambda a, b: a + b, terms)


# Coefficients of a published approximation of the error function (error below 1.5e-7).
ERF = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
ERF_SCALE = 0.3275911


def normal_cdf(z: Column) -> Column:
    """Distribution function of the standard normal."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + ERF_SCALE * x)
    poly = F.lit(0.0)
    for a in reversed(ERF):
        poly = (poly + a) * t
    half = poly * F.exp(-x * x) / 2
    return F.when(z < 0, half).otherwise(1 - half)
