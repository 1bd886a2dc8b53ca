"""Features over ordered rows of an entity: lags, rolling, expanding and exponentially weighted values.

``add_features`` computes any number of them over one (keys, order) pair. Features that exclude the
current row never see it, so they can be used to predict it.

Two families:

* *near* features read a bounded number of neighbours (lag, lead, rolling mean, slope, EWM);
* *running* features fold everything before the row (expanding mean, maximum, sum, fill forward).

While the largest entity fits in a task they are plain windows sharing one shuffle and one sort. Beyond
that, near features run on position chunks that also hold copies of their neighbours, and running
features run on chunks whose totals are folded and joined back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from yardline.operators.skew import GROUP_FLOOR, GroupSizes, group_sizes, join_on, ordering, with_position
from yardline.session import settle

POS = "_pos"
_FIRST = Window.unboundedPreceding


# --- near features -----------------------------------------------------------------------------------
@dataclass(frozen=True)
class Lag:
    col: str
    n: int = 1

    @property
    def reach(self) -> tuple[int, int]:
        return self.n, 0

    def column(self, w: WindowSpec, base: Column) -> Column:
        return F.lag(self.col, self.n).over(w)


@dataclass(frozen=True)
class Lead:
    col: str
    n: int = 1

    @property
    def reach(self) -> tuple[int, int]:
        return 0, self.n

    def column(self, w: WindowSpec, base: Column) -> Column:
        return F.lead(self.col, self.n).over(w)


@dataclass(frozen=True)
class RollingMean:
    """Mean of the n rows before this one; null until n values exist unless ``partial``."""

    col: str
    n: int
    partial: bool = False

    @property
    def reach(self) -> tuple[int, int]:
        return self.n, 0

    def column(self, w: WindowSpec, base: Column) -> Column:
        frame = w.rowsBetween(-self.n, -1)
        mean = F.avg(self.col).over(frame)
        return mean if self.partial else F.when(F.count(self.col).over(frame) >= self.n, mean)


@dataclass(frozen=True)
class RollingSlope:
    """Least-squares slope of the last n values (this row included) on their position; 0 for one point."""

    col: str
    n: int = 25

    @property
    def reach(self) -> tuple[int, int]:
        return self.n, 0

    def column(self, w: WindowSpec, base: Column) -> Column:
        slope = F.regr_slope(F.col(self.col), (F.col(POS) - base).cast("double"))
        return F.coalesce(slope.over(w.rowsBetween(-(self.n - 1), 0)), F.lit(0.0))


@dataclass(frozen=True)
class Ewm:
    """Exponentially weighted mean with decay by position; a null row repeats the last value.

    Give exactly one of ``alpha``, ``span`` and ``com``. The weights (1-alpha)^(-position) are taken
    relative to a base, so that only their ratio counts; ``safe_rows`` bounds the rows for which they
    stay inside a double.
    """

    col: str
    alpha: float | None = None
    span: float | None = None
    com: float | None = None
    shift: bool = True

    @property
    def decay(self) -> float:
        given = [v for v in (self.alpha, self.span, self.com) if v is not None]
        if len(given) != 1:
            raise ValueError("give one of alpha, span and com")
        if self.alpha is not None:
            a = self.alpha
        elif self.span is not None:
            a = 2.0 / (self.span + 1.0)
        else:
            a = 1.0 / (1.0 + self.com)
        if not 0 < a < 1:
            raise ValueError("alpha must lie between 0 and 1")
        return 1.0 - a

    @property
    def rate(self) -> float:
        return -math.log(self.decay)

    @property
    def safe_rows(self) -> int:
        return int(600 / self.rate)

    @property
    def memory(self) -> int:
        """Rows after which a value's weight is below 1e-17 of the latest one."""
        return math.ceil(40 / self.rate)

    @property
    def reach(self) -> tuple[int, int]:
        return 2 * self.memory, 0

    @property
    def chunk_rows(self) -> int:
        return max(2 * self.memory, self.safe_rows - 2 * self.memory)

    def column(self, w: WindowSpec, base: Column) -> Column:
        frame = w.rowsBetween(_FIRST, -1 if self.shift else Window.currentRow)
        x = F.col(self.col).cast("double")
        weight = F.pow(F.lit(self.decay), (base - F.col(POS)).cast("double"))
        mean = F.try_divide(F.sum(x * weight).over(frame), F.sum(F.when(x.isNotNull(), weight)).over(frame))
        # in a later chunk the copies reach two memories back; a value whose latest input is older than
        # one memory is left null here and repeats the last valid one (``add_features`` fills it)
        latest = F.max(F.when(x.isNotNull(), F.col(POS))).over(frame)
        return F.when((base == 0) | (latest > base - self.memory), mean)


Near = Lag | Lead | RollingMean | RollingSlope | Ewm


# --- running features --------------------------------------------------------------------------------
@dataclass(frozen=True)
class Running:
    """Fold of the rows before this one (or up to it): named parts, and how to combine them."""

    parts: tuple[tuple[str, str, str], ...]  # (name, kind, SQL input); kind is sum, max or last
    finish: Callable[[dict[str, Column]], Column]
    shift: bool = True


_FOLD = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}


def _mean_parts(col: str) -> tuple[tuple[str, str, str], ...]:
    x = f"CAST(`{col}` AS DOUBLE)"
    return (("s", "sum", x), ("n", "sum", f"IF(`{col}` IS NULL, 0L, 1L)"))


def expanding_mean(col: str) -> Running:
    return Running(_mean_parts(col), lambda p: F.try_divide(p["s"], p["n"]))


def prior_totals(col: str) -> Running:
    """Struct of sum and count of the values before this row."""
    return Running(
        _mean_parts(col),
        lambda p: F.struct(F.coalesce(p["s"], F.lit(0.0)).alias("total"), F.coalesce(p["n"], F.lit(0)).alias("n")),
    )


def expanding_max(col: str) -> Running:
    return Running((("m", "max", f"`{col}`"),), lambda p: p["m"])


def expanding_fraction(col: str, above: float, default: float = 1.0) -> Running:
    """Share of earlier rows above a bound; row t divides by t, and rows without an earlier value take
    the default."""
    return Running(
        (
            ("hits", "sum", f"IF(`{col}` > {above}D, 1L, 0L)"),
            ("rows", "sum", "1L"),
            ("seen", "sum", f"IF(`{col}` IS NULL, 0L, 1L)"),
        ),
        lambda p: F.when(F.coalesce(p["seen"], F.lit(0)) > 0, p["hits"].cast("double") / (p["rows"] + 1)).otherwise(
            F.lit(default)
        ),
    )


def cumulative_sum(col: str, shift: bool = False) -> Running:
    return Running((("s", "sum", f"`{col}`"),), lambda p: p["s"], shift)


def running_count(start: int = 0) -> Running:
    return Running((("n", "sum", "1L"),), lambda p: F.coalesce(p["n"], F.lit(0)) + F.lit(start).cast("long"))


def fill_forward(col: str) -> Running:
    return Running((("v", "last", f"`{col}`"),), lambda p: p["v"], shift=False)


Feature = Near | Running


# --- evaluation --------------------------------------------------------------------------------------
def add_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: dict[str, Feature],
    *,
    descending: bool = False,
    floor: int | None = None,
    row_bound: int | None = None,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Add the named features. ``order`` must be total within ``keys``.

    ``row_bound``: rows of ``df`` are known not to exceed it (for instance the count of the table it was
    aggregated from). When that already fits in a task no size is measured. ``sizes``: what
    ``group_sizes`` measured for these rows and keys before.
    """
    ewms = [f for f in features.values() if isinstance(f, Ewm)]
    safe = min((f.safe_rows for f in ewms), default=None)
    if row_bound is not None and floor is None and row_bound <= (GROUP_FLOOR if safe is None else safe):
        return _in_one_window(df, keys, order, features, descending)
    sizes = sizes or group_sizes(df, keys, floor, safe)
    if sizes.fits and (safe is None or sizes.largest <= safe):
        return _in_one_window(df, keys, order, features, descending)
    return _in_chunks(df, keys, order, features, descending, sizes)


def settled_beyond(df: DataFrame, row_bound: int | None = None, floor: int | None = None) -> DataFrame:
    """``df`` written once where ``add_features`` is going to measure it, so that counts, groups and the windows
    read its rows instead of running its plan again each time."""
    return df if row_bound is not None and floor is None and row_bound <= GROUP_FLOOR else settle(df)


def add_expanding_means(
    df: DataFrame,
    by: dict[str, Sequence[str]],
    unit: Sequence[str],
    order: Sequence[str],
    col: str,
    *,
    floor: int | None = None,
    row_bound: int | None = None,
) -> DataFrame:
    """Expanding means of one column before each row, ordered by ``unit`` and then ``order``: a name and its keys each.

    Like ``add_features``, for groups made of many small units (the games of a season). A unit's totals are carried
    over the units before it and enter its rows as one more row in front, so rows move once, by unit, for
    all the means, and no group is gathered. A unit that a task can't take leaves all to ``add_features``.
    """
    whole = [*unit, *order]
    keys = list(dict.fromkeys(k for ks in by.values() for k in ks))
    plain = row_bound is not None and floor is None and row_bound <= GROUP_FLOOR
    if not plain:
        x = F.col(col).cast("double")
        sums = (F.sum(x).alias("_s"), F.count(x).alias("_n"), F.count(F.lit(1)).alias("_rows"))
        totals = settle(df.groupBy(*dict.fromkeys([*keys, *unit])).agg(*sums))
        largest = totals.groupBy(*unit).agg(F.sum("_rows").alias("_rows")).agg(F.max("_rows")).first()[0] or 0
        plain = largest > (GROUP_FLOOR if floor is None else floor)
    if plain:
        for name, ks in by.items():
            df = add_features(df, ks, whole, {name: expanding_mean(col)}, floor=floor, row_bound=row_bound)
        return df
    here = len(by)  # rows come after the carried totals of each mean
    rows = df.withColumns({"_at": F.lit(here), "_s": F.lit(None).cast("double"), "_n": F.lit(None).cast("long")})
    for i, ks in enumerate(by.values()):
        units = totals.groupBy(*dict.fromkeys([*ks, *unit])).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
        carried = {n: cumulative_sum(n, shift=True) for n in ("_s", "_n")}
        front = add_features(settle(units), ks, unit, carried, floor=floor).filter(F.col("_n") > 0)
        rows = rows.unionByName(front.withColumn("_at", F.lit(i)), allowMissingColumns=True)
    rows = rows.repartition(*unit)
    own = F.col("_at") == here
    for i, (name, ks) in enumerate(by.items()):
        before = Window.partitionBy(*dict.fromkeys([*unit, *ks])).orderBy("_at", *ordering(order)).rowsBetween(_FIRST, -1)
        front = F.col("_at") == i
        total = F.sum(F.when(own, F.col(col).cast("double")).when(front, F.col("_s"))).over(before)
        n = F.sum(F.when(own, F.col(col).isNotNull().cast("long")).when(front, F.col("_n"))).over(before)
        rows = rows.withColumn(name, F.try_divide(total, n))
    return rows.filter(own).select(*df.columns, *by)


def _in_one_window(df, keys, order, features, descending) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*ordering(order, descending))
    needs_pos = any(isinstance(f, Ewm | RollingSlope) for f in features.values())
    cols = df.columns
    if needs_pos:
        df = df.withColumn(POS, F.row_number().over(w).cast("long"))
    zero = F.lit(0).cast("long")
    out = []
    for name, f in features.items():
        if isinstance(f, Running):
            frame = w.rowsBetween(_FIRST, -1 if f.shift else Window.currentRow)
            out.append(f.finish({p: _FOLD[kind](F.expr(c)).over(frame) for p, kind, c in f.parts}).alias(name))
        else:
            out.append(f.column(w, zero).alias(name))
    return df.select(*[c for c in cols if c not in features], *out)


def _in_chunks(df, keys, order, features, descending, sizes: GroupSizes) -> DataFrame:
    cols = [c for c in df.columns if c not in features]
    clash = {n: f"_new_{n}" for n in features if n in df.columns}
    if clash:  # a feature replaces a column, which others may still read
        renamed = {clash.get(n, n): f for n, f in features.items()}
        out = _in_chunks(df, keys, order, renamed, descending, sizes).drop(*clash)
        return out.withColumnsRenamed({new: n for n, new in clash.items()}).select(*cols, *features)
    placed = with_position(df, keys, order, POS, descending=descending, sizes=sizes)
    by_chunk: dict[int, dict[str, Near]] = {}
    for name, f in features.items():
        if not isinstance(f, Running):
            size = f.chunk_rows if isinstance(f, Ewm) else max(sizes.limit, *f.reach)
            by_chunk.setdefault(size, {})[name] = f
    for size, feats in by_chunk.items():
        placed = _near_in_chunks(placed, keys, feats, size)
    running = {n: f for n, f in features.items() if isinstance(f, Running)}
    fills = {n: fill_forward(n) for n, f in features.items() if isinstance(f, Ewm)}
    if fills:
        held = {f"_fill_{n}": f for n, f in fills.items()}
        placed = _running_in_chunks(placed, keys, held, sizes.limit)
        placed = placed.drop(*fills).withColumnsRenamed({f"_fill_{n}": n for n in fills})
    if running:
        placed = _running_in_chunks(placed, keys, running, sizes.limit)
    return placed.select(*cols, *features)


def _chunk_of(size: int) -> Column:
    return F.floor((F.col(POS) - 1) / F.lit(size)).cast("long")


def _near_in_chunks(placed: DataFrame, keys, features: dict[str, Near], size: int) -> DataFrame:
    back = max(f.reach[0] for f in features.values())
    ahead = max(f.reach[1] for f in features.values())
    own, inside = _chunk_of(size), (F.col(POS) - 1) % F.lit(size)
    homes = F.array_compact(
        F.array(
            own,
            F.when(inside >= size - back, own + 1),
            F.when((inside < ahead) & (own > 0), own - 1),
        )
    )
    rows = placed.withColumn("_chunk", F.explode(homes))
    w = Window.partitionBy(*keys, "_chunk").orderBy(POS)
    base = F.col("_chunk") * F.lit(size)
    rows = rows.select("*", *[f.column(w, base).alias(n) for n, f in features.items()])
    return rows.filter(F.col("_chunk") == _chunk_of(size)).drop("_chunk")


def _running_in_chunks(placed: DataFrame, keys, features: dict[str, Running], size: int) -> DataFrame:
    rows = placed.withColumn("_chunk", _chunk_of(size))
    parts = [(f"_{n}_{p}", kind, c) for n, f in features.items() for p, kind, c in f.parts]
    by_pos = {
        "sum": F.sum,
        "max": F.max,
        "last": lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(POS))),
    }
    totals = rows.groupBy(*keys, "_chunk").agg(*[by_pos[kind](F.expr(c)).alias(a) for a, kind, c in parts])
    # at most total/limit chunks per group, so this window is small for every key
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(_FIRST, -1)
    carried = totals.select(
        *keys, "_chunk", *[_FOLD[kind](F.col(a)).over(earlier).alias(f"{a}_carry") for a, kind, _ in parts]
    )
    w = Window.partitionBy(*keys, "_chunk").orderBy(POS)
    local = []
    for n, f in features.items():
        frame = w.rowsBetween(_FIRST, -1 if f.shift else Window.currentRow)
        local += [_FOLD[kind](F.expr(c)).over(frame).alias(f"_{n}_{p}") for p, kind, c in f.parts]
    rows = join_on(rows.select("*", *local), carried, [*keys, "_chunk"], "left")
    out = []
    for n, f in features.items():
        whole = {p: _combine(kind, F.col(f"_{n}_{p}_carry"), F.col(f"_{n}_{p}")) for p, kind, _ in f.parts}
        out.append(f.finish(whole).alias(n))
    return rows.select(*placed.columns, *out)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry + local, carry, local)
    if kind == "max":
        return F.greatest(carry, local)
    return F.coalesce(local, carry)

