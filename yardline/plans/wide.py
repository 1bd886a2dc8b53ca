"""Weekly refits on numbers, small categories and one category with any number of values, such as the player.

A row is its numbers and the columns of the small categories (``_z``, with a leading 1), and its player. One indicator column a
player makes the players' part of the normal equations a diagonal, so the players are solved for and drop out: a player with
``n`` rows whose columns sum to ``s`` and whose targets sum to ``q`` has the effect ``(q - s.b) / (n + penalty)``, whatever the
other coefficients ``b`` are, and leaves ``s s' / (n + penalty)`` in their equations. Tasks go through the rows player by player
and add up these small matrices for all weeks at once; no column per player is made, and nothing that grows with the players
leaves the tasks. The driver holds a few numbers per week, coefficient and pair of coefficients, which the calendar
and the small categories bound.

* Ridge: one pass, exact; the penalty by generalised cross-validation, for which the players' traces are added up too.
* Elastic net: the other coefficients and the players' effects in turn, for all weeks, folds and penalties at once, and Newton steps
  for fits that are slow to rest; the penalty and its mix by cross-validation.
* Huber: weights depend on the fit, so each pass finds the players' effects given the rest, and adds up the weighted equations.

A category counts from ``at_least`` rows before the week on; until then its rows share a column, as do values not seen before.
Numbers are standardised by the rows before the week. A player's rows are held by one task: the games of one career.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.operators.sets import hash_fold
from yardline.session import settle

MODELS = ("ridge", "en", "huber")
MOST_VALUES = 200  # of a small category; each is a column
SPREAD = 32  # first sums of what tasks send
BLOCK_BYTES = 1 << 20  # of these at once


@dataclass
class Design:
    """Columns and weeks of the fits. The last coefficient is that of the players who are too rare for one of their own."""

    numbers: list[str]
    groups: list[tuple[int, int]]  # columns of the small categories
    weeks: int  # of the calendar
    first: int  # that gets predictions
    folds: int
    at_least: int

    @property
    def size(self) -> int:
        return self.groups[-1][1] if self.groups else 1 + len(self.numbers)

    @property
    def fitted(self) -> np.ndarray:
        return np.arange(self.first, self.weeks)


# --- rows --------------------------------------------------------------------------------------------
def encoded(
    df: DataFrame, numbers: Sequence[str], small: Sequence[str], player: str, y: str, ids: Sequence[str], *, at_least: int, first_week: int, folds: int
) -> tuple[DataFrame, Design]:
    """Rows by player with _t (number of the week), _z, _y, _fold; persisted, so every pass reads them where they are."""
    weeks = [tuple(r) for r in df.select("season", "week").distinct().collect()]  # the calendar
    kinds = {n: df.schema[n].dataType.simpleString() for n in ("season", "week")}
    calendar = [(s, w, i) for i, (s, w) in enumerate(sorted(w for w in weeks if None not in w))]
    calendar = df.sparkSession.createDataFrame(calendar, f"_season {kinds['season']}, _week {kinds['week']}, _t int")
    columns = [F.lit(1.0), *[F.col(n).cast("double") for n in numbers]]
    groups = []
    for name in small:
        values = [r[0] for r in df.select(F.col(name).cast("string")).distinct().limit(MOST_VALUES + 1).collect()]
        if len(values) > MOST_VALUES:
            raise ValueError(f"{name} has more than {MOST_VALUES} values")
        groups.append((len(columns), len(columns) + len(values)))
        columns += [F.col(name).cast("string").eqNullSafe(v).cast("double") for v in sorted(values, key=lambda v: (v is not None, v))]
    known = F.lit(True)
    for n in numbers:
        known = known & F.col(n).isNotNull() & ~F.isnan(F.col(n).cast("double"))
    rows = df.join(F.broadcast(calendar), (F.col("season") == F.col("_season")) & (F.col("week") == F.col("_week")), "left").drop("_season", "_week")
    rows = rows.withColumns(
        {
            "_p": F.coalesce(F.concat(F.lit("="), F.col(player).cast("string")), F.lit("")),
            "_t": F.coalesce("_t", F.lit(-1)),
            "_z": F.when(known, F.array(*columns)),
            "_y": F.col(y).cast("double"),
            "_fold": hash_fold(ids, folds, 4416),
        }
    )
    rows = rows.repartition("_p").sortWithinPartitions("_p", "_t").persist(StorageLevel.MEMORY_AND_DISK)
    return rows, Design(list(numbers), groups, len(weeks), first_week + 1, folds, at_least)


@dataclass
class Player:
    """Rows of a player: those that can be trained on, by week."""

    rows: pa.Table
    t: np.ndarray
    z: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    def upto(self, weeks: np.ndarray) -> np.ndarray:
        """Rows before each week."""
        return np.searchsorted(self.t, weeks)

    def sums(self, folds: int) -> np.ndarray:
        """Running sums of (columns, target) by fold: [rows before, fold, column]."""
        own = np.column_stack((self.z, self.y))
        out = np.zeros((len(self.t) + 1, folds, own.shape[1]))
        for f in range(folds):
            np.cumsum(own * (self.fold == f)[:, None], axis=0, out=out[1:, f])
        return out


def players(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Player]:
    """The players of a task's rows, one after the other."""

    def made(rows: pa.Table) -> Player:
        rows = rows.combine_chunks()
        y, t = rows["_y"].to_numpy(), rows["_t"].to_numpy()
        ok = pc.is_valid(rows["_z"]).to_numpy(zero_copy_only=False) & np.isfinite(y) & (t >= 0)
        kept = rows.filter(pa.array(ok))
        z = kept["_z"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        return Player(rows, t[ok], z, y[ok], rows["_fold"].to_numpy()[ok])

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        name = table["_p"].combine_chunks()
        fresh = pc.not_equal(name.slice(1), name.slice(0, len(name) - 1)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(fresh) + 1).tolist()]
        for a, b in zip(edges, edges[1:], strict=False):
            yield made(table.slice(a, b - a))
        held = table.slice(edges[-1])
    if held is not None:
        yield made(held)


def added(
    rows: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]], count: int, shapes: dict[str, tuple[int, ...]]
) -> dict[str, np.ndarray]:
    """Sums of the arrays [count, *shape] that tasks give; in two levels and by blocks of rows, so that no task adds up or holds what all
    others send."""
    width = sum(int(np.prod(s)) for s in shapes.values())
    block = max(1, BLOCK_BYTES // (8 * max(width, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % SPREAD
        flat = np.concatenate([v.reshape(count, -1) for v in step(batches).values()], axis=1)
        for i in range(0, count, block):
            own = flat[i : i + block]
            if own.any():
                yield pa.record_batch([pa.array([i]), pa.array([part]), pa.array([own.tobytes()])], names=["key", "part", "v"])

    def total(table: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(v.as_buffer(), np.float64) for v in table["v"])
        return pa.table([table["key"][:1], table["part"][:1], pa.array([out.tobytes()])], names=["key", "part", "v"])

    schema = "key long, part long, v binary"
    sums = rows.mapInArrow(run, schema).groupBy("key", "part").applyInArrow(total, schema).groupBy("key").applyInArrow(total, schema)
    flat = np.zeros((count, width))
    for r in sums.toArrow().to_pylist():
        own = np.frombuffer(r["v"], np.float64).reshape(-1, width)
        flat[r["key"] : r["key"] + len(own)] = own
    out, at = {}, 0
    for n, shape in shapes.items():
        length = int(np.prod(shape))
        out[n] = flat[:, at : at + length].reshape(count, *shape)
        at += length
    return out


# --- sums of all weeks -------------------------------------------------------------------------------
def gather(rows: DataFrame, d: Design, alphas: Sequence[float]) -> dict[str, np.ndarray]:
    """What is known before each week, [week, ...]: per fold products of (columns, target) and sums of rare players' rows; per penalty
    what the other players leave."""
    k, folds = d.size, d.folds
    a = len(alphas)
    shapes = {"gram": (folds, k + 1, k + 1), "rare": (folds, k + 1), "m1": (a, k + 1, k + 1), "m2": (a, k + 1, k + 1), "c": (a, 2)}

    def step(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        acc = {n: np.zeros((d.weeks + 1, *shape)) for n, shape in shapes.items()}
        for p in players(batches, k):
            if not len(p.t):
                continue
            own = np.column_stack((p.z, p.y))
            last = np.append(p.t[1:] != p.t[:-1], True)
            at = p.t[last] + 1  # known from the week after
            for i in range(0, len(own), 4096):
                part = own[i : i + 4096]
                np.add.at(acc["gram"], (p.t[i : i + 4096] + 1, p.fold[i : i + 4096]), part[:, :, None] * part[:, None, :])
            sums = p.sums(folds)[1:][last]
            u = sums.sum(axis=1)
            n = u[:, 0]
            often = n >= d.at_least
            change = lambda v: np.diff(v, axis=0, prepend=0)
            acc["rare"][at] += change(np.where(often[:, None, None], 0, sums))
            uu = np.where(often[:, None, None], u[:, :, None] * u[:, None, :], 0)
            for i, alpha in enumerate(alphas):
                w = 1 / (n + alpha)
                acc["m1"][at, i] += change(uu * w[:, None, None])
                acc["m2"][at, i] += change(uu * (w * w)[:, None, None])
                acc["c"][at, i] += change(np.column_stack((np.where(often, w, 0), often)))
        return acc

    return {n: np.cumsum(v, axis=0)[d.fitted] for n, v in added(rows, step, d.weeks + 1, shapes).items()}


class Equations:
    """Products of the columns before each week, with the column of rare players, for any set of folds."""

    def __init__(self, d: Design, known: dict[str, np.ndarray]) -> None:
        k = d.size
        gram, rare = known["gram"], known["rare"]
        weeks, folds = gram.shape[:2]
        full = np.zeros((weeks, folds, k + 1, k + 1))
        full[:, :, :k, :k] = gram[:, :, :k, :k]
        full[:, :, :k, k] = full[:, :, k, :k] = rare[:, :, :k]
        full[:, :, k, k] = rare[:, :, 0]
        zy = np.concatenate((gram[:, :, :k, k], rare[:, :, k:]), axis=2)
        # the last entry is all folds
        self.folds = full
        self.gram = np.concatenate((full.sum(axis=1, keepdims=True) - full, full.sum(axis=1, keepdims=True)), axis=1)
        self.zy = np.concatenate((zy.sum(axis=1, keepdims=True) - zy, zy.sum(axis=1, keepdims=True)), axis=1)
        self.own_zy, self.own_yy = zy, gram[:, :, k, k]
        self.yy, self.n = self.own_yy.sum(axis=1), self.gram[:, -1, 0, 0]
        self.map, self.penalty, self.there = self._columns(d)

    def _columns(self, d: Design) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per week: coefficients of the columns from those that are fitted (rare values share one, numbers are standardised),
        which of these are penalised, and which there are."""
        k = d.size
        maps, penalties, used = [], [], []
        for w in range(len(self.n)):
            whole, n = self.gram[w, -1], self.n[w]
            m, pen = np.zeros((k + 1, k + 1)), np.ones(k + 1)
            m[0, 0], pen[0] = 1.0, 0.0
            mean = whole[0] / max(n, 1)
            var = np.diag(whole) / max(n, 1) - mean**2
            for j in range(1, 1 + len(d.numbers)):
                if var[j] > 1e-12 * max(1.0, mean[j] ** 2):
                    sd = np.sqrt(var[j])
                    m[j, j], m[0, j] = 1 / sd, -mean[j] / sd
            for a, b in d.groups:
                rare = [j for j in range(a, b) if whole[0, j] < d.at_least]
                for j in set(range(a, b)) - set(rare):
                    m[j, j] = 1.0
                if any(whole[0, j] > 0 for j in rare):
                    m[rare, rare[0]] = 1.0
            if whole[k, k] > 0:
                m[k, k] = 1.0
            there = m.any(axis=0)
            maps.append(m)
            penalties.append(pen * there)
            used.append(there)
        shape = (len(self.n), k + 1)
        return np.array(maps).reshape(*shape, k + 1), np.array(penalties).reshape(shape), np.array(used, bool).reshape(shape)


# --- ridge -------------------------------------------------------------------------------------------
def ridge(eq: Equations, known: dict[str, np.ndarray], alphas: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients of the columns, penalty and residual variance per week, by the lowest score of generalised cross-validation."""
    weeks, k = len(eq.n), eq.map.shape[1] - 1
    coefs, best, variance = np.zeros((weeks, k + 1)), np.zeros(weeks), np.ones(weeks)
    for w in range(weeks):
        m, n = eq.map[w], eq.n[w]
        lowest = np.inf
        for i, alpha in enumerate(alphas):
            m1, m2 = known["m1"][w, i], known["m2"][w, i]
            block = lambda x: np.pad(x[:k, :k], ((0, 1), (0, 1)))  # noqa: E731  rare players have no effect of their own
            one, two = m.T @ block(m1) @ m, m.T @ block(m2) @ m
            a = m.T @ eq.gram[w, -1] @ m - one + np.diag(alpha * eq.penalty[w] + ~eq.there[w])
            v1, v2 = np.append(m1[:k, k], 0), np.append(m2[:k, k], 0)
            b = m.T @ (eq.zy[w, -1] - v1)
            inverse = np.linalg.pinv(a, hermitian=True)
            x = inverse @ b
            beta = m @ x
            effects = m2[k, k] - 2 * beta @ v2 + x @ two @ x
            rss = eq.yy[w] - beta @ (eq.zy[w, -1] - v1) - m1[k, k] - alpha * (x * eq.penalty[w] @ x + effects)
            lost = alpha * (np.trace(inverse * eq.penalty[w]) + known["c"][w, i, 0] + np.trace(inverse @ two))
            free = n - (eq.there[w].sum() + known["c"][w, i, 1] - lost)
            score = n * max(rss, 0.0) / free**2 if free > 0 else np.inf
            if score < lowest or not i:
                lowest, coefs[w], best[w], variance[w] = score, beta, alpha, max(rss, 1e-12) / max(n, 1)
    return coefs, best, variance


# --- elastic net -------------------------------------------------------------------------------------
def _soft(v: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(v) * np.maximum(np.abs(v) - by, 0)


def net_effects(s: np.ndarray, beta: np.ndarray, n: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """A player's effects, [..., penalty], from sums (columns, target) [..., column], coefficients [..., penalty, column] and the
    number of all rows."""
    left = s[..., None, -1] - np.einsum("...k,...ck->...c", s[..., :-1], beta[..., : s.shape[-1] - 1])
    count, n = s[..., None, 0], n[..., None]
    size = count + n * grid[:, 0] * (1 - grid[:, 1])
    return np.where(count > 0, _soft(left, n * grid[:, 0] * grid[:, 1]) / np.where(size > 0, size, 1), 0)


def net_pass(rows: DataFrame, d: Design, beta: np.ndarray, counts: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Given the columns' coefficients [week, fold left out (the last: none), penalty, column]: the players' effects times their sums, to go
    into the columns' equations, and what the effects add to the squared errors of the folds left out."""
    k, folds, weeks = d.size, d.folds, d.fitted
    shared = rows.sparkSession.sparkContext.broadcast((beta, counts))
    shapes = {"u": (folds + 1, len(grid), k), "h": (folds, len(grid))}

    def step(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        beta, counts = shared.value
        u, h = np.zeros((len(weeks), *shapes["u"])), np.zeros((len(weeks), *shapes["h"]))
        for p in players(batches, k):
            before = p.upto(weeks)
            at = np.flatnonzero(before >= d.at_least)
            if not len(at):
                continue
            own = p.sums(folds)[before[at]]
            whole = own.sum(axis=1, keepdims=True)
            s = np.concatenate((whole - own, whole), axis=1)
            effect = net_effects(s, beta[at], counts[at], grid)
            u[at] += s[:, :, None, :k] * effect[..., None]
            fit = np.einsum("wfk,wfck->wfc", own[..., :k], beta[at, :folds, :, :k])
            g = effect[:, :folds]
            h[at] += 2 * g * (fit - own[..., k][..., None]) + g * g * own[..., 0][..., None]
        return {"u": u, "h": h}

    found = added(rows, step, len(weeks), shapes)
    shared.destroy()
    return found["u"], found["h"]


def dense_net(gram: np.ndarray, b: np.ndarray, flat: np.ndarray, square: np.ndarray, x: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Minimum of x'Gx / 2 - b'x + flat |x| + square x'x / 2 for many [fit, column]: coordinate descent finds the signs, a solve
    the rest."""
    x, open_ = x.copy(), np.arange(len(b))
    for i in range(sweeps):
        g, t, f, q = gram[open_], b[open_], flat[open_], square[open_]
        y = x[open_]
        fit = np.einsum("nij,nj->ni", g, y)
        diagonal = np.einsum("nii->ni", g)
        for j in range(b.shape[1]):
            size = diagonal[:, j] + q[:, j]
            new = np.where(size > 1e-9, _soft(t[:, j] - fit[:, j] + diagonal[:, j] * y[:, j], f[:, j]) / np.where(size > 1e-9, size, 1), 0)
            fit += g[:, :, j] * (new - y[:, j])[:, None]
            y[:, j] = new
        if i % 3 == 2 or i == sweeps - 1:
            used = (y != 0) & (diagonal + q > 1e-9)
            a = g * (used[:, :, None] & used[:, None, :])
            d = np.arange(b.shape[1])
            a[:, d, d] += np.where(used, q, 1) + 1e-10 * diagonal
            exact = np.linalg.solve(a, np.where(used, t - np.sign(y) * f, 0)[..., None])[..., 0]
            left = t - np.einsum("nij,nj->ni", g, exact)
            good = ((np.sign(exact) == np.sign(y)) | ~used).all(axis=1) & (used | (np.abs(left) <= f * (1 + 1e-9) + 1e-9)).all(axis=1)
            y[good] = exact[good]
            x[open_] = y
            open_ = open_[~good]
            if not len(open_):
                break
        else:
            x[open_] = y
    return x


def net_step(
    rows: DataFrame, d: Design, fits: tuple[np.ndarray, ...], beta: np.ndarray, counts: np.ndarray, grid: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For single fits (week, fold left out, penalty), with the players' signs that the columns' coefficients [fit, column] give: what
    the players with an effect leave in the columns' equations, as a matrix and a vector, and in the loss."""
    k, folds, weeks = d.size, d.folds, d.fitted
    shared = rows.sparkSession.sparkContext.broadcast((*fits, beta, counts))
    shapes = {"a": (k, k), "b": (k,), "f": ()}

    def step(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        week, fold, which, beta, counts = shared.value
        acc = {n: np.zeros((len(week), *s)) for n, s in shapes.items()}
        size = counts[week, fold] * grid[which, 0]
        flat, square = size * grid[which, 1], size * (1 - grid[which, 1])
        for p in players(batches, k):
            before = p.upto(weeks)
            at = np.flatnonzero(before[week] >= d.at_least)
            if not len(at):
                continue
            own = p.sums(folds)[before]
            whole = own.sum(axis=1, keepdims=True)
            s = np.concatenate((whole - own, whole), axis=1)[week[at], fold[at]]
            left = s[:, k] - (s[:, :k] * beta[at, :k]).sum(axis=1)
            used = (np.abs(left) > flat[at]) & (s[:, 0] > 0)
            at, s, left = at[used], s[used], left[used]
            weight = 1 / (s[:, 0] + square[at])
            acc["a"][at] += s[:, :k, None] * (s[:, :k] * weight[:, None])[:, None, :]
            acc["b"][at] += s[:, :k] * ((s[:, k] - np.sign(left) * flat[at]) * weight)[:, None]
            acc["f"][at] -= (np.abs(left) - flat[at]) ** 2 * weight / 2
        return acc

    found = added(rows, step, len(beta), shapes)
    shared.destroy()
    return found["a"], found["b"], found["f"]


def net_by_newton(
    rows: DataFrame, d: Design, fits: tuple[np.ndarray, ...], counts: np.ndarray, grid: np.ndarray, columns: np.ndarray, gram: np.ndarray,
    target: np.ndarray, flat: np.ndarray, square: np.ndarray, x: np.ndarray, spread: np.ndarray, passes: int, tolerance: float,
) -> np.ndarray:
    """Newton steps for single fits, held back where the loss would grow: where all players have an effect, columns can be
    nearly redundant. ``columns`` are the maps from fitted to plain coefficients."""
    x, trial, open_ = x.copy(), x.copy(), np.arange(len(x))
    loss, hold = np.full(len(x), np.inf), np.full(len(x), 1e-4)
    a, b = gram.copy(), target.copy()
    scale = np.einsum("nii->ni", gram) + 1e-9
    for i in range(passes):
        m, y = columns[open_], trial[open_]
        left, take, low = net_step(rows, d, tuple(f[open_] for f in fits), np.einsum("fjk,fk->fj", m, y), counts, grid)
        m = m[:, : d.size]
        now = np.einsum("ni,nij,nj->n", y, gram[open_], y) / 2 - (target[open_] * y).sum(axis=1)
        now += (flat[open_] * np.abs(y) + square[open_] * y * y / 2).sum(axis=1) + low
        good = now <= loss[open_] + 1e-12 * np.abs(now)
        moved = np.abs(y - x[open_]).max(axis=1) / spread[open_]
        done = good & (moved < tolerance) & (hold[open_] < 1e-3) if i else np.zeros(len(y), bool)
        at = open_[good]
        x[at], loss[at] = y[good], now[good]
        a[at] = gram[at] - np.swapaxes(m[good], 1, 2) @ left[good] @ m[good]
        b[at] = target[at] - np.einsum("fjk,fj->fk", m[good], take[good])
        hold[open_] = np.where(good, np.maximum(hold[open_] / 5, 1e-12), hold[open_] * 20)
        open_ = open_[~done]
        if not len(open_):
            return x
        own = hold[open_, None] * scale[open_]
        held = a[open_]
        j = np.arange(held.shape[1])
        held[:, j, j] += own
        trial[open_] = dense_net(held, b[open_] + own * x[open_], flat[open_], square[open_], x[open_])
    warnings.warn(f"{len(open_)} elastic nets still move after {passes} passes", stacklevel=2)
    return x


def elastic_net(
    rows: DataFrame, d: Design, eq: Equations, alphas: Sequence[float], ratios: Sequence[float], turns: int = 10, passes: int = 60, tolerance: float = 1e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients per week, and (penalty, share of the absolute part) of the lowest mean error over the folds left out.

    In turns, columns and players come to rest quickly where the penalty is large; the fits that still move go on by Newton
    steps, four thousand at a time.
    """
    grid = np.array([(a, r) for r in ratios for a in sorted(alphas, reverse=True)])
    weeks, k = len(eq.n), d.size
    if not weeks:
        return np.zeros((0, k + 1)), np.zeros((0, 2))
    shape = (weeks, d.folds + 1, len(grid), k + 1)
    m = eq.map[:, None]
    gram = np.swapaxes(m, 2, 3) @ eq.gram @ m
    target = np.einsum("wjk,wfj->wfk", eq.map, eq.zy)
    counts = eq.gram[:, :, 0, 0]
    weight = (counts[:, :, None, None] * grid[None, None, :, 0, None] * eq.penalty[:, None, None, :]).reshape(-1, k + 1)
    mix = np.tile(grid[:, 1], weeks * (d.folds + 1))[:, None]
    spread = np.sqrt(np.maximum(eq.yy / np.maximum(eq.n, 1) - (eq.zy[:, -1, 0] / np.maximum(eq.n, 1)) ** 2, 1e-12))
    spread = np.repeat(spread, (d.folds + 1) * len(grid))
    fits = np.repeat(np.arange(weeks * (d.folds + 1)), len(grid))  # the equations of each
    gram = gram.reshape(-1, k + 1, k + 1)
    x, open_ = np.zeros((len(fits), k + 1)), np.arange(len(fits))
    raw = lambda x: np.einsum("wjk,wfck->wfcj", eq.map, x.reshape(shape))
    fold, which = np.divmod(np.arange(len(fits)), len(grid))
    week, fold = np.divmod(fold, d.folds + 1)
    columns = eq.map[:, :k]
    parts = lambda at: np.array_split(at, -(-len(at) // 4096))
    for _ in range(turns):
        u, _ = net_pass(rows, d, raw(x), counts, grid)
        b = (target[:, :, None, :] - np.einsum("wjk,wfcj->wfck", columns, u)).reshape(-1, k + 1)
        new = np.concatenate([dense_net(gram[fits[p]], b[p], weight[p] * mix[p], weight[p] * (1 - mix[p]), x[p]) for p in parts(open_)])
        moved = np.abs(new - x[open_]).max(axis=1) / spread[open_]
        x[open_] = new
        open_ = open_[moved >= tolerance / 10]
        if not len(open_):
            break
    for p in parts(open_) if len(open_) else []:
        x[p] = net_by_newton(
            rows, d, (week[p], fold[p], which[p]), counts, grid, eq.map[week[p]], gram[fits[p]], target[week[p], fold[p]],
            weight[p] * mix[p], weight[p] * (1 - mix[p]), x[p], spread[p], passes, tolerance,
        )
    _, h = net_pass(rows, d, raw(x), counts, grid)
    beta = raw(x)
    own = beta[:, :-1]
    error = eq.own_yy[:, :, None] - 2 * np.einsum("wfck,wfk->wfc", own, eq.own_zy)
    error = error + np.einsum("wfck,wfck->wfc", own, np.einsum("wfjk,wfcj->wfck", eq.folds, own)) + h
    size = eq.folds[:, :, 0, 0][:, :, None]
    mean = np.where(size > 0, error / np.maximum(size, 1), 0).sum(axis=1) / np.maximum((size > 0).sum(axis=1), 1)
    best = mean.argmin(axis=1)
    return beta[np.arange(weeks), -1, best], grid[best]


# --- Huber -------------------------------------------------------------------------------------------
def huber_effects(e: np.ndarray, inside: np.ndarray, scale: np.ndarray, epsilon: float, alpha: float, steps: int = 50) -> np.ndarray:
    """A player's effect per week, from residuals [row, week] without it and which rows count."""
    effect = np.zeros(e.shape[1])
    for _ in range(steps):
        weight = np.minimum(1, epsilon * scale / np.maximum(np.abs(e - effect), 1e-300)) * inside
        new = (weight * e).sum(axis=0) / (weight.sum(axis=0) + alpha * scale)
        done = np.abs(new - effect).max(initial=0.0) <= 1e-9 * scale.max(initial=1.0)
        effect = new
        if done:
            break
    return effect


def huber_pass(rows: DataFrame, d: Design, beta: np.ndarray, scale: np.ndarray, epsilon: float, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted equations of the columns once the players are solved for, and (squares inside, rows outside, rows) per week."""
    k, weeks = d.size, d.fitted
    shared = rows.sparkSession.sparkContext.broadcast((beta, scale))
    shapes = {"a": (k + 1, k + 1), "b": (k + 1,), "r": (3,)}

    def step(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        beta, scale = shared.value
        acc = {n: np.zeros((len(weeks), *s)) for n, s in shapes.items()}
        for p in players(batches, k):
            before = p.upto(weeks)
            at = np.flatnonzero(before > 0)
            if not len(at):
                continue
            n, sigma = before[at], scale[at]
            often = n >= d.at_least
            inside = (np.arange(len(p.t))[:, None] < n).astype(float)
            e = p.y[:, None] - p.z @ beta[at, :k].T - np.where(often, 0, beta[at, k])
            effect = np.where(often, huber_effects(e, inside, sigma, epsilon, alpha), 0)
            e = (e - effect) * inside
            far = np.abs(e) > epsilon * sigma
            weight = np.where(far, epsilon * sigma / np.maximum(np.abs(e), 1e-300), 1.0) * inside
            own = np.column_stack((p.z, np.ones(len(p.t)), p.y))
            pairs = (weight.T @ (own[:, :, None] * own[:, None, :]).reshape(len(own), -1)).reshape(len(at), k + 2, k + 2)
            s = pairs[:, :, 0]
            left = s[:, :, None] * s[:, None, :] / (s[:, 0] + alpha * sigma)[:, None, None]
            pairs = np.where(often[:, None, None], pairs - left, pairs)
            rare = np.where(often, 0.0, 1.0)  # the last column is of rare players
            pairs[:, k, :] *= rare[:, None]
            pairs[:, :, k] *= rare[:, None]
            acc["a"][at] += pairs[:, : k + 1, : k + 1]
            acc["b"][at] += pairs[:, : k + 1, k + 1]
            acc["r"][at] += np.column_stack(((np.where(far, 0, e) ** 2).sum(axis=0), far.sum(axis=0), n))
        return acc

    found = added(rows, step, len(weeks), shapes)
    shared.destroy()
    return found["a"], found["b"], found["r"]


def huber(
    rows: DataFrame, d: Design, eq: Equations, beta: np.ndarray, scale: np.ndarray, epsilon: float, alpha: float, passes: int = 100, tolerance: float = 1e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and scales per week, from a first guess of both."""
    moved, m = np.inf, eq.map
    for _ in range(passes if len(eq.n) else 0):
        a, b, r = huber_pass(rows, d, beta, scale, epsilon, alpha)
        a = np.swapaxes(m, 1, 2) @ a @ m
        i = np.arange(a.shape[1])
        a[:, i, i] += alpha * scale[:, None] * eq.penalty + ~eq.there
        x = np.linalg.pinv(a, hermitian=True) @ (np.swapaxes(m, 1, 2) @ b[..., None])
        new = (m @ x)[..., 0]
        size = np.sqrt(np.maximum(r[:, 0] / np.maximum(r[:, 2] - epsilon**2 * r[:, 1], 1.0), 1e-12))
        sd = np.sqrt(np.maximum(np.einsum("wkk->wk", eq.gram[:, -1]) / np.maximum(eq.n, 1)[:, None], 0))
        moved = max(float((np.abs(new - beta) * sd).max() / size.min()), float(np.abs(size / scale - 1).max()))
        beta, scale = new, size
        if moved < tolerance:
            break
    else:
        if len(eq.n):
            warnings.warn(f"Huber fits still move by {moved:.1e} of their scale after {passes} passes", stacklevel=2)
    return beta, scale


# --- predictions -------------------------------------------------------------------------------------
def walk_forward_wide(
    df: DataFrame, numbers: Sequence[str], small: Sequence[str], player: str, y: str, ids: Sequence[str], *,
    alphas: Sequence[float] = (10, 100, 200, 500, 1000), net_alphas: Sequence[float] = (0.1, 1, 10, 100),
    net_ratios: Sequence[float] = (0.1, 0.5, 0.7, 0.9, 0.95, 0.99, 1), folds: int = 5, epsilon: float = 1.15, huber_alpha: float = 5.0,
    at_least: int = 6, first_week: int = 50, models: Sequence[str] = MODELS,
) -> DataFrame:
    """Ridge, elastic net and Huber regression (``models``) refitted each week on all rows before it; rows of the weeks after
    ``first_week`` with ridge_preds, en_preds, huber_preds, their mean ``ensemble``, and the chosen ridge_alpha, en_alpha and en_ratio.

    Rows come from a table (season, week, ...). Rows with a null or NaN among the numbers are neither trained on nor predicted, rows
    without a target are predicted; a null category or player is a value of its own; rows without season or week
    don't take part. The folds of the cross-validation follow a hash of ``ids``, so a row's fold never changes.
    """
    df = settle(df)
    rows, d = encoded(df, numbers, small, player, y, ids, at_least=at_least, first_week=first_week, folds=folds)
    known = gather(rows, d, alphas)
    eq = Equations(d, known)
    flat, chosen, variance = ridge(eq, known, alphas)
    fits: dict[str, tuple[np.ndarray, ...]] = {}
    if "ridge" in models:
        fits["ridge"] = (flat, chosen)
    if "en" in models:
        fits["en"] = elastic_net(rows, d, eq, net_alphas, net_ratios)
    if "huber" in models:
        fits["huber"] = huber(rows, d, eq, flat, np.sqrt(variance), epsilon, huber_alpha)
    results = [f"{n}_preds" for n in fits]
    more = [n for m, own in (("ridge", ["ridge_alpha"]), ("en", ["en_alpha", "en_ratio"])) if m in fits for n in own]
    names, k = list(df.columns), d.size
    shared = rows.sparkSession.sparkContext.broadcast((fits, eq.n))

    def effects(p: Player, model: str, w: np.ndarray, n: np.ndarray, fit: tuple[np.ndarray, ...], counts: np.ndarray) -> np.ndarray:
        """The player's effect in some weeks."""
        beta, own = fit[0][w], fit[1][w]
        if model == "huber":
            inside = (np.arange(len(p.t))[:, None] < n).astype(float)
            return huber_effects(p.y[:, None] - p.z @ beta[:, :k].T, inside, own, epsilon, huber_alpha)
        s = p.sums(d.folds)[n].sum(axis=1)
        if model == "ridge":
            return (s[:, k] - (s[:, :k] * beta[:, :k]).sum(axis=1)) / np.maximum(n + own, 1e-300)
        return np.array([net_effects(s[i], beta[i][None], counts[v], own[i][None])[0] for i, v in enumerate(w)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, counts = shared.value
        for p in players(batches, k):
            t = p.rows["_t"].to_numpy()
            here = np.flatnonzero(pc.is_valid(p.rows["_z"]).to_numpy(zero_copy_only=False) & (t >= d.first))
            if not len(here):
                continue
            part = p.rows.take(pa.array(here)).combine_chunks()
            z = part["_z"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            weeks, row = np.unique(t[here], return_inverse=True)
            w, n = weeks - d.first, p.upto(weeks)
            columns = []
            for model, fit in fits.items():
                own = np.where(n >= d.at_least, effects(p, model, w, n, fit, counts), fit[0][w, k])
                columns.append((z * fit[0][w, :k][row]).sum(axis=1) + own[row])
            if "ridge" in fits:
                columns.append(fits["ridge"][1][w][row])
            if "en" in fits:
                columns += list(fits["en"][1][w][row].T)
            out = pa.Table.from_arrays([*(part[c] for c in names), *(pa.array(c.astype(float)) for c in columns)], names=[*names, *results, *more])
            yield from out.to_batches()

    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in [*results, *more]]])
    out = settle(rows.mapInArrow(run, schema))
    rows.unpersist()
    mean: Column = sum((F.col(n) for n in results[1:]), F.col(results[0])) / len(results)
    return out.withColumn("ensemble", mean).select(*names, *results, "ensemble", *more)
