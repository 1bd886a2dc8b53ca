"""Quality classifier by co-training.

Two logistic regressions see different views of a page: one its text (hashed words), one its metadata (source,
language, size and layout). In each round either labels the unlabelled pages that it is surest of, and the other
learns from them. Both are then calibrated on labelled rows kept apart, and their calibrated log-odds are added to
score every document.

All unlabelled pages take part. Their columns are kept in a compact form, and every pass over them adds up numbers whose
count doesn't depend on the pages: binned log-odds, from which the cut of a round follows, and what Newton steps need of
the rows with pseudo-labels. A page's pseudo-label follows from the models and cuts of the rounds so far, so none is
stored. The labelled rows are a bounded sample, each of which stands for as many as it was drawn from. Scoring is one
pass over all documents, which don't move.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import append_columns, per_batch, settle
from yardline.llm.rolling import IS_SPACE, mix, text_buffer, word_hashes, word_spans

WORD_BUCKETS = 512
SOURCE_BUCKETS = 64
LANG_BUCKETS = 16
LABELLED = 4000  # labelled rows at most (expected number) that the models are fitted on
ROUNDS = 5
SHARE = 0.1  # of the unlabelled rows that a model labels in a round, at most (but rows of one bin go together)
SURE = 0.95  # a pseudo-label needs this probability
WEIGHT = 0.5  # of a pseudo-label beside a label
HELD = 5  # every fifth labelled row calibrates
BINS = 200  # of log-odds, per unit
TOP = 30 * BINS  # the last bin takes all beyond
EDGE = int(np.ceil(np.log(SURE / (1 - SURE)) * BINS))
RIDGE = 1e-3
PASSES = 15  # of a fit by Newton steps, at most; two or three are usual
TOLERANCE = 1e-4  # a step that gains less is the last
ROWS = 1024  # that a task works on at once
PARTS = 32  # of the sums of a pass, added up apart
SEED_OF_SOURCE, SEED_OF_LANG = np.uint64(1), np.uint64(2)

KIND = np.zeros(256, np.int64)  # of a byte: 0 letter, 1 white space, 2 digit, 3 upper case, 4 mark of a sentence, 5 other
KIND[IS_SPACE] = 1
KIND[48:58] = 2
KIND[65:91] = 3
KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5
KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def text_counts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed words, and share of repeats of the word before, mean word length, share of one-byte words."""
    raw = FOLD[raw]
    starts, ends, first = word_spans(raw, at)
    words = word_hashes(raw, starts, ends)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    bucket = (words % np.uint64(WORD_BUCKETS)).astype(np.int64)
    counts = np.bincount(row * WORD_BUCKETS + bucket, minlength=len(n) * WORD_BUCKETS).reshape(-1, WORD_BUCKETS)
    some = np.maximum(n, 1)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    return counts, np.column_stack(
        [
            np.bincount(row[again], minlength=len(n)) / some,
            np.bincount(row, ends - starts, minlength=len(n)) / some / 10,
            np.bincount(row, (ends - starts) <= 1, minlength=len(n)) / some,
        ]
    )


def text_view(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Hashed words (root of their frequency, unit length), and the shares."""
    bags = np.sqrt(counts)
    bags /= np.maximum(np.linalg.norm(bags, axis=1, keepdims=True), 1e-9)
    return np.column_stack([bags, shares])


def metadata_numbers(raw: np.ndarray, at: np.ndarray, source: pa.Array, lang: pa.Array, size: pa.Array) -> np.ndarray:
    """Given size, lines, their length, shares of kinds of bytes, and the buckets of source and language."""
    n = len(at) - 1
    length = np.diff(at)
    row = np.repeat(np.arange(n), length)
    kinds = np.bincount(row * 6 + KIND[raw], minlength=n * 6).reshape(-1, 6) / np.maximum(length, 1)[:, None]
    lines = np.bincount(row[raw == 10], minlength=n) + 1
    given = pc.fill_null(size.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    out = [np.log1p(np.maximum(given, 0)) / 10, np.log1p(lines) / 5, np.log1p(length / lines) / 5, kinds]
    for column, buckets, seed in ((source, SOURCE_BUCKETS, SEED_OF_SOURCE), (lang, LANG_BUCKETS, SEED_OF_LANG)):
        text, edges = text_buffer(column.cast(pa.string()))
        whole = np.zeros(n, np.uint64)  # the whole value is one word
        some = np.diff(edges) > 0
        whole[some] = word_hashes(text, edges[:-1][some], edges[1:][some])
        out.append(mix(whole + seed) % np.uint64(buckets))
    return np.column_stack(out)


def metadata_view(numbers: np.ndarray) -> np.ndarray:
    """Hashed source and language, given size, and layout."""
    source, lang = (numbers[:, i].astype(np.int64) for i in (-2, -1))
    return np.column_stack([numbers[:, :3], np.eye(SOURCE_BUCKETS)[source] * 0.5, np.eye(LANG_BUCKETS)[lang] * 0.5, numbers[:, 3:-2]])


@dataclass
class Logistic:
    """Logistic regression with a small ridge, on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weight + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """A classifier per view, each with the line that calibrates its log-odds."""

    views: list[Logistic] = field(default_factory=list)
    lines: list[tuple[float, float]] = field(default_factory=list)
    prior: float = 0.5
    labels: int = 0  # labelled rows that were seen
    pseudo: list[int] = field(default_factory=list)  # pseudo-labels that each view got

    def probabilities(self, views: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Of either view and of both together; the share of good labels without a model."""
        if not self.views:
            return [np.full(len(views[0]), self.prior)] * 3
        odds = [a * m.log_odds(x) + b for m, x, (a, b) in zip(self.views, views, self.lines, strict=True)]
        base = np.log(self.prior / (1 - self.prior))
        return [_sigmoid(odds[0]), _sigmoid(odds[1]), _sigmoid(odds[0] + odds[1] - base)]


def calibration(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of log-odds for which they are probabilities, with a pull towards leaving them."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * odds + b)
        curve = p * (1 - p)
        slope = np.array([(odds * (p - y)).sum() + (a - 1), (p - y).sum() + 0.1 * b])
        cross = (odds * curve).sum()
        second = np.array([[(odds * odds * curve).sum() + 1, cross], [cross, curve.sum() + 0.1]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(second, slope), -1, 1)
    return max(float(a), 0.05), float(b)


def scales(count: float, sums: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of columns; that of a rare one isn't less than a tenth of the common spread."""
    mean = sums / count
    spread = np.sqrt(np.maximum(squares / count - mean**2, 0))
    return mean, np.maximum(spread, 0.1 * max(float(np.median(spread)), 1e-6))


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised columns, and ones."""
    return np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float32)


def newton_sums(z: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Weight, loss, slope and curvature that rows add to a logistic regression at ``beta``, in a row."""
    odds = z @ beta.astype(np.float32)
    p = _sigmoid(odds)
    loss = np.maximum(odds, 0) - y * odds + np.log1p(np.exp(-np.abs(odds)))
    bent = (z * (w * p * (1 - p))[:, None].astype(np.float32)).T @ z
    slope = z.T @ (w * (p - y)).astype(np.float32)
    return np.concatenate(([w.sum(), w @ loss], slope, bent.ravel())).astype(np.float64)


def newton_fit(starts: list[np.ndarray], evaluate: Callable[[dict[int, np.ndarray]], dict[int, np.ndarray]]) -> list[np.ndarray]:
    """Coefficients (the offset last) of the views, from ``newton_sums`` of all rows at given ones.

    A step that makes things worse is halved.
    """
    held, now, step = list(starts), list(starts), [np.zeros_like(b) for b in starts]
    least, open_ = [np.inf] * len(starts), set(range(len(starts)))
    for _ in range(PASSES):
        for view, sums in evaluate({v: now[v] for v in sorted(open_)}).items():
            beta = now[view]
            d = len(beta)
            pull = np.append(np.full(d - 1, RIDGE), 0.0)
            value = sums[1] / sums[0] + (pull * beta**2).sum() / 2
            if value > least[view] + 1e-6:
                step[view] = step[view] / 2
            else:
                slope = sums[2 : 2 + d] / sums[0] + pull * beta
                curve = sums[2 + d :].reshape(d, d) / sums[0] + np.diag(pull + 1e-9)
                held[view], least[view], step[view] = beta, value, np.linalg.solve(curve, slope)
                if slope @ step[view] < TOLERANCE:
                    open_.discard(view)
            now[view] = held[view] - step[view]
        if not open_:
            return now
    warnings.warn(f"quality classifier: a fit still moves after {PASSES} passes", stacklevel=2)
    return [held[v] if v in open_ else now[v] for v in range(len(now))]


def bins_of(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.nan_to_num(odds) * BINS, -TOP, TOP).astype(np.int64)


@dataclass
class Rounds:
    """Standardisation of the views, and the models and cuts of the rounds so far."""

    scale: list[tuple[np.ndarray, np.ndarray]]
    betas: list[list[np.ndarray]] = field(default_factory=lambda: [[], []])  # of each view, by round
    cuts: list[list[tuple[int, int]]] = field(default_factory=lambda: [[], []])  # bins up to which 0, and from which 1

    def standard(self, views: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        return [standard(x, *scale) for x, scale in zip(views, self.scale, strict=True)]

    def given(self, view: int, z: np.ndarray) -> np.ndarray:
        """Labels that a view gave, in the first round that did; -1 where none did."""
        label = np.full(len(z), -1.0)
        for beta, (low, high) in zip(self.betas[view], self.cuts[view], strict=False):
            b = bins_of(z @ beta.astype(np.float32))
            free = label < 0
            label[free & (b >= high)] = 1.0
            label[free & (b <= low)] = 0.0
        return label

    def counts(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Rows that a view hasn't labelled yet, by bin of the latest model's log-odds; both views in a row."""
        out = []
        for view, z in enumerate(self.standard(views)):
            b = bins_of(z @ self.betas[view][-1].astype(np.float32))
            out.append(np.bincount(b[self.given(view, z) < 0] + TOP, minlength=2 * TOP + 1))
        return np.concatenate(out).astype(np.float64)

    def sums(self, views: tuple[np.ndarray, np.ndarray], betas: dict[int, np.ndarray]) -> np.ndarray:
        """``newton_sums`` of the rows with pseudo-labels; the views in a row."""
        z = self.standard(views)
        out = []
        for view, beta in betas.items():
            label = self.given(1 - view, z[1 - view])
            known = label >= 0
            out.append(newton_sums(z[view][known], label[known], np.full(known.sum(), WEIGHT), beta))
        return np.concatenate(out)


def cut(counts: np.ndarray, most: list[float]) -> tuple[int, int, int]:
    """Bins up to which pages count as bad and from which as good, whole bins until ``most`` of a kind are reached, and
    how many pages that are."""
    ends, taken = [], 0
    for inward, wanted in ((counts[: TOP - EDGE + 1], most[0]), (counts[: TOP + EDGE - 1 : -1], most[1])):
        upto = np.cumsum(inward)
        last = min(int(np.searchsorted(upto, wanted)), len(inward) - 1)
        ends.append(TOP - last)
        taken += int(upto[last])
    return -ends[0], ends[1], taken


def moments(views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rows, and sums and squares of the columns of both views, in a row."""
    exact = [x.astype(np.float64) for x in views]
    return np.concatenate([[len(views[0])], *[v for x in exact for v in (x.sum(0), (x * x).sum(0))]])


def summed(pages: DataFrame, step: Callable[[tuple[np.ndarray, np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """Sum of a step's numbers over blocks of packed pages; None without pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = step(unpacked(batch.slice(at, ROWS)))
                total = own if total is None else total + own
        if total is not None:
            parts = [p.tobytes() for p in np.array_split(total, PARTS)]
            yield pa.record_batch([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b) for b in sorted(table.column("sums").to_pylist())]  # in one order, for equal sums
        return pa.table({"part": table.column("part")[:1], "sums": pa.array([np.sum(parts, 0).tobytes()], pa.binary())})

    kind = "part int, sums binary"
    rows = pages.select("bag", "rest").mapInArrow(run, kind).groupBy("part").applyInArrow(add, kind).collect()
    return np.concatenate([np.frombuffer(r["sums"]) for r in sorted(rows)]) if rows else None


def co_train(labelled: list[np.ndarray], y: np.ndarray, each: float, pages: DataFrame, rounds: int = ROUNDS) -> Model:
    """Models of both views. ``labelled`` holds the views' columns, each row standing for ``each``; ``pages`` the packed
    unlabelled ones."""
    model = Model(labels=len(y))
    if len(y):
        model.prior = float(np.clip(y.mean(), 0.01, 0.99))
    held = np.arange(len(y)) % HELD == 0
    if len(np.unique(y[~held])) < 2:
        return model
    fresh = summed(pages, moments)
    all_ = each * moments([x[~held] for x in labelled]) + (0.0 if fresh is None else fresh)
    edges = np.cumsum([1, *[x.shape[1] for x in labelled for _ in (0, 1)]])
    cuts = [all_[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    state = Rounds([scales(all_[0], cuts[0], cuts[1]), scales(all_[0], cuts[2], cuts[3])])
    own = state.standard([x[~held] for x in labelled])
    weight = np.full(len(own[0]), each)

    def from_labels(betas: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        return {v: newton_sums(own[v], y[~held], weight, beta) for v, beta in betas.items()}

    def from_all(betas: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        sums = from_labels(betas)
        more = summed(pages, lambda views: state.sums(views, betas))
        parts = np.split(more, np.cumsum([len(s) for s in sums.values()])[:-1])
        return {v: s + m for (v, s), m in zip(sums.items(), parts, strict=True)}

    fitted = newton_fit([np.zeros(z.shape[1]) for z in own], from_labels)
    model.pseudo = [0, 0]
    for _ in range(rounds if fresh is not None else 0):
        for view in (0, 1):
            state.betas[view].append(fitted[view])
        # as many of each kind as the labels have
        most = [int(fresh[0] * SHARE * share) + 1 for share in (1 - model.prior, model.prior)]
        for view, counts in enumerate(np.split(summed(pages, state.counts), 2)):
            low, high, taken = cut(counts, most)
            state.cuts[view].append((low, high))
            model.pseudo[1 - view] += taken
        fitted = newton_fit(fitted, from_all)
    model.views = [Logistic(*scale, beta[:-1], float(beta[-1])) for scale, beta in zip(state.scale, fitted, strict=True)]
    model.lines = [calibration(m.log_odds(x[held]), y[held]) for m, x in zip(model.views, labelled, strict=True)]
    return model


def parts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw, at = text_buffer(batch.column("text"))
    return *text_counts(raw, at), metadata_numbers(raw, at, batch.column("source"), batch.column("lang"), batch.column("size"))


def views_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    counts, shares, numbers = parts_of(batch)
    return text_view(counts, shares), metadata_view(numbers)


def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Ids, counts of words (a byte each, or four where that is too little), and the other numbers of both views."""
    bags: list[bytes] = []
    rest: list[bytes] = []
    for at in range(0, batch.num_rows, 256):
        counts, shares, numbers = parts_of(batch.slice(at, 256))
        wide = counts.max(1) > 255
        bags += [row.astype(np.uint32 if w else np.uint8).tobytes() for row, w in zip(counts, wide, strict=True)]
        rest += [row.tobytes() for row in np.column_stack([shares, numbers]).astype(np.float32)]
    return pa.record_batch([batch.column("id"), pa.array(bags, pa.binary()), pa.array(rest, pa.binary())], names=["id", "bag", "rest"])


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The views of packed pages."""
    bags = batch.column("bag").to_pylist()
    wide = np.array([len(b) > WORD_BUCKETS for b in bags], bool)
    counts = np.empty((len(bags), WORD_BUCKETS), np.float32)
    for some, kind in ((~wide, np.uint8), (wide, np.uint32)):
        counts[some] = np.frombuffer(b"".join(b for b, s in zip(bags, some, strict=True) if s), kind).reshape(-1, WORD_BUCKETS)
    rest = np.frombuffer(b"".join(batch.column("rest").to_pylist()), np.float32).reshape(len(bags), -1)
    return text_view(counts, rest[:, :3]), metadata_view(rest[:, 3:])


def _chosen(id_col: str, n: int, most: int) -> Column:
    """Rows whose id's hash is among the smallest: ``most`` of ``n`` in expectation."""
    return F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(min(1.0, most / max(n, 1)) * (1 << 30))


def fit(pages: DataFrame, labels: DataFrame, *, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """Fit on pages (id, text, source, lang, size) and labels (id, label 0 or 1).

    Several labels of an id count as the smallest; null labels and ids, and labels without a page, are left out; a page
    that is there several times counts once. ``labelled`` bounds the labelled rows by hashes of ids; all pages without a
    label take part.
    """
    labels = labels.filter(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(F.min("label").cast("int").alias("label"))
    labels, _ = settle(labels)
    pages = pages.filter(F.col("id").isNotNull()).select(F.col("id").cast("long").alias("id"), "text", "source", "lang", "size")
    small = per_batch(pages, "text", packed, "id long, bag binary, rest binary")
    small = small.groupBy("id").agg(F.min(F.struct("bag", "rest")).alias("page")).join(labels, "id", "left")
    small, drop = settle(small.select("id", "page.bag", "page.rest", "label"))
    known = small.filter(F.col("label").isNotNull())
    seen = known.count()
    # some thousand rows, bounded above
    table = known.filter(_chosen("id", seen, labelled)).toArrow().sort_by("id").combine_chunks()
    views: list[np.ndarray] = [np.zeros((0, 1), np.float32)] * 2
    if len(table):
        views = [np.concatenate(x) for x in zip(*[unpacked(b) for b in table.to_batches(ROWS)], strict=True)]
    y = (table.column("label").to_numpy() > 0).astype(float)
    model = co_train(views, y, seen / max(len(table), 1), small.filter(F.col("label").isNull()), rounds)
    drop()
    return model


def score(
    docs: DataFrame, model: Model, text_col: str = "text", source_col: str = "source", lang_col: str = "lang", size_col: str = "n_chars"
) -> DataFrame:
    """Add quality, text_quality, metadata_quality (probabilities) and good (quality at least one half) to documents.

    A null text is empty; null metadata is a value of its own. Without two kinds of labels every document gets the
    share of good labels. Rows may repeat, columns with the names of results are replaced, and an empty table gives an
    empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        own = pa.record_batch([batch.column(c) for c in (text_col, source_col, lang_col, size_col)], names=["text", "source", "lang", "size"])
        parts = [held.value.probabilities(views_of(own.slice(i, 256))) for i in range(0, own.num_rows, 256)]
        text, metadata, both = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0)] * 3
        return [pa.array(both), pa.array(text), pa.array(metadata), pa.array(both >= 0.5)]

    results = {"quality": "double", "text_quality": "double", "metadata_quality": "double", "good": "boolean"}
    return append_columns(docs, text_col, step, results)
