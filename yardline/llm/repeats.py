"""Steps shared by the two operators that remove repeated stretches of text.

Both look for windows (200 bytes, 50 words) that stand in several places. Windows are filed under their smallest
gram (``rolling.stretches``), so equal windows meet under one key and most of the text, whose keys are seen once,
drops out after a count. What is left are classes: stretches with one key and one content. Copies of a class are
only counted. Where several classes share a key, one copy of each is cut out of its document, and the operator's
own method (a suffix array, suffix trees) finds the windows they share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import append_columns, free_name, per_batch
from yardline.llm.rolling import BYTE_VALUES, stretches, text_buffer, word_hashes, word_spans

GROUP_TOKENS = 1 << 19  # tokens of one key that a task takes at once; more are filed again, see ``refiled``
BATCH_TOKENS = 1 << 19  # tokens of several keys that a task takes at once
NO_ID = -(2**63)
OCCURRENCE = "r1 long, r2 long, start int, windows int, key long, content long, twice boolean"
CUT = "key long, content long, windows int, first long, text binary"
RANGES = "key long, content long, ranges array<struct<lo:int,hi:int,first:long>>"


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two numbers, never null, that are equal for rows with equal id and text only."""
    ident = F.col(f"`{id_col}`").cast("long")
    return F.coalesce(ident, F.lit(NO_ID)), F.xxhash64(F.col(f"`{text_col}`"), ident.isNull())


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns r1, r2 and text."""
    r1, r2 = row_key(id_col, text_col)
    return docs.select(r1.alias("r1"), r2.alias("r2"), F.col(f"`{text_col}`").alias("text"))


def tokens(raw: np.ndarray, at: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Values of the tokens and offsets of the texts: bytes, or words."""
    if not words:
        return BYTE_VALUES[raw], at
    starts, ends, first = word_spans(raw, at)
    return word_hashes(raw, starts, ends), first


def occurrences(rows: DataFrame, window: int, gram: int, words: bool) -> DataFrame:
    """Every stretch of windows with one key, from columns r1, r2 and text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        values, at = tokens(*text_buffer(batch.column("text")), words)
        found = list(stretches(values, at, window, gram))
        if not found:
            return None
        join = lambda name: np.concatenate([getattr(x, name) for x in found])
        text = pa.array(join("text"))
        return pa.record_batch(
            [
                batch.column("r1").take(text),
                batch.column("r2").take(text),
                pa.array(join("start").astype(np.int32)),
                pa.array(join("windows").astype(np.int32)),
                pa.array(join("key").view(np.int64)),
                pa.array(join("content").view(np.int64)),
                pa.array(join("twice")),
            ],
            names=["r1", "r2", "start", "windows", "key", "content", "twice"],
        )

    return per_batch(rows.select("r1", "r2", "text"), "text", step, OCCURRENCE)


def classes(repeated: DataFrame) -> DataFrame:
    """One row per key and content: how often, its smallest id, a place to cut it from, and what shares its key."""
    each = repeated.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("times"),
        F.min("r1").alias("first"),
        F.min(F.struct("r1", "r2", "start")).alias("place"),
        F.max("windows").alias("windows"),
        F.max("twice").alias("twice"),
    )
    return each


def key_sizes(each: DataFrame, window: int) -> DataFrame:
    """Classes and tokens of each key."""
    return each.groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum(F.col("windows") + F.lit(window - 1)).alias("tokens")
    )


def cut(rows: DataFrame, wanted: DataFrame, window: int, words: bool) -> DataFrame:
    """The text of one copy of each wanted class (columns key, content, windows, first, place)."""
    asked = wanted.groupBy(F.col("place.r1").alias("r1"), F.col("place.r2").alias("r2")).agg(
        F.collect_list(F.struct("key", "content", "windows", "first", F.col("place.start").alias("start"))).alias("asked")
    )
    joined = rows.select("r1", "r2", "text").join(asked, ["r1", "r2"]).select("text", "asked")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, at = text_buffer(batch.column("text"))
        lists = batch.column("asked")
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        items = lists.flatten()
        field = lambda name: items.field(name).to_numpy(zero_copy_only=False)
        begin, size = field("start").astype(np.int64), field("windows").astype(np.int64) + window - 1
        if words:
            starts, ends, first = word_spans(raw, at)
            begin, last = starts[first[owner] + begin], ends[first[owner] + begin + size - 1]
        else:
            begin = at[owner] + begin
            last = begin + size
        data = raw.tobytes()
        texts = [data[a:b] for a, b in zip(begin.tolist(), last.tolist(), strict=True)]
        columns = [items.field(n) for n in ("key", "content", "windows", "first")]
        return pa.record_batch([*columns, pa.array(texts, pa.binary())], names=["key", "content", "windows", "first", "text"])

    return per_batch(joined, "text", step, CUT)


Resolve = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal flags that stay with one owner."""
    fresh = np.ones(len(flags), bool)
    fresh[1:] = (flags[1:] != flags[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(fresh)
    return start, np.append(start[1:], len(flags))


def resolved(cuts: DataFrame, resolve: Resolve, none: int, words: bool) -> DataFrame:
    """Run ``resolve`` over the classes of each key and give ranges of windows with its answer (not ``none``).

    ``resolve`` gets the tokens of several keys' classes behind each other, their offsets, their windows and their
    first ids, and returns a number per window. Keys arrive whole and sorted; a task holds one batch of them.
    """

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(held)
        key, content = (table.column(n).to_numpy() for n in ("key", "content"))
        fresh = np.ones(len(key), bool)  # a document that is there twice gives its cuts twice
        fresh[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        table = table.filter(pa.array(fresh))
        texts = table.column("text").to_pylist()
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        windows = table.column("windows").to_numpy().astype(np.int64)
        if words:
            values, at = tokens(raw, at, True)
        else:
            values = raw
        answers = resolve(values, at, windows, table.column("first").to_numpy())
        owner = np.repeat(np.arange(len(windows)), windows)
        start, end = runs(answers, owner)
        hit = answers[start] != none
        start, end = start[hit], end[hit]
        if not len(start):
            return None
        who, before = owner[start], np.cumsum(windows) - windows
        some, count = np.unique(who, return_counts=True)
        offsets = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
        ranges = pa.StructArray.from_arrays(
            [
                pa.array((start - before[who]).astype(np.int32)),
                pa.array((end - before[who]).astype(np.int32)),
                pa.array(answers[start].astype(np.int64)),
            ],
            names=["lo", "hi", "first"],
        )
        picked = table.select(["key", "content"]).take(pa.array(some)).combine_chunks()
        columns = [picked.column(n).combine_chunks() for n in ("key", "content")]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.record_batch([*columns, pa.ListArray.from_arrays(offsets, ranges)], names=["key", "content", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            length = pc.binary_length(batch.column("text")).to_numpy()
            cuts_at = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            first = 0
            for a, b in zip(cuts_at[:-1], cuts_at[1:], strict=True):
                new = not held or a > 0 or held[-1].column("key")[-1].as_py() != int(key[0])
                if new and size >= BATCH_TOKENS:
                    if a > first:
                        held.append(batch.slice(first, a - first))
                    out = answer(held)
                    if out is not None:
                        yield out
                    held, size, first = [], 0, a
                size += int(length[a:b].sum())
            held.append(batch.slice(first))
        if held and (out := answer(held)) is not None:
            yield out

    return cuts.repartition("key").sortWithinPartitions("key", "content").mapInArrow(run, RANGES)


def refiled(cuts: DataFrame, window: int, words: bool) -> DataFrame:
    """Ranges for keys with more text than a task should take: every window is filed under itself.

    A window is then a row of its own, and windows that are equal are counted and combined before the shuffle, so no
    group of them is ever gathered. ``first`` is the smallest id of the classes that share a window, ``kinds`` says
    whether it is in more than one place.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        raw, at = text_buffer(batch.column("text"))
        values, at = tokens(raw, at, words)
        found = list(stretches(values, at, window, window))
        if not found:
            return None
        join = lambda name: np.concatenate([getattr(x, name) for x in found])
        count, text = join("windows"), join("text")
        text, file = np.repeat(text, count), np.repeat(join("key"), count)
        place = np.repeat(join("start"), count) + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        rows = pa.array(text)
        columns = [batch.column(n).take(rows) for n in ("key", "content", "first")]
        names = ["key", "content", "first", "place", "file"]
        return pa.record_batch([*columns, pa.array(place.astype(np.int32)), pa.array(file.view(np.int64))], names=names)

    schema = "key long, content long, first long, place int, file long"
    each = per_batch(cuts.dropDuplicates(["key", "content"]), "text", step, schema)
    shared = each.groupBy("key", "file").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("least"))
    shared = shared.filter(F.col("n") > 1)
    met = each.join(shared, ["key", "file"])
    place = F.struct(F.col("place").alias("lo"), (F.col("place") + 1).alias("hi"), F.col("least").alias("first"))
    return met.groupBy("key", "content").agg(F.collect_list(place).alias("ranges"))


def by_row(repeated: DataFrame, marks: DataFrame) -> DataFrame:
    """Ranges of windows per row, from ranges per class."""
    placed = repeated.select("r1", "r2", "start", "key", "content").join(marks, ["key", "content"])
    moved = F.expr("transform(ranges, x -> struct(start + x.lo as lo, start + x.hi as hi, x.first as first))")
    return placed.select("r1", "r2", moved.alias("ranges")).groupBy("r1", "r2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def with_ranges(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    ranges: DataFrame,
    step: Callable[[pa.RecordBatch, str, str], list[pa.Array]],
    results: dict[str, str],
) -> DataFrame:
    """Join each row with its ranges and add the columns that ``step`` makes of text and ranges."""
    names = [free_name(docs, n) for n in ("r1", "r2", "ranges", "whole_text")]
    r1, r2, held, whole = names
    left = docs.select("*", F.col(f"`{text_col}`").alias(whole), *[c.alias(n) for c, n in zip(row_key(id_col, text_col), (r1, r2), strict=True)])
    right = ranges.select(*[F.col(n).alias(f"{n}_of_ranges") for n in ("r1", "r2")], F.col("ranges").alias(held))
    on = (F.col(r1) == F.col("r1_of_ranges")) & (F.col(r2) == F.col("r2_of_ranges"))
    joined = left.join(right, on, "left").drop(r1, r2, "r1_of_ranges", "r2_of_ranges")
    return append_columns(joined, whole, lambda batch: step(batch, whole, held), results, drop=(whole, held))


def covered(ranges: pa.ListArray, window: int) -> list[np.ndarray]:
    """Per row the maximal intervals (n, 2) of tokens that ranges of windows cover."""
    lengths = pc.fill_null(pc.list_value_length(ranges), 0).to_numpy(zero_copy_only=False)
    items = ranges.flatten()
    lo, hi = (items.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("lo", "hi"))
    out, first = [], 0
    for n in lengths.tolist():
        a, b = lo[first : first + n], hi[first : first + n] + window - 1
        first += n
        order = np.argsort(a)
        a, b = a[order], np.maximum.accumulate(b[order])
        head = np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), a[1:] > b[:-1])))
        last = np.append(head[1:], n)[: len(head)] - 1
        out.append(np.stack((a[head], b[last]), 1))
    return out


def rest(gone: np.ndarray, size: int) -> list[tuple[int, int]]:
    """What maximal intervals leave of [0, size)."""
    edges = [0, *gone.ravel().tolist(), size]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]


def span_columns(removed: list[np.ndarray]) -> list[pa.Array]:
    """Number of spans, and the spans as an array of lo and hi."""
    count = np.array([len(x) for x in removed], np.int64)
    both = np.concatenate(removed) if removed else np.zeros((0, 2), np.int64)
    items = pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["lo", "hi"])
    offsets = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
    return [pa.array(count), pa.ListArray.from_arrays(offsets, items)]
