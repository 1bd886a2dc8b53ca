"""Suffix-array dedup: remove every byte of a long string that also starts somewhere else.

The suffixes of a piece of text are sorted in two stages. Suffixes smaller than their successor are sorted directly,
by eight bytes at a time and only where a group branches. The rest are induced: a scan of the buckets (one per first
byte) in ascending order puts the predecessor of each suffix into its own bucket. Common prefixes of neighbours in the
finished order tell which windows repeat.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm import repeats
from yardline.llm.common import settle
from yardline.llm.rolling import text_buffer

WINDOW = 200
GRAM = 40
STEP = 8  # bytes that are compared at once


def leading(data: np.ndarray, depth: int) -> np.ndarray:
    """For each position the next eight bytes as a number that sorts like them; enough positions for ``depth``."""
    padded = np.concatenate((data, np.zeros(depth + 2 * STEP, np.uint8)))
    n = len(padded) - STEP
    out = np.zeros(n, np.uint64)
    for i in range(STEP):
        out <<= np.uint64(8)
        out |= padded[i : i + n]
    return out


def common(ahead: np.ndarray, a: np.ndarray, b: np.ndarray, done: np.ndarray, steps: int) -> np.ndarray:
    """How many steps of eight bytes the suffixes at a and b share, counting from ``done`` shared ones up to steps."""
    shared = done.copy()
    active = np.flatnonzero(shared < steps)
    while len(active):
        offset = shared[active] * STEP
        active = active[ahead[a[active] + offset] == ahead[b[active] + offset]]
        shared[active] += 1
        active = active[shared[active] < steps]
    return shared


def sort_directly(ahead: np.ndarray, positions: np.ndarray, steps: int) -> np.ndarray:
    """Positions in the order of their suffixes, by the first ``steps`` times eight bytes; ties stay as they come."""
    order = positions[np.argsort(ahead[positions])]
    slots = np.arange(len(order))
    key = ahead[order]
    group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1]))) if len(order) else key.astype(np.int64)
    depth = np.ones(len(order), np.int64)
    while len(slots):
        size = np.bincount(group)
        tied = size[group] > 1
        slots, group, depth = slots[tied], group[tied], depth[tied]
        if not len(slots):
            break
        fresh = np.concatenate(([True], group[1:] != group[:-1]))
        head = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        members = order[slots]
        # the part of the tree without branches: go down to where the group parts
        depth = np.minimum.reduceat(common(ahead, members, members[head][group], depth, steps), head)[group]
        open_ = depth < steps
        slots, group, depth, members = slots[open_], group[open_], depth[open_], members[open_]
        if not len(slots):
            break
        key = ahead[members + depth * STEP]
        o = np.lexsort((key, group))
        order[slots] = members[o]
        key, group, depth = key[o], group[o], depth[o] + 1
        group = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (group[1:] != group[:-1]))))
    return order


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the end of the text is smaller than all)."""
    n = len(data)
    differs = np.flatnonzero(data[1:] != data[:-1])
    rises = data[differs + 1] > data[differs]
    nearest = np.searchsorted(differs, np.arange(n))
    return np.append(rises, False)[nearest]


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All positions in the order of their suffixes, at least by the first ``depth`` bytes."""
    n = len(data)
    ahead = leading(data, depth)
    direct = smaller_than_next(data)
    order = sort_directly(ahead, np.flatnonzero(direct), -(-depth // STEP))
    sizes = np.bincount(data, minlength=256)
    begin = np.cumsum(sizes) - sizes
    sorted_sizes = np.bincount(data[order], minlength=256)
    sorted_begin = np.cumsum(sorted_sizes) - sorted_sizes
    out = np.empty(n, np.int64)
    fill = begin.copy()  # where the next induced suffix of a bucket goes
    out[fill[data[n - 1]]] = n - 1
    fill[data[n - 1]] += 1
    for c in np.flatnonzero(sizes).tolist():
        bucket = out[begin[c] : begin[c] + sizes[c]]
        done = 0
        while done < fill[c] - begin[c]:  # suffixes that start with the same byte twice induce within the bucket
            fresh = bucket[done : fill[c] - begin[c]]
            done += len(fresh)
            before = fresh[fresh > 0] - 1
            before = before[data[before] == c]
            bucket[done : done + len(before)] = before
            fill[c] += len(before)
        bucket[done:] = order[sorted_begin[c] : sorted_begin[c] + sorted_sizes[c]]
        before = bucket[bucket > 0] - 1
        before = before[data[before] > c]
        first = data[before]
        by_byte = np.argsort(first, kind="stable")
        first = first[by_byte]
        count = np.bincount(first, minlength=256)
        rank = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
        out[fill[first] + rank] = before[by_byte]
        fill += count
    return out


def repeated_windows(data: np.ndarray, at: np.ndarray, windows: np.ndarray, first: np.ndarray, *, window: int) -> np.ndarray:
    """1 for each window whose bytes also start at another window of these texts, else 0."""
    before = np.cumsum(windows) - windows
    number = np.full(len(data), -1)
    place = np.arange(windows.sum())
    number[place + np.repeat(at[:-1] - before, windows)] = place
    order = suffix_array(data, window)
    order = order[number[order] >= 0]
    steps, rest = divmod(window, STEP)
    ahead = leading(data, window)
    a, b = order[:-1], order[1:]
    same = common(ahead, a, b, np.zeros(len(a), np.int64), steps) == steps
    if rest:
        shift = np.uint64(8 * (STEP - rest))
        same &= ahead[a + steps * STEP] >> shift == ahead[b + steps * STEP] >> shift
    out = np.zeros(len(place), np.int64)
    out[number[a[same]]] = out[number[b[same]]] = 1
    return out


def marked(rows: DataFrame, window: int, gram: int, group_tokens: int) -> DataFrame:
    """Columns r1, r2 and ranges of repeated windows, for the rows (r1, r2, text) that have any."""
    found, drop_found = settle(repeats.occurrences(rows, window, gram, False))
    # a key that is there once, at one place of its stretch, can't belong to a window that repeats
    often = found.groupBy("key").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n")).filter(F.col("n") > 1)
    repeated, _ = settle(found.join(often, "key", "left_semi"))
    drop_found()
    each, _ = settle(repeats.classes(repeated))
    sizes = repeats.key_sizes(each, window)
    asked = each.join(sizes, "key").filter((F.col("kinds") > 1) | ((F.col("times") == 1) & F.col("twice")))
    cuts, _ = settle(repeats.cut(rows, asked, window, False))
    hot = sizes.filter(F.col("tokens") > group_tokens).select("key")
    resolve = partial(repeated_windows, window=window)
    ranges = repeats.resolved(cuts.join(hot, "key", "left_anti"), resolve, 0, False)
    ranges = ranges.unionByName(repeats.refiled(cuts.join(hot, "key", "left_semi"), window, False))
    # a class that is there several times repeats as a whole; its copies were only counted
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("windows").alias("hi"), F.lit(1).cast("long").alias("first")))
    copied = each.filter(F.col("times") > 1).select("key", "content", whole.alias("ranges"))
    once = each.filter(F.col("times") == 1).select("key", "content")
    marks = copied.unionByName(ranges.join(once, ["key", "content"], "left_semi"))
    return repeats.by_row(repeated, marks)


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    window: int = WINDOW,
    gram: int = GRAM,
    group_tokens: int = repeats.GROUP_TOKENS,
) -> DataFrame:
    """Add n_bytes, n_removed, n_spans, removed (array of lo, hi) and kept (binary) to documents.

    Texts are UTF-8 bytes. A byte goes if it is covered by ``window`` bytes that also start anywhere else in the
    table, in the same text too; overlapping windows count. Strings never cross texts.

    A null text is empty; texts shorter than the window lose nothing. Rows may repeat and ids may be null or tied:
    every row counts as a text of its own. Other columns stay, those with the names of results are replaced. An
    empty table gives an empty result. ``group_tokens`` bounds what a task holds of one key (see ``repeats``).
    """
    rows = repeats.row_keys(docs, id_col, text_col)
    ranges = marked(rows, window, gram, group_tokens)

    def step(batch: pa.RecordBatch, text: str, ranges: str) -> list[pa.Array]:
        raw, at = text_buffer(batch.column(text))
        data, removed, kept = raw.tobytes(), [], []
        for gone, a, b in zip(repeats.covered(batch.column(ranges), window), at[:-1].tolist(), at[1:].tolist(), strict=True):
            removed.append(gone)
            kept.append(b"".join(data[a + x : a + y] for x, y in repeats.rest(gone, b - a)))
        size = np.diff(at)
        lost = np.array([x[:, 1].sum() - x[:, 0].sum() for x in removed], np.int64)
        return [pa.array(size), pa.array(lost), *repeats.span_columns(removed), pa.array(kept, pa.binary())]

    return repeats.with_ranges(
        docs,
        id_col,
        text_col,
        ranges,
        step,
        {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "removed": "array<struct<lo:long,hi:long>>", "kept": "binary"},
    )
