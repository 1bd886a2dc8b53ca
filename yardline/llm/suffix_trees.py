"""Substring dedup: remove words covered by a long window of words that an earlier document has too.

Suffixes of words are split into groups by prefixes of variable length: a group larger than a task should hold is
split by longer prefixes, until it fits. Each group's subtree is built from the top down, an edge of several words at
a time; leaves drop out, and nodes as deep as the window are the maximal repeats. A node carries the smallest id
below it.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm import repeats
from yardline.llm.common import settle
from yardline.llm.rolling import running, stretch, text_buffer, word_spans

WINDOW = 50
GRAM = 12
EDGE = 7  # words of an edge that are compared at once
MOST_SUFFIXES = 1 << 18  # suffixes of a group


def prefix_groups(sums: np.ndarray, suffixes: np.ndarray, window: int, most: int) -> list[tuple[np.ndarray, int]]:
    """(suffixes, length of the prefix that they share): groups of at most ``most``, or of equal windows."""
    out, waiting = [], [(suffixes, 0)]
    while waiting:
        group, length = waiting.pop()
        if len(group) <= most or length >= window:
            out.append((group, length))
            continue
        length += 1
        key = stretch(sums, group, group + length)
        order = np.argsort(key, kind="stable")
        cut = np.flatnonzero(np.diff(key[order].view(np.int64)) != 0) + 1
        parts = np.split(group[order], cut)
        small = [p for p in parts if len(p) <= most]
        waiting += [(p, length) for p in parts if len(p) > most]
        held, size = [], 0
        for p in small:  # several small prefixes make one group
            if size + len(p) > most:
                out.append((np.concatenate(held), 0))
                held, size = [], 0
            held.append(p)
            size += len(p)
        if held:
            out.append((np.concatenate(held), 0))
    return out


def deep_nodes(sums: np.ndarray, suffixes: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes below nodes of the depth of the window, and their nodes, from the subtree of a group."""
    node = np.zeros(len(suffixes), np.int64)
    while length < window and len(suffixes):
        edge = min(EDGE, window - length) if length else 1
        key = stretch(sums, suffixes + length, suffixes + length + edge)
        order = np.lexsort((key, node))
        suffixes, key, node = suffixes[order], key[order], node[order]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        node = np.cumsum(fresh) - 1
        inner = np.bincount(node)[node] > 1  # a leaf has nothing to share
        suffixes, node = suffixes[inner], node[inner]
        length += edge
    if len(suffixes) and length >= window:
        node = np.unique(node, return_inverse=True)[1]
    return suffixes, node


def smallest_ids(
    values: np.ndarray, at: np.ndarray, windows: np.ndarray, first: np.ndarray, *, window: int, most: int = MOST_SUFFIXES
) -> np.ndarray:
    """For each window the smallest id among the texts that have it."""
    before = np.cumsum(windows) - windows
    place = np.arange(windows.sum())
    suffixes = place + np.repeat(at[:-1] - before, windows)
    number = np.full(len(values), -1)
    number[suffixes] = place
    out = np.repeat(first, windows)
    sums = running(values)
    for group, length in prefix_groups(sums, suffixes, window, most):
        below, node = deep_nodes(sums, group, length, window)
        if len(below):
            least = np.full(node.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, node, out[number[below]])
            out[number[below]] = least[node]
    return out


def marked(rows: DataFrame, window: int, gram: int, group_tokens: int) -> DataFrame:
    """Columns r1, r2 and ranges of windows that a smaller id has too, for the rows (r1, r2, text) that have any."""
    found, drop_found = settle(repeats.occurrences(rows.filter(F.col("r1") != repeats.NO_ID), window, gram, True))
    often = found.groupBy("key").agg(F.min("r1").alias("a"), F.max("r1").alias("b")).filter("a < b")
    repeated, _ = settle(found.join(often, "key", "left_semi"))
    drop_found()
    each, _ = settle(repeats.classes(repeated))
    sizes = repeats.key_sizes(each, window)
    asked = each.join(sizes, "key").filter(F.col("kinds") > 1)
    cuts, _ = settle(repeats.cut(rows, asked, window, True))
    hot = sizes.filter(F.col("tokens") > group_tokens).select("key")
    resolve = partial(smallest_ids, window=window)
    ranges = repeats.resolved(cuts.join(hot, "key", "left_anti"), resolve, repeats.NO_ID, True)
    ranges = ranges.unionByName(repeats.refiled(cuts.join(hot, "key", "left_semi"), window, True))
    # of the windows of a class all copies but those of the smallest id go, also where no other class has them
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("windows").alias("hi"), F.col("first")))
    own = each.select("key", "content", whole.alias("ranges"))
    placed = repeats.by_row(repeated, own.unionByName(ranges))
    earlier = placed.select("r1", "r2", F.expr("filter(ranges, x -> x.first < r1)").alias("ranges"))
    return earlier.filter(F.size("ranges") > 0)


def remove_repeated_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    window: int = WINDOW,
    gram: int = GRAM,
    group_tokens: int = repeats.GROUP_TOKENS,
) -> DataFrame:
    """Add n_words, n_removed, n_spans, removed (array of lo, hi, in words) and kept (string) to documents.

    Words are runs without space, tab to carriage return, unchanged. A window is ``window`` consecutive words of one
    document. A word goes if a window covers it that also starts in a document with a smaller id. ``kept`` has the
    other words with one space between them.

    A null text has no words; texts shorter than the window lose nothing. Rows with one id are one document here and
    never remove each other's words. A null id is neither smaller nor larger than another: such rows keep all words.
    Other columns stay, those with the names of results are replaced. An empty table gives an empty result.
    ``group_tokens`` bounds what a task holds of one key (see ``repeats``).
    """
    rows = repeats.row_keys(docs, id_col, text_col)
    ranges = marked(rows, window, gram, group_tokens)

    def step(batch: pa.RecordBatch, text: str, ranges: str) -> list[pa.Array]:
        raw, at = text_buffer(batch.column(text))
        starts, ends, first = word_spans(raw, at)
        data, removed, kept = raw.tobytes(), [], []
        for gone, a, b in zip(repeats.covered(batch.column(ranges), window), first[:-1].tolist(), first[1:].tolist(), strict=True):
            removed.append(gone)
            stay = [data[starts[a + x] : ends[a + y - 1]] for x, y in repeats.rest(gone, b - a)]
            kept.append(b" ".join(b" ".join(part.split()) for part in stay))
        lost = np.array([x[:, 1].sum() - x[:, 0].sum() for x in removed], np.int64)
        kept = pa.array(kept, pa.binary()).view(pa.string())
        return [pa.array(np.diff(first)), pa.array(lost), *repeats.span_columns(removed), kept]

    return repeats.with_ranges(
        docs,
        id_col,
        text_col,
        ranges,
        step,
        {"n_words": "long", "n_removed": "long", "n_spans": "long", "removed": "array<struct<lo:long,hi:long>>", "kept": "string"},
    )
