"""Benchmark decontamination: windows of documents that are near copies of benchmark items.

For an item of n words the windows are n consecutive words of a document; a document with fewer words is one window.
Each window gets a SimHash fingerprint of its five-word shingles. An index over the items' fingerprints, cut into
blocks, finds all items within the radius: of eight blocks one must differ in at most an eighth of the bits, so each
block lists its items under every value that close. What is found is held against the exact distance and then the
exact similarity, which weighs each shingle by how often it occurs.

Windows are laid only where a document has a shingle of an item of that size: without one in common no window can
reach the similarity. The items travel to the tasks in blocks of bounded size, each block meets all documents, and
documents never move.
"""

from __future__ import annotations

import math
from bisect import bisect
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import SPACE, append_columns, free_name, settle
from yardline.llm.rolling import PIECE, running, stretch, text_buffer, word_hashes, word_spans
from yardline.llm.simhash import fingerprints_of

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23  # bits; at similarity 0.8 some ten bits differ, and 23 is over four standard deviations away
BLOCKS = 8
BLOCK_ITEMS = 20_000  # items and words of a block that goes to the tasks
BLOCK_WORDS = 2_000_000
HITS = "array<struct<item:long,start:int,words:int,similarity:double,distance:int>>"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IS_PLAIN = np.ones(256, bool)  # neither punctuation nor a control character; all of a longer character counts
IS_PLAIN[[c for c in range(128) if not chr(c).isalnum() and c not in (9, 10, 11, 12, 13, 32)]] = False


def folded(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with A-Z lower-cased and without punctuation."""
    keep = IS_PLAIN[raw]
    return FOLD[raw[keep]], np.concatenate(([0], np.cumsum(keep)))[at]


def shingles(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the shingle that starts at each word (the last words of a text start none: 0), and first words."""
    raw, at = folded(raw, at)
    starts, ends, first = word_spans(raw, at)
    words = word_hashes(raw, starts, ends)
    out = np.zeros(len(words), np.uint64)
    for low in range(0, len(words), PIECE):
        high = min(len(words), low + PIECE + SHINGLE - 1)
        n = high - low - SHINGLE + 1
        if n > 0:
            here = np.arange(n)
            out[low : low + n] = stretch(running(words[low:high]), here, here + SHINGLE)
    size = np.diff(first)
    left = np.repeat(first[1:], size) - np.arange(len(words))
    out[left < SHINGLE] = 0
    return out, first


def window_fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of n hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:], dtype=np.int32)
    ones = (2 * (sums[n:] - sums[:-n]) > n).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


@dataclass
class Sized:
    """Items with one number of shingles: ids, fingerprints, and per block the items near each of its values."""

    items: list[int]
    prints: np.ndarray
    near: np.ndarray  # block, value of the block, item

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius."""
        values = prints.view(np.uint8).reshape(-1, BLOCKS)
        met = np.zeros((len(prints), len(self.items)), bool)
        for block in range(BLOCKS):
            met |= self.near[block, values[:, block]]
        window, item = np.nonzero(met)
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= radius
        return window[close], item[close]


@dataclass
class Index:
    """A block of benchmark items."""

    ids: list[int | None]
    radius: int
    similarity: float
    grams: list[np.ndarray] = field(default_factory=list)  # sorted different shingles of each item
    times: list[np.ndarray] = field(default_factory=list)
    by_size: dict[int, Sized] = field(default_factory=dict)
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # all shingles, sorted
    sizes_of: list[np.ndarray] = field(default_factory=list)  # for each of them the sizes of items that have it

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None], radius: int, similarity: float) -> Index:
        index = cls(ids, radius, similarity)
        hashes, first = shingles(*text_buffer(pa.array(texts, pa.string())))
        lists: dict[int, list[int]] = {}
        sizes: dict[int, set[int]] = {}
        prints = []
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            own = hashes[a : max(a, b - SHINGLE + 1)]
            gram, times = np.unique(own, return_counts=True)
            index.grams.append(gram)
            index.times.append(times)
            prints.append(fingerprints_of(own, np.array([len(own)])))
            if len(own):
                lists.setdefault(len(own), []).append(i)
                for g in gram.tolist():
                    sizes.setdefault(g, set()).add(len(own))
        reach = radius // BLOCKS
        values = np.arange(256, dtype=np.uint8)
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= reach
        for size, items in lists.items():
            own = np.concatenate([prints[i] for i in items])
            parts = own.view(np.uint8).reshape(-1, BLOCKS)
            index.by_size[size] = Sized(items, own, np.stack([close[:, parts[:, b]] for b in range(BLOCKS)]))
        index.known = np.array(sorted(sizes), np.uint64)
        index.sizes_of = [np.array(sorted(sizes[g])) for g in sorted(sizes)]
        return index

    def search(self, hashes: np.ndarray, first: np.ndarray) -> list[list[list[tuple]]]:
        """Per text and item that it holds the hits (item id, first word, words, similarity, distance), best first."""
        found: list[list[list[tuple]]] = [[] for _ in first[1:]]
        if not len(self.known) or not len(hashes):
            return found
        place = np.searchsorted(self.known, hashes)
        place[place == len(self.known)] = 0
        hit = np.flatnonzero((self.known[place] == hashes) & (hashes != 0))
        if not len(hit):
            return found
        text = np.searchsorted(first, hit, side="right") - 1
        cut = np.flatnonzero(np.diff(text)) + 1
        for group in np.split(np.arange(len(hit)), cut):
            t = int(text[group[0]])
            low, high = int(first[t]), int(first[t + 1]) - SHINGLE + 1  # shingles of this text
            wanted: dict[int, list[int]] = {}
            for p in hit[group].tolist():
                for size in self.sizes_of[place[p]].tolist():
                    wanted.setdefault(size, []).append(p)
            near: dict[int, list[tuple]] = {}
            for size, at in wanted.items():
                self.search_size(hashes, low, high, size, np.array(at), near)
            for i, parts in sorted(near.items()):
                start, similarity, distance = (np.concatenate(x) for x in list(zip(*parts, strict=True))[1:])
                words = parts[0][0] + SHINGLE - 1
                found[t].append([(self.ids[i], int(start[k]) - low, words, float(similarity[k]), int(distance[k])) for k in apart(start, similarity, words)])
        return found

    def search_size(self, hashes: np.ndarray, low: int, high: int, size: int, at: np.ndarray, near: dict[int, list[tuple]]) -> None:
        """Windows of ``size`` shingles that hold one of the places ``at``, in runs of neighbours.

        A text with fewer shingles is one window; it can share no more than it has.
        """
        length = min(size, high - low)
        if length / size < self.similarity - 1e-12:
            return
        begin, end = np.maximum(low, at - length + 1), np.minimum(high - length, at)
        head = np.flatnonzero(np.concatenate(([True], begin[1:] > np.maximum.accumulate(end)[:-1] + 1)))
        sized = self.by_size[size]
        for a, b in zip(head.tolist(), [*(head[1:] - 1).tolist(), len(begin) - 1], strict=True):
            last = int(end[a : b + 1].max())
            for start in range(int(begin[a]), last + 1, PIECE // 64):  # a long run in parts
                own = hashes[start : min(last, start + PIECE // 64 - 1) + length]
                prints = window_fingerprints(own, length)
                window, item = sized.candidates(prints, self.radius)
                for i in np.unique(item).tolist():
                    self.verify(own, length, size, start, window[item == i], sized.items[i], prints, sized.prints[i], near)

    def verify(self, own: np.ndarray, length: int, size: int, start: int, windows: np.ndarray, item: int, prints: np.ndarray, print_: np.uint64, near: dict[int, list[tuple]]) -> None:
        gram, times = self.grams[item], self.times[item]
        for part in np.array_split(windows, -(-len(windows) // 4096)):
            low, high = int(part[0]), int(part[-1]) + length
            place = np.searchsorted(gram, own[low:high])
            place[place == len(gram)] = 0
            same = gram[place] == own[low:high]
            sums = np.zeros((high - low + 1, len(gram)), np.int32)
            sums[1:][np.flatnonzero(same), place[same]] = 1
            np.cumsum(sums, axis=0, out=sums)
            shared = np.minimum(sums[part - low + length] - sums[part - low], times).sum(1)
            similarity = shared / (length + size - shared)
            enough = similarity >= self.similarity - 1e-12
            if enough.any():
                hit = part[enough]
                near.setdefault(item, []).append((length, start + hit, similarity[enough], np.bitwise_count(prints[hit] ^ print_)))


def apart(start: np.ndarray, similarity: np.ndarray, words: int) -> list[int]:
    """Windows that don't overlap: the best one (the first of equals), the best of those apart from it, and so on."""
    chosen: list[int] = []
    out = []
    for k in np.lexsort((start, -similarity)).tolist():
        s = int(start[k])
        at = bisect(chosen, s)
        if (at == 0 or s - chosen[at - 1] >= words) and (at == len(chosen) or chosen[at] - s >= words):
            chosen.insert(at, s)
            out.append(k)
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    block_items: int = BLOCK_ITEMS,
    block_words: int = BLOCK_WORDS,
    result: str = "leaks",
    spans: str = "leak_spans",
) -> DataFrame:
    """Add ``leak_spans`` to documents, the near copies of benchmark items in the text, and ``leaks``, the best of each
    item. Spans of one item don't overlap: the best window, the best of those apart from it, and so on.

    A leak is (item, start, words, similarity, distance): the window's first word and size, the Jaccard similarity of
    five-word shingles with their counts, at least ``similarity``, and the distance of fingerprints. Words are compared
    without punctuation and the case of A-Z; words of punctuation only don't count, and places count the others.

    A document with fewer words than an item is compared whole. Items with fewer than five words, or a null text, can't
    be told from ordinary text and match nothing; so do null documents and those with fewer than five words. Items may
    repeat (with another id each shows). Columns stay; those with the names of results are replaced. An empty table on
    either side gives no leaks.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{item_text_col}`").alias("text"))
    items = items.filter(F.col("text").isNotNull()).distinct()
    items, _ = settle(items)
    row = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.split("text", SPACE))).alias("words")).first()
    blocks = max(1, math.ceil(row["n"] / block_items), math.ceil((row["words"] or 0) / block_words))
    out = docs.withColumn(found := free_name(docs, "found"), F.array().cast(HITS))
    out = out.withColumn(every := free_name(out, "every"), F.array().cast(HITS))
    number = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.filter(number == block).orderBy("id", "text").collect()  # about block_items at most
        index = spark.sparkContext.broadcast(Index.of([r["id"] for r in rows], [r["text"] for r in rows], radius, similarity))

        def step(batch: pa.RecordBatch, index=index) -> list[pa.Array]:
            names = ("item", "start", "words", "similarity", "distance")
            hits = index.value.search(*shingles(*text_buffer(batch.column(text_col))))
            best = [[own[0] for own in row] for row in hits]
            whole = [[h for own in row for h in sorted(own, key=lambda h: h[1])] for row in hits]
            return [pa.array([[dict(zip(names, h, strict=True)) for h in row] for row in rows], HITS_ARROW) for rows in (best, whole)]

        fresh, more = free_name(out, "fresh"), free_name(out, "more")
        out = append_columns(out, text_col, step, {fresh: HITS, more: HITS})
        out = out.withColumns({found: F.concat(found, fresh), every: F.concat(every, more)}).drop(fresh, more)
        if blocks > 1:
            out, _ = settle(out)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (result.lower(), spans.lower())]
    return out.select(*kept, F.col(found).alias(result), F.col(every).alias(spans))


HITS_ARROW = pa.list_(
    pa.struct([("item", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("similarity", pa.float64()), ("distance", pa.int32())])
)
