"""Phrases whose words stand together more often than their parts make likely.

Tasks count phrases in a trie over word ids whose lower part is hash tables (a HAT-trie): a table holds what may follow the
words on the way to it, and bursts into a node with tables by the next bits of a word's id when it has too many entries. A text's words go
in as suffixes of a few words, so the count of a phrase is the sum over the subtree below it. When a task holds too much, the
largest subtrees are taken out as sorted runs, from which one pass gives the counts of all prefixes. Runs are dealt by prefix,
many to a row, and Spark adds them up part by part. A prefix is dealt by all of its words, so no hot word or pair gathers its
continuations in a task.

Words and pairs are counted first, then all longer phrases. A phrase is as frequent as asked only if its pairs are; a
fixed-size bit table of those (``Screen``), which may let others through but holds none back, keeps the rest out of the
tries. Counts are those of whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import lookup, numbered, settle, slices
from yardline.llm.rolling import BASE, mix, text_buffer, word_hashes

WORDS = 5
LEAST = 100
ABSORBED = 100  # per cent of a phrase's occurrences
TOP = 2000
UNKNOWN = "und"
BURST = 1 << 14  # entries of a table
ID_BITS, DIGIT = 24, 6  # bits of a word's id, and those that a node looks at
MOST = 400_000  # entries of a task's trie
MOST_IDS = 1 << 19  # words that a task has ids for
SCREEN_BITS = 25  # a screen has 2 ** bits places: 4 MB, however large the corpus is
PART = 4 << 20  # bytes of text whose words are held at once
ROWS = 1 << 16
RUNS = "part long, lang string, words int, phrases string, counts array<long>"
RUN_NAMES = ["part", "lang", "words", "phrases", "counts"]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
GAP = BREAK.copy()
GAP[[9, 32]] = True


class Screen:
    """A set of hashes as two places each in a bit table; says yes to all of its members and to few others."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << bits) - 1)
        return hashes & mask, hashes >> np.uint64(32) & mask

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, len(self.table).bit_length() + 5):
            found &= (self.table[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang))


def phrase_hashes(langs: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """Hashes of phrases from the hashes of their language and words."""
    out = langs
    for w in words:
        out = mix(out * BASE + w)
    return out


def screen(phrases: DataFrame, words: int, bits: int = SCREEN_BITS) -> Screen:
    """Screen of phrases (lang, phrase) of so many words; at most 2 ** bits bits reach the driver."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_buffer(batch.column("phrase"))
            if not len(raw):
                continue
            inside = raw != 32
            edge = np.zeros(len(raw) + 1, bool)
            edge[at] = True
            starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
            ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
            each = word_hashes(raw, starts, ends).reshape(-1, words)
            langs = np.array([lang_hash(x) for x in batch.column("lang").to_pylist()], np.uint64)
            place = np.concatenate(Screen.places(phrase_hashes(langs, *each.T), bits))
            bit = np.uint64(1) << (place & np.uint64(63))
            yield pa.record_batch([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))], names=["slot", "bits"])

    found = phrases.select("lang", "phrase").mapInArrow(fold, "slot long, bits long").groupBy("slot").agg(F.expr("bit_or(bits)").alias("bits"))
    found = found.toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Screen(table)


class Trie:
    """Counts of rows of word ids (0 fills up short ones), by language: nodes are dicts by the next ``DIGIT`` bits of an id, tables are
    counters of what is left of the rows, as bytes. A table holds the words that share the bits on its way, and has their
    ids whole until all bits are on the way."""

    def __init__(self, width: int, burst: int = BURST) -> None:
        self.width, self.burst, self.entries = width, burst, 0
        self.langs: dict[str, dict | Counter] = {}

    @staticmethod
    def _below(word: int, shift: int) -> tuple[int, int]:
        return (word, shift + DIGIT) if shift + DIGIT < ID_BITS else (word + 1, 0)

    def add(self, lang: str, rows: np.ndarray) -> None:
        """Count rows, an array of big-endian ids."""
        self.langs[lang] = self._add(self.langs.get(lang), rows, None, 0, 0)

    def _add(self, at: dict | Counter | None, rows: np.ndarray, counts: np.ndarray | None, word: int, shift: int) -> dict | Counter:
        """The node or table with the rows in it; their bits before ``word`` and ``shift`` are the way to it."""
        if at is None:
            at = Counter()
        below = self._below(word, shift)
        if isinstance(at, Counter):
            before = len(at)
            keys = np.ascontiguousarray(rows[:, word:]).view(f"S{4 * (self.width - word)}").ravel().tolist()
            if counts is None:
                at.update(keys)
            else:
                for k, n in zip(keys, counts.tolist(), strict=True):
                    at[k] += n
            self.entries += len(at) - before
            if len(at) <= self.burst or below[0] == self.width:
                return at
            self.entries -= len(at)
            rows = np.zeros((len(at), self.width), ">u4")
            rows[:, word:] = self._matrix(list(at), self.width - word)
            counts, at = np.array(list(at.values()), np.int64), {}
        digit = (rows[:, word].astype(np.uint32) >> shift & ((1 << DIGIT) - 1)).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        rows, digit = rows[order], digit[order]
        counts = None if counts is None else counts[order]
        heads = np.flatnonzero(np.concatenate(([True], digit[1:] != digit[:-1])))
        for i, a, b in zip(digit[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(rows)], strict=True):
            at[i] = self._add(at.get(i), rows[a:b], None if counts is None else counts[a:b], *below)
        return at

    @staticmethod
    def _matrix(keys: list[bytes], width: int) -> np.ndarray:
        return np.array(keys, f"S{4 * width}").view(">u4").reshape(-1, width)

    def _size(self, at: dict | Counter) -> int:
        return len(at) if isinstance(at, Counter) else sum(self._size(x) for x in at.values())

    def _run(self, at: dict | Counter, way: bytes, bits: int, word: int, shift: int, keys: list[bytes], counts: list[int]) -> None:
        """Append a subtree's entries: equal beginnings lie together."""
        if isinstance(at, Counter):
            own = sorted(at)
            keys += [way + k for k in own] if way else own
            counts += [at[k] for k in own]
            return
        below = self._below(word, shift)
        for i in sorted(at):
            whole = bits | i << shift
            if below[0] > word:
                self._run(at[i], way + whole.to_bytes(4, "big"), 0, *below, keys, counts)
            else:
                self._run(at[i], way, whole, *below, keys, counts)

    def spill(self, keep: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until ``keep`` entries are left: (language, rows, counts), with rows of
        equal beginnings next to each other."""
        trees = []
        for lang, at in self.langs.items():
            if isinstance(at, Counter):
                trees.append((len(at), lang, None))
            else:
                trees += [(self._size(x), lang, i) for i, x in at.items()]
        trees.sort(key=lambda t: -t[0])
        chosen: dict[str, list[int | None]] = {}
        for size, lang, i in trees:
            if self.entries <= keep:
                break
            self.entries -= size
            chosen.setdefault(lang, []).append(i)
        for lang, firsts in chosen.items():
            at = self.langs[lang]
            keys: list[bytes] = []
            counts: list[int] = []
            if firsts == [None]:
                self._run(at, b"", 0, 0, 0, keys, counts)
                self.langs[lang] = Counter()
            else:
                below = self._below(0, 0)
                for i in sorted(firsts):
                    self._run(at.pop(i), b"", i, *below, keys, counts)
            yield lang, self._matrix(keys, self.width), np.array(counts, np.int64)


def prefix_counts(rows: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different prefixes of so many words in a run, and the counts of their subtrees."""
    long = np.flatnonzero(rows[:, words - 1] > 0)
    if not len(long):
        return long, long
    own = rows[long, :words]
    heads = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]).any(axis=1))))
    return long[heads], np.add.reduceat(counts[long], heads)


class Counting:
    """What a task holds: ids of words, and the trie of suffixes with ``least`` to ``most`` words."""

    def __init__(self, least: int, most: int, held: Screen | None, size: int = MOST, burst: int = BURST, parts: int = 1) -> None:
        self.least, self.most, self.screen, self.size, self.parts = least, most, held, size, parts
        self.ids: dict[bytes, int] = {}
        self.trie = Trie(most, burst)
        self.words: Counter = Counter()

    def add(self, batch: pa.RecordBatch) -> None:
        raw, at = text_buffer(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        low = 0
        while low < len(raw):
            high = min(low + PART, len(raw))
            gap = np.flatnonzero(GAP[raw[high : high + PART]])
            while high < len(raw) and not len(gap):  # a word longer than a part
                high = min(high + PART, len(raw))
                gap = np.flatnonzero(GAP[raw[high : high + PART]])
            high = min(high + int(gap[0]), len(raw)) if len(gap) else len(raw)
            reach, ahead = high, 1 << 12  # the words that the last suffixes need
            while reach < len(raw) and np.count_nonzero(np.diff(GAP[raw[high:reach]].view(np.int8)) == 1) < self.most:
                reach, ahead = min(high + ahead, len(raw)), 2 * ahead
            self._add(raw[low:reach], np.clip(at - low, 0, reach - low), langs, high - low)
            low = high

    def _add(self, raw: np.ndarray, at: np.ndarray, langs: list[str], stop: int) -> None:
        inside = ~GAP[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
        ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
        if not len(starts):
            return
        count = int(np.searchsorted(starts, stop))
        doc = np.searchsorted(at, starts, side="right") - 1
        piece = np.cumsum(BREAK[raw])[starts]
        joined = np.zeros(len(starts), bool)  # with the next word
        joined[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        # the last word may go on beyond ``raw`` only where it can't be needed
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        letters = LOWER[raw[inside]]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        word, names = coded.indices.to_numpy(), coded.dictionary
        kinds = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        lang = np.array([kinds[x] for x in langs], np.int64)[doc]
        if self.least == 1:
            for x, i in kinds.items():
                self.words[x] += int(np.count_nonzero(lang[:count] == i))
        length = self._lengths(joined, word, names, np.array([lang_hash(x) for x in kinds], np.uint64)[lang])
        begin = np.flatnonzero(length[:count] >= self.least)
        size = length[begin]
        used = np.zeros(len(names), bool)
        for j in range(self.most):
            used[word[begin[size > j] + j]] = True
        own = np.zeros(len(names), ">u4")
        own[used] = [self.ids.setdefault(w, len(self.ids) + 1) for w in names.filter(pa.array(used)).to_pylist()]
        rows = np.zeros((len(begin), self.most), ">u4")
        for j in range(self.most):
            long = np.flatnonzero(size > j)
            rows[long, j] = own[word[begin[long] + j]]
        for x, i in kinds.items():
            mine = rows[lang[begin] == i]
            if len(mine):
                self.trie.add(x, mine)

    def _lengths(self, joined: np.ndarray, word: np.ndarray, names: pa.Array, langs: np.ndarray) -> np.ndarray:
        """Words of the longest suffix from each word that is counted: up to ``most``, within a piece, and by pairs that the screen
        has."""
        link = joined
        if self.screen is not None:
            buffer, at = text_buffer(names)
            each = word_hashes(buffer, at[:-1], at[1:])[word]
            link = joined.copy()
            pair = np.flatnonzero(joined)
            link[pair] = self.screen.has(phrase_hashes(langs[pair], each[pair], each[pair + 1]))
        length = np.ones(len(joined), np.int64)
        going = np.ones(len(joined), bool)
        for j in range(self.most - 1):
            going = going & np.append(link[j:], np.zeros(min(j, len(link)), bool))
            length += going
        return length

    def spill(self, keep: int = 0) -> Iterator[pa.RecordBatch]:
        """Sorted runs as rows (part, lang, words, phrases, counts), phrases one a line."""
        names = pa.array([b"", *self.ids], pa.binary()).cast(pa.string())
        buffer, offsets = text_buffer(names)
        each = word_hashes(buffer, offsets[:-1], offsets[1:])
        for lang, rows, counts in self.trie.spill(keep):
            for words in range(self.least, self.most + 1):
                at, n = prefix_counts(rows, counts, words)
                for i in range(0, len(at), ROWS):
                    own = rows[at[i : i + ROWS], :words].astype(np.int64)
                    part = phrase_hashes(np.full(len(own), lang_hash(lang)), *each[own.T]) % np.uint64(self.parts)
                    order = np.argsort(part, kind="stable")
                    part, own = part[order].astype(np.int64), own[order]
                    columns = [names.take(pa.array(own[:, j])) for j in range(words)]
                    phrase = pc.binary_join_element_wise(*columns, " ") if words > 1 else columns[0]
                    heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                    edges = pa.array(np.append(heads, len(part)).astype(np.int32))
                    k = len(heads)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part[heads]),
                            pa.array([lang] * k),
                            pa.array(np.full(k, words, np.int32)),
                            pc.binary_join(pa.ListArray.from_arrays(edges, phrase), "\n"),
                            pa.ListArray.from_arrays(edges, pa.array(n[i : i + ROWS][order])),
                        ],
                        names=RUN_NAMES,
                    )
        if not keep:
            self.ids.clear()

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.ids) > MOST_IDS:
            yield from self.spill()
        elif self.trie.entries > self.size:
            yield from self.spill(self.size // 2)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.spill()
        for lang, n in self.words.items():  # all words, as the phrase of none
            columns = [pa.array([0]), pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([[n]], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, RUN_NAMES)


def counted(texts: DataFrame, least: int, most: int, at_least: int, held: Screen | None = None, size: int = MOST, burst: int = BURST) -> DataFrame:
    """Phrases of ``least`` to ``most`` words in texts (lang, text) that occur ``at_least`` times: (lang, phrase, words, n).

    Counting words also gives the number of all words of each language, under the empty phrase. Settled."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(held)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Counting(least, most, shared.value, size, burst, parts)
        for batch in batches:
            for part in slices(batch, "text"):
                task.add(part)
                yield from task.full()
        yield from task.end()

    runs = texts.mapInArrow(run, RUNS).repartition("part")
    rows = runs.select("part", "lang", "words", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("counts").alias("n"))))
    total = rows.groupBy("part", "lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return settle(total.select("lang", "phrase", "words", "n").filter((F.col("n") >= at_least) | (F.col("words") == 0)))[0]


def frequent(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, words: int = WORDS, at_least: int = LEAST, size: int = MOST,
    burst: int = BURST, bits: int = SCREEN_BITS,
) -> DataFrame:
    """Phrases of up to ``words`` words that occur ``at_least`` times in a language: (lang, phrase, words, n), and the number of all words
    of each language under the empty phrase."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    out = counted(texts, 1, min(words, 2), at_least, None, size, burst)
    if words > 2:
        pairs = screen(out.filter("words = 2"), 2, bits)
        out = out.unionByName(counted(texts, 3, words, at_least, pairs, size, burst))
    return settle(out)[0]


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, words, a, l, r, n, score) from ``frequent``: the least score of all cuts, at the first of equal
    ones. Numbers are exact, products as decimals. The parts of a candidate are at least as frequent as itself, so
    they are all there."""
    known = phrases.filter("words > 0").select("lang", "phrase", F.col("n").alias("count"))
    totals = phrases.filter("words = 0").select("lang", F.col("n").alias("total"))
    cuts = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    cuts = lookup(cuts, known.withColumnsRenamed({"phrase": "first", "count": "l"}), ["lang", "first"], "inner")
    cuts = lookup(cuts, known.withColumnsRenamed({"phrase": "rest", "count": "r"}), ["lang", "rest"], "inner")
    cuts = lookup(cuts, totals.withColumnRenamed("total", "n"), ["lang"], "inner")
    score = F.expr("(cast(a as decimal(18,0)) * (cast(n as decimal(18,0)) * 1000)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    cuts = cuts.withColumn("cut", F.struct(score.cast("long").alias("score"), "k", "l", "r"))
    best = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min("cut").alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(candidates: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """Candidates (lang, phrase, words, a, ...) that aren't part of a longer one with ``absorbed`` per cent of their occurrences."""
    longer = candidates.filter("words > 2").select("lang", "words", "a", F.split("phrase", " ").alias("w"))
    longer = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    parts = longer.select("lang", F.array_join(F.slice("w", F.col("start"), F.col("size")), " ").alias("part"), "a")
    most = parts.groupBy("lang", "part").agg(F.max("a").alias("most"))
    met = candidates.join(most.withColumnRenamed("lang", "_lang"), (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("part")), "left")
    gone = F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * absorbed
    return met.filter(~F.coalesce(gone, F.lit(False))).drop("_lang", "part", "most")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, words: int = WORDS, at_least: int = LEAST, absorbed: int = ABSORBED,
    top: int = TOP, size: int = MOST, burst: int = BURST, bits: int = SCREEN_BITS,
) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``words`` words: (lang, rank, phrase, a, l, r, n, score).

    A-Z are lower-cased. Phrases don't cross ``.,;:!?`` or line ends, nor documents; words are runs without space or tab. A
    null language is ``und``; null and empty texts have no words. Repeated rows count each time. Phrases are ranked by
    score, then count, then themselves (bytes), so there are no ties. Other columns don't matter; an empty table gives an empty
    result.
    """
    found = frequent(docs, text_col, lang_col, words=words, at_least=at_least, size=size, burst=burst, bits=bits)
    best, _ = settle(maximal(settle(scored(found))[0], absorbed).withColumns({"_score": -F.col("score"), "_a": -F.col("a")}))
    ranked, _ = numbered(best, ["lang"], ["_score", "_a", "phrase"], "place")
    return ranked.filter(F.col("place") < top).select("lang", (F.col("place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
