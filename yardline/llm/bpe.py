"""BPE encoding and decoding.

A word is encoded from left to right. An Aho-Corasick scan gives the longest token at every place; a token is taken if
it may stand beside the one before it, else the next shorter one is tried, and if none is left the last token is taken
back. Two tokens may stand side by side if merging would never join or cut across their border; that is found by
undoing merges on both sides and kept in a table. The result is what merging in order of ranks gives, in linear time.

Decoding gathers the tokens' bytes from one buffer by a table of offsets.

Vocabularies are files of the ``tokenizers`` library that every executor finds under one path: lower-cased words
with an end mark, or bytes of the whole text.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from sys import getsizeof

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from yardline.llm.common import append_columns

END = "</w>"
END_MARK = ""  # stands for END within a word; the byte alphabet doesn't have it
MOST_BYTES = 96 << 20  # of memory for chunks of text that a task remembers, and as much for older ones
LONGEST = 64  # characters of a chunk that is remembered; text without spaces is one chunk, hardly ever seen again
MOST_PAIRS = 1 << 20  # pairs in the table
# fixed patterns of the two kinds of vocabulary
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
SEPARATORS = regex.compile("[\x1c-\x1f]")  # white space for Python only
BESIDE_SPACE = regex.compile(r"\s | \s")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Remembered(dict):
    """Ids of chunks of text. When it is full, what was used lately stays: it becomes the older half, from which
    chunks come back as they are met again. Its bound is in bytes."""

    def __init__(self, words: Vocabulary, most: int = MOST_BYTES) -> None:
        self.words, self.most, self.older, self.held = words, most, {}, 0

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = self.older.get(chunk)
        if ids is None:
            words = self.words
            parts = words.pattern.findall(chunk)
            if len(parts) == 1 and parts[0] == chunk:
                ids = words.encode_word(chunk)
            else:
                ids = tuple(chain.from_iterable([self[w] for w in parts]))
        if len(chunk) <= LONGEST:
            self[chunk] = ids
            self.held += getsizeof(chunk) + getsizeof(ids) + 100  # and its place in the table
        return ids

    def make_room(self) -> None:
        if self.held > self.most:
            self.older, self.held = dict(self), 0
            self.clear()


class Vocabulary:
    """Tokens, merges and the table of compatible pairs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = bool(model["end_of_word_suffix"])
        self.lower = spec["normalizer"] is not None
        self.spaced = spec["decoder"] is None  # decoding joins the tokens' names
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = model["vocab"]
        self.size = max([*ids.values(), *self.specials.values()]) + 1
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        last = -1
        for a, b in model["merges"]:
            whole = ids[a + b]
            if whole <= last:
                raise ValueError("token ids must follow the order of merges")
            self.merged[ids[a], ids[b]] = last = whole
            self.parts[whole] = ids[a], ids[b]
        self.names = {i: n for n, i in ids.items()} | {i: n for n, i in self.specials.items()}
        self.length: dict[int, int] = {}
        scan = ahocorasick.Automaton()
        for name, i in ids.items():
            text = name[: -len(END)] + END_MARK if self.suffix and name.endswith(END) else name
            self.length[i] = len(text)
            scan.add_word(text, i)
        scan.make_automaton()
        self.scan = scan
        self.beside: dict[tuple[int, int], bool] = {}
        self.alphabet = byte_alphabet()
        self.pattern = regex.compile(WORDS if self.suffix else PIECES)
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in self.specials)) if self.specials else None
        self.whole = Remembered(self)
        self.table, self.at = self.offset_table()

    def _border_holds(self, a: int, b: int) -> bool:
        # Go back through the merges that made a and b, latest first. At each moment the two tokens at the border
        # must not merge before the later of them was made. A tie of ranks goes to the left.
        merged, parts = self.merged, self.parts
        before = self.size  # merges of this rank and later come too late
        while True:
            across = merged.get((a, b))
            if across is not None and across < before:
                return False
            left, right = parts.get(a), parts.get(b)
            if left and (not right or a > b):
                before, a = a, left[1]
            elif right:
                before, b = b + 1, right[0]
            else:
                return True

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of a word, by backtracking over its text in the byte alphabet."""
        text = "".join([self.alphabet[b] for b in word.encode("utf-8")]) + (END_MARK if self.suffix else "")
        length, beside = self.length, self.beside
        if len(beside) > MOST_PAIRS:
            beside.clear()
        fitting: list[list[int]] = [[] for _ in text]  # tokens from each place, longest last
        for end, token in self.scan.iter(text):
            fitting[end + 1 - length[token]].append(token)
        dead = set()  # places from which the rest can't be encoded
        place, last, tokens, n = 0, -1, [], len(text)
        while place < n:
            if fitting[place]:  # a place is entered once: either its rest can be encoded or it is dead
                token = fitting[place].pop()
                after = place + length[token]
                if after in dead:
                    continue
                if tokens:
                    fits = beside.get((last, token))
                    if fits is None:
                        fits = beside[last, token] = self._border_holds(last, token)
                    if not fits:
                        continue
                tokens.append(token)
                place, last = after, token
            elif tokens:
                dead.add(place)
                place -= length[tokens.pop()]
                last = tokens[-1] if tokens else -1
            else:
                raise ValueError(f"no tokens for {word!r}")
        return tuple(tokens)

    def segments(self, text: str) -> Iterator[tuple[int | None, str, int]]:
        """(id of a special token or None, text, offset) in order."""
        first = 0
        if self.special_pattern and "<|" in text:
            for m in self.special_pattern.finditer(text):
                if m.start() > first:
                    yield None, text[first : m.start()], first
                yield self.specials[m[0]], m[0], m.start()
                first = m.end()
        if first < len(text):
            yield None, text[first:] if first else text, first

    def chunks(self, part: str) -> list[str]:
        """Parts of a text that are encoded each for itself, so that their ids can be remembered."""
        if self.suffix:  # words never hold white space; split() takes four more characters for it
            return part.split() if not SEPARATORS.search(part) else self.pattern.findall(part)
        # a space between two other characters starts a piece, whatever stands before it
        if part[:1].isspace() or part[-1:].isspace() or BESIDE_SPACE.search(part):
            return self.pattern.findall(part)
        first, *rest = part.split(" ")
        return [first, *[" " + x for x in rest]]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return np.fromiter(chain.from_iterable(self.encode_parts(text)), np.int32)

    def encode_parts(self, text: str) -> list[tuple[int, ...]]:
        """Ids of the chunks of a text."""
        self.whole.make_room()
        found: list[tuple[int, ...]] = []
        whole = self.whole
        for special, part, _ in self.segments(text):
            if special is not None:
                found.append((special,))
                continue
            if self.lower:
                # letter by letter, so without a final sigma
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            found += [whole[c] for c in self.chunks(part)]
        return found

    def offset_table(self) -> tuple[np.ndarray, np.ndarray]:
        back = {c: b for b, c in enumerate(self.alphabet)}
        special = set(self.specials.values())
        entries = []
        for i in range(self.size):
            name = self.names.get(i, "")
            if self.spaced or i in special:
                entries.append(name.encode() + (b" " if self.spaced and name else b""))
            else:
                entries.append(bytes(back[c] for c in name))
        at = np.concatenate(([0], np.cumsum([len(e) for e in entries])))
        return np.frombuffer(b"".join(entries), np.uint8), at

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[str]:
        """Texts of rows of ids that lie behind each other; ids that aren't in the vocabulary are left out."""
        good = (ids >= 0) & (ids < self.size)
        row = np.repeat(np.arange(len(count)), count)[good]
        ids = ids[good].astype(np.int64)
        length = self.at[ids + 1] - self.at[ids]
        ends = np.cumsum(length)
        raw = self.table[np.repeat(self.at[ids] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        size = np.bincount(row, length, len(count)).astype(np.int64)
        to = np.cumsum(size)
        cut = 1 if self.spaced else 0
        return [raw[a : max(a, b - cut)].decode("utf-8", "replace") for a, b in zip((to - size).tolist(), to.tolist(), strict=True)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encoded(column: pa.Array, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts behind each other, and how many each text has."""
    ids = [words.encode(t or "") for t in column.to_pylist()]
    return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array([len(x) for x in ids], np.int64)


def _lists(ids: np.ndarray, count: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """Add the ids of whole texts (array of int), with no special tokens but those that a text spells out.

    ``path`` is the vocabulary's file on every executor. A null or empty text has no ids. Rows may repeat; a column
    with the name of the result is replaced; an empty table gives an empty result.
    """

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        return [_lists(*_encoded(batch.column(text_col), vocabulary(path)))]

    return append_columns(docs, text_col, step, {ids_col: "array<int>"})


def decode(rows: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of ids. Null lists are empty texts; null ids and ids that the vocabulary lacks are left out."""

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        lists = batch.column(ids_col)
        count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        return [pa.array(vocabulary(path).decode(ids, count), pa.string())]

    return append_columns(rows, ids_col, step, {text_col: "string"})


def encode_and_decode(
    docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids", decoded_col: str = "decoded"
) -> DataFrame:
    """``encode`` and then ``decode``, by the same workers: one vocabulary in memory per task, and ids don't travel
    twice."""

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        words = vocabulary(path)
        ids, count = _encoded(batch.column(text_col), words)
        return [_lists(ids, count), pa.array(words.decode(ids, count), pa.string())]

    return append_columns(docs, text_col, step, {ids_col: "array<int>", decoded_col: "string"})
