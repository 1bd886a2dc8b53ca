"""Rolling hashes over whole columns of texts, and the windows that equal texts must share.

Texts of an Arrow batch lie one behind the other in one buffer, so every step here is one pass of numpy over
that buffer. A hash is a sum of token values times powers of an odd number, modulo 2**64, and mixed at the end:
the hash of any stretch is the difference of two running sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
PIECE = 1 << 18  # tokens that are worked on at once: few enough for caches and for two tasks beside a JVM


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", INVERSE)):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))


POWERS = Powers()


def running(values: np.ndarray) -> np.ndarray:
    """Running sums of values times powers; one more entry than values."""
    POWERS.grow(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * POWERS.up[: len(values)], out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in [start, end)."""
    return mix((sums[end] - sums[start]) * POWERS.down[start] + (end - start).astype(np.uint64) * BASE)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by minima from both ends of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    if width == 1:
        return values
    full = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without space, tab to carriage return), and the first word of each text."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, in pieces so that the running sums stay small."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + PIECE)))
        low, high = starts[first], ends[last - 1]
        sums = running(BYTE_VALUES[raw[low:high]])
        out[first:last] = stretch(sums, starts[first:last] - low, ends[first:last] - low)
        first = last
    return out


@dataclass
class Stretches:
    """Stretches of windows with the same smallest gram. All arrays have one entry per stretch."""

    text: np.ndarray  # number of the text
    start: np.ndarray  # first window, as a token position in the text
    windows: np.ndarray  # how many windows follow each other
    key: np.ndarray  # the smallest gram of each of these windows
    content: np.ndarray  # hash of all tokens of the stretch
    twice: np.ndarray  # whether the gram stands at several places in the stretch


def pieces(at: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
    """(first text, last text + 1, offset) of runs of texts with up to PIECE tokens; a longer text comes in parts."""
    n, first = len(at) - 1, 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + PIECE, side="right")) - 1
        if last > first:
            yield first, last, 0
            first = last
        else:
            for offset in range(0, max(1, int(at[first + 1] - at[first]) - window + 1), PIECE):
                yield first, first + 1, offset
            first += 1


def stretches(values: np.ndarray, at: np.ndarray, window: int, gram: int) -> Iterator[Stretches]:
    """Every window of ``window`` tokens, filed under the smallest hash of its grams.

    Equal windows have the same smallest gram wherever they stand, so they are filed under the same key.
    Neighbouring windows with one key make a stretch; a stretch of ``windows`` windows has ``windows + window - 1``
    tokens. ``values`` are the tokens' 64-bit values and ``at`` the offsets of the texts.
    """
    width = window - gram + 1
    for first, last, offset in pieces(at, window):
        low = int(at[first]) + offset
        high = int(at[last]) if last > first + 1 else min(int(at[last]), low + PIECE + window - 1)
        if high - low < window:
            continue
        sums = running(values[low:high])
        here = np.arange(high - low - gram + 1)
        grams = stretch(sums, here, here + gram)
        least = sliding_min(grams, width)
        texts = np.arange(first, last)
        begin = np.maximum(at[first:last], low) - low
        count = np.maximum(0, np.minimum(at[first + 1 : last + 1], high) - low - begin - window + 1)
        owner = np.repeat(texts, count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        if not len(place):
            continue
        value = least[place]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        run = np.flatnonzero(fresh)
        size = np.diff(np.append(run, len(place)))
        start, key = place[run], value[run]
        end = start + size - 1
        twice = np.empty(len(run), bool)
        for i in range(0, len(run), 4096):
            part = slice(i, i + 4096)
            left = grams[start[part, None] + np.arange(width)] == key[part, None]
            right = grams[end[part, None] + np.arange(width)[::-1]] == key[part, None]
            twice[part] = start[part] + left.argmax(1) < end[part] + width - 1 - right.argmax(1)
        text = owner[run]
        content = stretch(sums, start, end + window)
        yield Stretches(text, start + low - at[text], size, key, content, twice)
