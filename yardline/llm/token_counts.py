"""Token counts of the sections of documents.

A document is encoded once, as a whole. Its tokens' spans, in characters, are joined with the spans of its sections:
both lie in order, so the join is one search of token edges in section edges. A token that reaches over a border is
allotted by a rule, and never counts twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from yardline.llm.bpe import vocabulary
from yardline.llm.common import append_columns
from yardline.llm.rolling import text_buffer

SECTIONS = "array<struct<section:int,lo:long,hi:long,n_tokens:long,n_crossing:long>>"
RULES = ("first", "most")


def allot(lo: np.ndarray, hi: np.ndarray, edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (lo, hi), of sections between neighbouring ``edges``, and whether it reaches over a border.

    ``first``: the section of its first character. ``most``: the section with most of its characters, the first of
    equals. Empty sections get no token.
    """
    own = np.searchsorted(edges, lo, side="right") - 1
    last = np.searchsorted(edges, np.maximum(hi - 1, lo), side="right") - 1
    crossing = own < last
    if rule == "most":
        for i in np.flatnonzero(crossing).tolist():
            cuts = np.concatenate(([lo[i]], edges[own[i] + 1 : last[i] + 1], [hi[i]]))
            own[i] += int(np.argmax(np.diff(cuts)))
    return own, crossing


def line_edges(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte edges of lines over all texts (a line ends after its line feed), and each text's number of lines."""
    after = np.flatnonzero(raw == 10) + 1
    text = np.searchsorted(at, after - 1, side="right") - 1
    inner = after < at[text + 1]  # the last line feed of a text starts no line
    count = np.bincount(text[inner], minlength=len(at) - 1) + 1
    starts = np.concatenate((at[:-1], after[inner]))
    order = np.lexsort((starts, np.concatenate((np.arange(len(at) - 1), text[inner]))))
    return starts[order], count


def section_tokens(
    docs: DataFrame, path: str, text_col: str = "text", *, spans_col: str | None = None, rule: str = "first", result: str = "sections"
) -> DataFrame:
    """Add ``sections``: (section, lo, hi, n_tokens, n_crossing) of each section, in order.

    ``path`` is a byte-level vocabulary on every executor. Sections are lines, each with its line feed, or those of
    ``spans_col`` (array of long: the characters at which sections after the first start, ascending; others are cut
    to the text). Every character is in one section, so the counts of a text add up to its tokens. A token whose
    characters lie in two sections goes by ``rule`` (see ``allot``) and is in n_crossing of the one that gets it. A
    token that holds only the later bytes of a character belongs where that character is.

    A null or empty text has one empty section without tokens. Rows may repeat; a column with the name of the result
    is replaced; an empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        words = vocabulary(path)
        column = batch.column(text_col)
        raw, at = text_buffer(column)
        ids = [words.encode(t or "") for t in column.to_pylist()]
        count = np.array([len(x) for x in ids], np.int64)
        ids = np.concatenate(ids).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
        length = words.at[ids + 1] - words.at[ids]
        end = np.cumsum(length)  # bytes; the tokens of a text cover it, so those of all texts cover the buffer
        # characters that start before each byte; a byte within a character counts as its first byte
        chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        base = chars[at]
        lo = chars[end - length + 1] - 1 if len(end) else end
        hi = chars[end]
        if spans_col is None:
            starts, number = line_edges(raw, at)
            starts = chars[starts]
        else:
            starts, number = given_edges(batch.column(spans_col), base)
        text = np.repeat(np.arange(len(at) - 1), number)
        n_tokens, n_crossing = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        first_section = np.cumsum(number) - number
        own, crossing = allot(lo, hi, np.append(starts, chars[-1]), rule)
        # sections of texts without characters share an edge with the next text's first
        owner = np.repeat(np.arange(len(at) - 1), count)
        own = np.clip(own, first_section[owner], first_section[owner] + number[owner] - 1)
        np.add.at(n_tokens, own, 1)
        np.add.at(n_crossing, own[crossing], 1)
        ends = np.append(starts[1:], chars[-1])
        last = first_section + number - 1
        ends[last] = base[1:]
        offsets = pa.array(np.concatenate(([0], np.cumsum(number))).astype(np.int32))
        section = (np.arange(len(starts)) - first_section[text]).astype(np.int32)
        columns = [section, starts - base[text], ends - base[text], n_tokens, n_crossing]
        names = ["section", "lo", "hi", "n_tokens", "n_crossing"]
        return [pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in columns], names=names))]

    return append_columns(docs, text_col, step, {result: SECTIONS})


def given_edges(spans: pa.ListArray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of sections, the first at the start of each text, from lists of places."""
    length = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    places = pc.fill_null(spans.flatten(), 0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(length)), length)
    starts = np.clip(places, 0, base[text + 1] - base[text]) + base[text]
    starts = np.concatenate((base[:-1], starts))
    text = np.concatenate((np.arange(len(length)), text))
    return starts[np.lexsort((starts, text))], length + 1
