"""SimHash near-dedup: fingerprints of shingles, and all links within a few bits.

A fingerprint is mapped to the numbers of ones in its 32 segments of two bits. The Manhattan distance of these counts
never exceeds the Hamming distance. The counts are cut into blocks so that two fingerprints in reach differ by at most
one step in some block: a grid whose cells are the counts of a block, in which each fingerprint has one cell and asks
for that cell and those one step away. What meets there is held against the Manhattan bound and then the exact
distance, within the join. Equal fingerprints are one node, so copies cost nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm import repeats
from yardline.llm.common import append_columns, free_name, settle, shuffled
from yardline.llm.components import components
from yardline.llm.rolling import text_buffer, word_spans

SHINGLE = 3
DISTANCE = 3
SEED = 42
PART = 1 << 15  # hashes whose bits are unpacked at once
SEGMENTS = 32
LOW_BITS = 0x5555555555555555


def shingle_hashes(words: bytes, shingle: int) -> list[int]:
    """XXH64 of the shingles of words that have one space between them."""
    starts, ends, _ = word_spans(np.frombuffer(words, np.uint8), np.array([0, len(words)]))
    digest = xxhash.xxh64_intdigest
    if len(starts) <= shingle:
        return [digest(words, SEED)] if len(starts) else []
    pairs = zip(starts[: len(starts) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return [digest(words[a:b], SEED) for a, b in pairs]


def fingerprints_of(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Fingerprints of rows whose 64-bit hashes lie behind each other; zero without hashes."""
    sums = np.zeros((len(count), 64), np.int64)
    row = np.repeat(np.arange(len(count)), count)
    for first in range(0, len(hashes), PART):
        bits = np.unpackbits(hashes[first : first + PART].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = row[first : first + PART]
        head = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        sums[rows[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int32)
    ones = (2 * sums > count[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, text_col: str = "text", result: str = "fingerprint", *, shingle: int = SHINGLE) -> DataFrame:
    """Add the 64-bit fingerprint of whole texts (long, the bits as they are).

    A-Z are lower-cased; words are runs without space, tab to carriage return. A text with fewer words than a shingle
    has one shingle of all of them. Without a word, and for null, the fingerprint is zero.
    """

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        raw, at = text_buffer(batch.column(text_col))
        data, ends = raw.tobytes().lower(), at.tolist()
        each = [shingle_hashes(b" ".join(data[a:b].split()), shingle) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        count = np.array([len(x) for x in each], np.int64)
        hashes = np.array([h for x in each for h in x], np.uint64)
        return [pa.array(fingerprints_of(hashes, count).view(np.int64))]

    return append_columns(docs, text_col, step, {result: "long"})


def counts(bits: Column) -> Column:
    """Ones per segment of two bits, in unary (00, 01, 11): the distance of counts is that of these bits."""
    above = F.shiftrightunsigned(bits, 1)
    both, either = bits.bitwiseAND(above).bitwiseAND(F.lit(LOW_BITS)), bits.bitwiseOR(above).bitwiseAND(F.lit(LOW_BITS))
    return F.shiftleft(both, 1).bitwiseOR(either)


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints (column fp) that differ in at most ``distance`` bits."""
    blocks = distance // 2 + 1  # some block then differs by one step at most
    edges = [2 * (SEGMENTS * i // blocks) for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    embedded = nodes.select("fp", counts(F.col("fp")).alias("counts"))
    cells = [F.struct(F.lit(i).alias("block"), F.col("counts").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(masks)]
    home = embedded.select(F.col("fp").alias("a"), F.col("counts").alias("counts_a"), F.inline(F.array(*cells)))
    asked = embedded.select(F.col("fp").alias("b"), F.col("counts").alias("counts_b"), F.inline(F.array(*cells)), F.lit(edges).alias("edges"))
    # a lower bit of a segment flips while the upper one is 0, an upper one while the lower is 1
    steps = """concat(array(cell), transform(filter(sequence(edges[block], edges[block + 1] - 1),
        i -> getbit(cell, i ^ 1) = i % 2), i -> cell ^ shiftleft(1L, i)))"""
    asked = asked.select("b", "counts_b", "block", F.explode(F.expr(steps)).alias("cell"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("counts_a").bitwiseXOR(F.col("counts_b"))) <= distance)
    near = near & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    asked = asked.withColumnsRenamed({"block": "block_b", "cell": "cell_b"})
    met = home.join(shuffled(asked), (F.col("block") == F.col("block_b")) & (F.col("cell") == F.col("cell_b")) & near)
    return met.select("a", "b").distinct()


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows (r1, r2, id, fp), and per fingerprint its component's smallest id and the row that stays (settled)."""
    r1, r2 = repeats.row_key(id_col, text_col)
    rows = docs.select(r1.alias("r1"), r2.alias("r2"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows, _ = settle(fingerprints(rows, "text", "fp", shingle=shingle).drop("text"))
    row = F.struct(F.col("id").isNull().alias("unknown"), "r1", "r2")
    nodes, _ = settle(rows.groupBy("fp").agg(F.min("id").alias("id"), F.min(row).alias("row")))
    roots = components(links(nodes, distance))
    roots = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    roots, _ = settle(roots.select("fp", F.coalesce("root", "fp").alias("root"), "id", "row"))
    least = roots.groupBy("root").agg(F.min("id").alias("component_id"), F.min("row").alias("row"))
    named, _ = settle(roots.select("fp", "root").join(least, "root"))
    return rows, named


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """Rows (id, fingerprint as 16 hexadecimal digits, component_id), one per row of the table.

    Rows are linked if their fingerprints differ in at most ``distance`` bits; component_id is the smallest id that
    links reach, the row's own included. Texts without words, null ones too, have fingerprint zero and are linked like
    others. A null id is never the smallest; a component of null ids has a null component_id. Repeated rows stay. An
    empty table gives an empty result.
    """
    rows, named = grouped(docs, id_col, text_col, shingle, distance)
    found = rows.select("id", "fp").join(named.select("fp", "component_id"), "fp")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row of each component, the one with the smallest id (then by a hash of the text), with its columns."""
    rows, named = grouped(docs, id_col, text_col, shingle, distance)
    stay = named.select("root", "row").distinct().withColumns({"s1": F.col("row.r1"), "s2": F.col("row.r2")})
    same = rows.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n"))
    on = (F.col("s1") == F.col("r1")) & (F.col("s2") == F.col("r2"))
    stay, _ = settle(stay.join(same, on).select("s1", "s2", "n"))
    r1, r2, n = (free_name(docs, x) for x in ("r1", "r2", "n"))
    keyed = docs.select("*", *[c.alias(x) for c, x in zip(repeats.row_key(id_col, text_col), (r1, r2), strict=True)])
    stay = stay.withColumnsRenamed({"s1": f"{r1}_stays", "s2": f"{r2}_stays", "n": f"{n}_stays"})
    met = keyed.join(stay, (F.col(r1) == F.col(f"{r1}_stays")) & (F.col(r2) == F.col(f"{r2}_stays")))
    once = met.filter(F.col(f"{n}_stays") == 1)
    several = met.filter(F.col(f"{n}_stays") > 1).dropDuplicates([r1, r2])
    return once.unionByName(several).select(*[f"`{c}`" for c in docs.columns])
