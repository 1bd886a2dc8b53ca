"""Merkle manifest of a dataset: a hash tree per run of rows, one over the runs' roots, and a proof for every row.

The nodes of a run form a log in postorder: a node is written when its subtree is complete. A level pairs neighbours, and a
node without a neighbour becomes the hash of itself alone. The subtrees that are complete before leaf ``n`` hold
``2 n - popcount(n)`` nodes, and the nodes that end at one leaf follow each other from the lowest to the highest. So the
place of any node in the log is a closed form of its level, its number and the size of the run (``position``).

Builders are aligned: each takes 2 ** ``LEVELS`` leaves whose subtree is a contiguous part of the log, and writes that part
in one piece. What the builders' top nodes become is the same job with 2 ** ``LEVELS`` times fewer leaves. A proof reads
the siblings' places from the part of the log that holds the row, and the rest once a builder.

Nulls: a null in a leaf's column is written ``-``; rows with a null run are a run of their own, the first. Equal rows
are leaves of their own, next to each other. Empty tables give an empty log and no proofs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from yardline.llm.common import lookup, numbered, settle

LEVELS = 10  # levels above the leaves that a builder completes


def position(level: int, index: int, size: int) -> int:
    """Place of a node in the log of a run with ``size`` leaves."""
    last = min((index + 1) << level, size) - 1
    return 2 * last - last.bit_count() + level


def width(level: int, size: int) -> int:
    """Nodes of a level."""
    return -(-size >> level) if size else 0


def node(*children: bytes) -> bytes:
    """A node's digest: that of the digests below it as hexadecimal text."""
    return sha256("".join([c.hex() for c in children]).encode()).digest()


def leaf_text(*values: Column) -> Column:
    """What a leaf hashes: each value as its length in bytes, a colon and the value; ``-`` for null."""
    parts = []
    for v in values:
        v = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.concat(*parts)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def subtree(leaves: Sequence[bytes], levels: int) -> list[list[bytes]]:
    """All levels of the subtree of a builder, from its leaves up; one node is left after ``levels``, or earlier."""
    found = [list(leaves)]
    for _ in range(levels):
        below = found[-1]
        found.append([node(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def siblings(index: int, levels: int, size: int, at: Callable[[int], bytes]) -> list[bytes]:
    """Digests beside the path of a leaf over ``levels`` levels, from the log (``at`` gives the node at a place);
    empty where there is none."""
    out = []
    for h in range(levels):
        beside = (index >> h) ^ 1
        out.append(at(position(h, beside, size)) if beside < width(h, size) else b"")
    return out


def folded(leaf: bytes, index: int, beside: Sequence[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    for h, other in enumerate(beside):
        if not other:
            leaf = node(leaf)
        elif index >> h & 1:
            leaf = node(other, leaf)
        else:
            leaf = node(leaf, other)
    return leaf


def height(size: int, levels: int) -> int:
    """Levels that a builder of a run completes: all of a run that it holds alone."""
    return min(levels, max(size - 1, 0).bit_length())


@dataclass
class Part:
    """A builder's part of the log, which starts at its first leaf."""

    nodes: bytes
    first: int  # place of the first node
    size: int

    def __call__(self, at: int) -> bytes:
        return self.nodes[32 * (at - self.first) : 32 * (at - self.first + 1)]


def built(leaves: DataFrame, levels: int) -> DataFrame:
    """Builders of a layer: rows (run, block, size, nodes, top) from leaves (run, index, size, digest)."""

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        run, block = key
        size = int(pdf["size"].iloc[0])
        pdf = pdf.sort_values("index")
        first = int(pdf["index"].iloc[0])
        tree = subtree(pdf["digest"].tolist(), height(size, levels))
        start = position(0, first, size)
        nodes = bytearray(32 * sum(len(level) for level in tree))
        for h, level in enumerate(tree):
            for i, digest in enumerate(level):
                at = 32 * (position(h, (first >> h) + i, size) - start)
                nodes[at : at + 32] = digest
        return pd.DataFrame({"run": [run], "block": [block], "size": [size], "nodes": [bytes(nodes)], "top": [tree[-1][0]]})

    keyed = leaves.select("run", F.shiftright("index", levels).alias("block"), "index", "size", "digest")
    out = keyed.groupBy("run", "block").applyInPandas(build, "run long, block long, size long, nodes binary, top binary")
    return settle(out)[0]


def above(blocks: DataFrame, levels: int) -> DataFrame:
    """What every builder needs from the layers above: rows (run, block, beside, root), with the digests beside the path of
    its top node (empty where there is none) and the root of its run."""
    alone = F.col("size") <= 1 << levels
    single = blocks.filter(alone).select("run", "block", F.array().cast("array<binary>").alias("beside"), F.col("top").alias("root"))
    many = blocks.filter(~alone)
    if many.isEmpty():
        return single
    size = F.shiftright(F.col("size") + ((1 << levels) - 1), levels)
    tops = many.select("run", F.col("block").alias("index"), size.alias("size"), F.col("top").alias("digest"))
    layer = built(tops, levels)
    return single.unionByName(paths(layer, above(layer, levels), levels).withColumnRenamed("index", "block"))


def paths(blocks: DataFrame, higher: DataFrame, levels: int) -> DataFrame:
    """Rows (run, index, beside, root) for all leaves of a layer, from its builders and what lies above them."""

    def walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in pdf.itertuples(index=False):
            first = r.block << levels
            part, up = Part(r.nodes, position(0, first, r.size), r.size), height(r.size, levels)
            for i in range(first, min(first + (1 << levels), r.size)):
                rows.append((r.run, i, [*siblings(i, up, r.size, part), *r.beside], r.root))
        return pd.DataFrame(rows, columns=["run", "index", "beside", "root"])

    met = blocks.drop("top").join(higher, ["run", "block"])
    return met.groupBy("run", "block").applyInPandas(walk, "run long, index long, beside array<binary>, root binary")


@dataclass
class Manifest:
    """``leaves``: the rows with run, index, size and digest. ``runs``: run, its value, size, subroot, the digests beside its
    path to the root, and the root. ``blocks``: the builders' parts of the log. ``higher``: what lies above them."""

    leaves: DataFrame
    runs: DataFrame
    blocks: DataFrame
    higher: DataFrame
    levels: int

    def log(self) -> DataFrame:
        """The builders' part of the log as rows (run, position, nodes): the digests from that place on, behind each other.
        Higher nodes follow from these (``built`` over the builders' last nodes)."""
        first = F.shiftleft(F.col("block"), self.levels)
        return self.blocks.select("run", (2 * first - F.bit_count(first)).alias("position"), "nodes")


def manifest(rows: DataFrame, run_col: str, order: Sequence[str], digest_col: str, *, levels: int = LEVELS) -> Manifest:
    """Trees over rows, one per value of ``run_col``, with leaves by ``order``, and one over their roots by that value, null
    first. The rows' other columns stay; ``run``, ``index``, ``size`` and ``digest`` are reserved."""
    rows, _ = settle(rows.withColumnRenamed(digest_col, "digest"))
    rows, runs = numbered(rows, [run_col], [*order, "digest"])
    runs, _ = numbered(settle(runs.withColumnRenamed("size", "leaves"))[0].withColumn("_all", F.lit(0)), ["_all"], [run_col], "run")
    runs, _ = settle(runs.drop("_all").withColumnRenamed("size", "runs"))
    leaves, _ = settle(lookup(rows, runs.select(run_col, "run"), [run_col], "inner"))
    blocks = built(leaves, levels)
    higher, _ = settle(above(blocks, levels))
    roots = higher.groupBy("run").agg(F.first("root").alias("subroot"))
    tops = runs.join(roots, "run")
    tops, _ = settle(tops)
    layer = built(tops.select(F.lit(0).cast("long").alias("run"), F.col("run").alias("index"), F.col("runs").alias("size"), F.col("subroot").alias("digest")), levels)
    over = paths(layer, above(layer, levels), levels).select(F.col("index").alias("run"), F.col("beside").alias("over"), "root")
    tops = tops.join(over, "run").select("run", run_col, F.col("leaves").alias("size"), "subroot", "over", "root")
    return Manifest(leaves, settle(tops)[0], blocks, higher, levels)


def proofs(held: Manifest, claimed: str, keep: Sequence[str]) -> DataFrame:
    """For every row: the columns ``keep``, digest, subroot, root, its siblings (array of binary from the leaf to the root,
    left out where there are none), and the root that the digest in column ``claimed`` gives with them (``folded``)."""
    levels = held.levels
    upper = held.blocks.drop("top", "size").join(held.higher.drop("root"), ["run", "block"])
    rows = held.leaves.select("run", F.shiftright("index", levels).alias("block"), "index", "size", "digest", F.col(claimed).alias("_claimed"), *keep)
    upper = lookup(upper, held.runs.select("run", "subroot", "over", "root"), ["run"], "inner").select("run", "block", "nodes", "beside", "subroot", "over", "root")
    results = T.StructType.fromDDL("digest binary, subroot binary, root binary, siblings array<binary>, folded binary")
    schema = T.StructType([*(rows.schema[k] for k in keep), *results.fields])
    like = to_arrow_schema(schema)

    def walk(docs: pa.Table, part: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return like.empty_table()
        p = part.slice(0, 1).to_pylist()[0]
        index, size = docs["index"].to_pylist(), docs["size"][0].as_py()
        nodes, up = Part(p["nodes"], position(0, p["block"] << levels, size), size), height(size, levels)
        run, over = p["run"], p["over"]
        below = [[*siblings(i, up, size, nodes), *p["beside"]] for i in index]
        back = [
            folded(folded(leaf, i, beside), run, over)
            for leaf, i, beside in zip(docs["_claimed"].to_pylist(), index, below, strict=True)
        ]
        found = [[s for s in (*beside, *over) if s] for beside in below]
        same = [pa.array([v] * len(index)) for v in (p["subroot"], p["root"])]
        columns = [*(docs[k].combine_chunks() for k in keep), docs["digest"].combine_chunks(), *same, pa.array(found, pa.list_(pa.binary())), pa.array(back)]
        return pa.Table.from_arrays([c.cast(t) for c, t in zip(columns, like.types, strict=True)], schema=like)

    return rows.groupBy("run", "block").cogroup(upper.groupBy("run", "block")).applyInArrow(walk, schema)


def joined_hex(digests: Column) -> Column:
    """Digests as hexadecimal text behind each other."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")
