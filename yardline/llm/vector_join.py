"""Near-duplicate vectors: all pairs within an angle, by an exact metric range join.

Vectors belong to the cell of their nearest pivot. By the triangle inequality a vector has no partner in another cell if it is
farther from that cell's pivot than the cell's radius and the range together, or farther than the range from the border
between the two pivots; and it has all of the cell's vectors as partners if distance and radius together are within the
range, which settles tight groups without comparing their members. What is left is replicated: the vector goes as a
guest to the cell, once per pair of cells, and each cell counts the links between its guests and its own by itself.

A cell's own vectors come in blocks of bounded size, which a task holds while guests stream past. Links are counted, not
listed; to the components go a spanning forest of each block, and one node per cell whose vectors are all partners
of somebody. Equal vectors are one node with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.llm.common import lookup, settle, shuffled
from yardline.llm.components import components

COSINE = 0.95
CELL = 1024  # vectors of a cell, on average
BLOCK = 4096  # vectors of a cell that a task holds
PIVOT_BYTES = 1 << 24  # pivots that go to every task
PIECE = 1024  # vectors that meet a block at once
PRODUCTS = 1 << 22  # products that are held at once
SLACK = 1e-6  # of bounds on angles and distances; what is closer gets compared


@dataclass
class Cells:
    """Pivots of vectors of one length, and what is known of their cells once all vectors have one."""

    first: int  # number of the first cell
    pivots: np.ndarray
    radius: np.ndarray | None = None
    weight: np.ndarray | None = None  # vectors, copies included
    blocks: np.ndarray | None = None

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot and the cosines with all of them."""
        cosine = x @ self.pivots.T
        return cosine.argmax(axis=1), cosine

    def reach(self, x: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own cell, cells whose vectors are all partners, cells in which there may be some)."""
        own, cosine = self.nearest(x)
        theta = np.arccos(np.clip(cosine, -1, 1))
        here = self.radius >= 0
        whole = (theta + self.radius < angle - SLACK) & here
        far = theta - self.radius > angle + SLACK
        some, which = np.unique(own, return_inverse=True)
        between = np.sqrt(np.maximum(2 - 2 * self.pivots[some] @ self.pivots.T, 0))[which]
        edge = cosine[np.arange(len(x)), own][:, None] - cosine
        far |= edge > (2 * math.sin(angle / 2) + SLACK) * np.maximum(between, SLACK)
        return own, whole, ~far & ~whole & here


def unit(values: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = values.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch whose vectors have the same length, with these."""
    length = pc.list_value_length(batch.column("vector"))
    for n in pc.unique(length).to_pylist():
        part = batch.filter(pc.equal(length, n))
        vectors = part.column("vector")
        yield part, vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: numbers only, all finite, not all zero."""
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def in_pieces(rows: int, cells: int) -> Iterator[slice]:
    step = max(1, PRODUCTS // max(cells, 1))
    for i in range(0, rows, step):
        yield slice(i, i + step)


def choose_pivots(nodes: DataFrame, cell: int) -> dict[int, Cells]:
    """Pivots per length of vector: those with small hashes, about one per ``cell`` vectors, up to about PIVOT_BYTES in all."""
    out, first = {}, 0
    for r in nodes.groupBy("length").count().orderBy("length").collect():
        most = max(1, min(math.ceil(r["count"] / cell), PIVOT_BYTES // (8 * r["length"])))
        own = nodes.filter(F.col("length") == r["length"]).select("vector")
        place = F.pmod(F.xxhash64("vector", F.lit(7)), F.lit(1 << 30))
        chosen = own.filter(place < math.ceil(most / r["count"] * (1 << 30))).collect() or own.limit(1).collect()
        pivots = unit(np.array([x["vector"] for x in chosen]))
        out[r["length"]] = Cells(first, pivots)
        first += len(pivots)
    return out


def assigned(nodes: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """Add every node's cell and its angle to the pivot (settled)."""
    shared = nodes.sparkSession.sparkContext.broadcast(cells)
    schema = T.StructType([*nodes.schema.fields, T.StructField("cell", T.LongType()), T.StructField("angle", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, vectors in by_length(batch):
                own = shared.value[vectors.shape[1]]
                for piece in in_pieces(len(vectors), len(own.pivots)):
                    at, cosine = own.nearest(unit(vectors[piece]))
                    angle = np.arccos(np.clip(cosine[np.arange(len(at)), at], -1, 1))
                    rows = part.slice(piece.start, len(at))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(at + own.first), pa.array(angle)], [*rows.schema.names, "cell", "angle"])

    return settle(nodes.mapInArrow(run, schema))[0]


def measure(placed: DataFrame, cells: dict[int, Cells], block: int) -> None:
    """Fill in radius, weight and number of blocks of the cells: one row per pivot."""
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.sum("n").alias("weight"), F.count(F.lit(1)).alias("nodes")).collect()}
    for own in cells.values():
        rows = [stats.get(own.first + i) for i in range(len(own.pivots))]
        own.radius = np.array([r["radius"] if r else -1.0 for r in rows])
        own.weight = np.array([r["weight"] if r else 0 for r in rows], np.int64)
        own.blocks = np.array([-(-r["nodes"] // block) if r else 0 for r in rows], np.int64)


def hosts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two cells, whether the second takes the other's vectors as guests (either way for half of all pairs)."""
    return ((a + b) % 2 == 0) ^ (a < b)


def forest(node: np.ndarray, row: np.ndarray, cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a node and a cell that connect what (row, cell) do, one per node and cell at most; ordered by row."""
    root, a, b = list(range(cells)), [], []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    before, base = -1, 0
    for r, x in zip(row.tolist(), cell.tolist(), strict=True):
        if r != before:
            before, base = r, x
        elif top(x) == top(base):
            continue
        else:
            root[top(x)] = top(base)
        a.append(node[r])
        b.append(x)
    return np.array(a, np.int64), np.array(b, np.int64)


FACTS = "a long, b long, n long"


def settled_by_bounds(placed: DataFrame, cells: dict[int, Cells], angle: float) -> DataFrame:
    """Links that need no comparison, as facts: (node, null, n) links of a node; (cell, null, n) for each of its vectors; (node,
    cell, null) all of the cell's vectors are partners. Cells are -1 - their number."""
    shared = placed.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, vectors in by_length(batch):
                c = shared.value[vectors.shape[1]]
                nodes, weights = part.column("node").to_numpy(), part.column("n").to_numpy()
                for piece in in_pieces(len(vectors), len(c.pivots)):
                    own, whole, _ = c.reach(unit(vectors[piece]), angle)
                    node, n = nodes[piece], weights[piece]
                    row, cell = np.nonzero(whole)
                    if not len(row):
                        continue
                    same, host = own[row] == cell, hosts(own[row], cell)
                    counted = same | host
                    links = np.bincount(row, np.where(counted, c.weight[cell] - np.where(same, n[row], 0), 0), len(node)).astype(np.int64)
                    back = np.bincount(cell, np.where(host & ~same, n[row], 0), len(c.pivots)).astype(np.int64)
                    a, b = forest(node, row[counted], cell[counted], len(c.pivots))
                    b = -1 - c.first - b
                    given, to = np.flatnonzero(links), np.flatnonzero(back)
                    one = np.concatenate((node[given], -1 - c.first - to, a))
                    two = np.concatenate((np.zeros(len(given) + len(to), np.int64), b))
                    many = np.concatenate((links[given], back[to], np.zeros(len(a), np.int64)))
                    edge = np.arange(len(one)) >= len(given) + len(to)
                    yield pa.record_batch([pa.array(one), pa.array(two, mask=~edge), pa.array(many, mask=edge)], names=["a", "b", "n"])

    return placed.mapInArrow(run, FACTS)


def dealt(placed: DataFrame, cells: dict[int, Cells], angle: float) -> DataFrame:
    """Rows for the blocks: (cell, block, guest, own, node, n, vector). A vector is host in one block of its cell (``own`` if it
    has to ask the others there), and a guest where it may have partners."""
    shared = placed.sparkSession.sparkContext.broadcast(cells)
    kind = placed.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, vectors in by_length(batch):
                c = shared.value[vectors.shape[1]]
                nodes = part.column("node").to_numpy()
                for piece in in_pieces(len(vectors), len(c.pivots)):
                    own, whole, maybe = c.reach(unit(vectors[piece]), angle)
                    node, here = nodes[piece], np.arange(len(own))
                    home = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % c.blocks[own]
                    asks = ~whole[here, own]
                    row, cell = np.nonzero(maybe & (hosts(own[:, None], np.arange(len(c.pivots))[None, :]) | (own[:, None] == np.arange(len(c.pivots)))))
                    copies = c.blocks[cell]
                    row, cell = np.repeat(row, copies), np.repeat(cell, copies)
                    block = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                    same = cell == own[row]
                    going = ~(same & (block == home[row]))  # there it is a host
                    row, cell, block, same = row[going], cell[going], block[going], same[going]
                    rows = np.concatenate((here, row))
                    columns = [
                        pa.array(np.concatenate((own, cell)) + c.first),
                        pa.array(np.concatenate((home, block))),
                        pa.array(np.arange(len(rows)) >= len(here)),
                        pa.array(np.concatenate((asks, same))),
                    ]
                    for i in range(0, len(rows), 8192):
                        at = pa.array(rows[i : i + 8192] + piece.start)
                        yield pa.RecordBatch.from_arrays([*(x.slice(i, 8192) for x in columns), *(part.column(k).take(at) for k in ("node", "n", "vector"))], ["cell", "block", "guest", "own", "node", "n", "vector"])

    return placed.mapInArrow(run, f"cell long, block long, guest boolean, own boolean, node long, n long, vector {kind}")


class Block:
    """A block of a cell's vectors, and the links found so far."""

    def __init__(self, cosine: float) -> None:
        self.cosine = cosine
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.x: np.ndarray | None = None

    def host(self, x: np.ndarray, node: np.ndarray, n: np.ndarray, asks: np.ndarray) -> None:
        self.parts.append((x, node, n, asks))

    def closed(self) -> bool:
        """Whether the block has vectors, which from now on are complete."""
        if self.parts:
            self.close()
        return self.x is not None

    def close(self) -> None:
        """All of the block is there: link those of its vectors that ask."""
        self.x, self.node, self.n, asks = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        self.short, self.parts = np.ascontiguousarray(self.x.astype(np.float32).T), []
        self.margin = 1e-5 + 3e-7 * self.x.shape[1]  # more than products of floats are off
        self.links = np.zeros(len(self.node), np.int64)
        self.label = np.arange(len(self.node))
        ask = np.flatnonzero(asks)
        for i in range(0, len(ask), PIECE):
            at = ask[i : i + PIECE]
            met = self.met(self.x[at])
            if met is not None:
                met[np.arange(len(at)), at] = False
                self.links[at] += met @ self.n
                for r in np.flatnonzero(met.any(axis=1)).tolist():
                    self.join(np.append(np.flatnonzero(met[r]), at[r]))

    def met(self, x: np.ndarray) -> np.ndarray | None:
        """Which vectors of the block are partners; doubles decide where floats don't. None without any."""
        rough = x.astype(np.float32) @ self.short
        found = rough >= np.float32(self.cosine - self.margin)
        if not found.any():
            return None
        a, b = np.nonzero(found & (rough <= np.float32(self.cosine + self.margin)))
        for i in range(0, len(a), 1 << 14):
            p, q = a[i : i + (1 << 14)], b[i : i + (1 << 14)]
            found[p, q] = (x[p] * self.x[q]).sum(axis=1) >= self.cosine
        return found

    def join(self, at: np.ndarray) -> None:
        labels = self.label[at]
        least = labels.min()
        if (labels != least).any():
            flag = np.zeros(len(self.label), bool)
            flag[labels] = True
            self.label[flag[self.label]] = least

    def guests(self, x: np.ndarray, node: np.ndarray, n: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Guests with partners: their nodes, a partner, and how many."""
        met = self.met(x)
        if met is None:
            return node[:0], node[:0], n[:0]
        self.links += (n * ~own) @ met  # vectors of the same cell ask for themselves
        count = met @ self.n
        some = np.flatnonzero(count)
        for i in some.tolist():
            self.join(np.flatnonzero(met[i]))
        return node[some], self.node[met[some].argmax(axis=1)], count[some]

    def end(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's own: nodes, another node that links lead to (or the node itself), and links."""
        some = np.flatnonzero((self.links > 0) | (self.label != np.arange(len(self.label))))
        return self.node[some], self.node[self.label[some]], self.links[some]


def compared(rows: DataFrame, cosine: float) -> DataFrame:
    """Links of the blocks as facts (node, another node or itself, n)."""

    def out(found: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        if len(found[0]):
            yield pa.record_batch([pa.array(v) for v in found], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key = None, None
        for batch in batches:
            cell, number, guest = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "block", "guest"))
            fresh = np.flatnonzero((cell[1:] != cell[:-1]) | (number[1:] != number[:-1]) | (guest[1:] != guest[:-1])) + 1
            edges = [0, *fresh.tolist(), len(cell)] if len(cell) else []
            for i, j in zip(edges, edges[1:], strict=False):
                if key != (cell[i], number[i]):
                    if block is not None and block.closed():
                        yield from out(block.end())
                    block, key = Block(cosine), (cell[i], number[i])
                part = batch.slice(i, j - i)
                x = unit(part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(j - i, -1))
                node, n, own = (part.column(k).to_numpy(zero_copy_only=False) for k in ("node", "n", "own"))
                if not guest[i]:
                    block.host(x, node, n, own)
                elif block.closed():
                    for p in range(0, len(x), PIECE):
                        q = slice(p, p + PIECE)
                        yield from out(block.guests(x[q], node[q], n[q], own[q]))
        if block is not None and block.closed():
            yield from out(block.end())

    sorted_rows = rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "guest")
    return sorted_rows.mapInArrow(run, FACTS)


def linked(vectors: DataFrame, cosine: float, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """Rows (vector, n, n_links, component, id): per distinct vector its rows, the rows linked to one of them, its component and
    the smallest id there. From rows (id, vector)."""
    nodes = vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    nodes, _ = settle(nodes.select(F.monotonically_increasing_id().alias("node"), "id", "n", F.size("vector").alias("length"), "vector"))
    angle = math.acos(cosine)
    cells = choose_pivots(nodes, cell)
    placed = assigned(nodes.select("node", "n", "vector"), cells)
    measure(placed, cells, block)
    facts, _ = settle(settled_by_bounds(placed, cells, angle).unionByName(compared(dealt(placed, cells, angle), cosine)))
    counts = facts.filter(F.col("n").isNotNull()).groupBy("a").agg(F.sum("n").alias("n_links")).filter("n_links > 0")
    counts, _ = settle(counts)
    held = placed.select("node", (-1 - F.col("cell")).alias("cell"))
    # vectors of a cell that has a node as partner of them all belong together
    active = facts.filter("b < 0").select(F.col("b").alias("a")).distinct()
    active, _ = settle(active)
    bound = lookup(held, active.withColumnRenamed("a", "cell"), ["cell"], "inner").select(F.col("node").alias("a"), F.col("cell").alias("b"))
    edges = facts.filter(F.col("b").isNotNull()).select("a", "b").unionByName(bound)
    roots, _ = settle(components(edges))
    out = lookup(nodes, roots.withColumnRenamed("root", "component"), ["node"])
    out = out.withColumn("component", F.coalesce("component", "node"))
    least, _ = settle(out.groupBy("component").agg(F.min("id").alias("least")))
    out = lookup(out, least, ["component"])
    per_cell = counts.filter("a < 0").select(F.col("a").alias("cell"), F.col("n_links").alias("each"))
    out = out.join(held, "node")
    out = lookup(out, per_cell, ["cell"])
    out = lookup(out, counts.filter("a >= 0").withColumnRenamed("a", "node"), ["node"])
    n_links = F.coalesce("n_links", F.lit(0)) + F.coalesce("each", F.lit(0)) + F.col("n") - 1
    return settle(out.select("vector", "n", n_links.alias("n_links"), "component", F.col("least").alias("id")))[0]


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, cosine: float = COSINE, cell: int = CELL, block: int = BLOCK
) -> DataFrame:
    """One row per row: (id, n_links, component_id, kept).

    Vectors are linked if their cosine, in double precision, is ``cosine`` or more. n_links counts the other rows linked
    directly, copies included; component_id is the smallest id that links reach, the row's own included; kept is whether
    that is the row's id. Vectors that are null or empty, hold a null or a number that isn't finite, or are all zero have no
    links, nor have vectors of different lengths. A null id is never the smallest: where all are null, so is
    component_id, and such rows aren't kept. Repeated rows are rows of their own, linked to each other. Other columns
    don't matter; an empty table gives an empty result.
    """
    kind = rows.schema[vector_col].dataType
    vector = F.col(f"`{vector_col}`")
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType | T.DoubleType)):
        vector = vector.cast("array<double>")
    rows = rows.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector")).withColumn("good", usable(F.col("vector")))
    alone = rows.filter(~F.col("good")).select(F.col("id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    good = rows.filter("good").select("id", "vector")
    found = linked(good, cosine, cell, block).select("vector", "n_links", F.col("id").alias("component_id"))
    out = good.join(shuffled(found), "vector").select("id", "n_links", "component_id").unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
