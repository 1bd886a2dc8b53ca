"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from yardline.session import drop_files, settle_at

SPACE = r"[\x20\x09-\x0D]+"  # between words
SLICE = 2 << 20  # bytes of text that a task works on at once
SMALL_ROWS = 100_000  # rows of a side that may be broadcast
SALTS = 16


def settle(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """Write a table to the shared folder and go on from its files; the second value deletes them before the end."""
    kept, path = settle_at(df)
    return kept, lambda: drop_files(df.sparkSession, path)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with up to ``limit`` bytes in a column of strings or lists (one row at least)."""
    first, size = 0, 0
    values = batch.column(column)
    if pa.types.is_list(values.type):
        lengths = pc.multiply(pc.list_value_length(values), 8)
    else:
        lengths = pc.binary_length(values)
    lengths = pc.fill_null(lengths, 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > first and size + n > limit:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < len(lengths):
        yield batch.slice(first)


def per_batch(
    df: DataFrame, column: str, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType
) -> DataFrame:
    """Apply a function to parts of Arrow batches that hold a bounded amount of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = step(part)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def append_columns(
    df: DataFrame, column: str, step: Callable[[pa.RecordBatch], list[pa.Array]], results: dict[str, str], drop: Sequence[str] = ()
) -> DataFrame:
    """``per_batch`` that keeps the columns of the table (without ``drop``) and adds results after them.

    A column with the name of a result gives way to it.
    """
    gone = {n.lower() for n in (*results, *drop)}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    names = [f.name for f in kept]
    added = T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in results.items()))
    types = to_arrow_schema(added).types

    def extend(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = [c.cast(t) for c, t in zip(step(batch), types, strict=True)]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *new], [*names, *results])

    return per_batch(df, column, extend, T.StructType(kept + added.fields))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """Add result columns; a column of the input with the same name gives way."""
    names = {n.lower() for n in results}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return df.select(*kept, *[c.alias(n) for n, c in results.items()])


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: neither side is broadcast.

    Spark sizes a table by its compressed files and counts an exploded row once, so by its own choice a table many times
    the limit could go through the driver to every task.
    """
    return df.hint("merge")


def lookup(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", rows: int | None = None
) -> DataFrame:
    """Join a table that may have hot keys with one row per key (null meets null).

    ``small`` is counted (give a settled table): few rows are broadcast. Otherwise each of them is repeated once a
    salt and the rows of the big side get a salt, so a hot key spreads over tasks; these are never broadcast.
    """
    rows = small.limit(SMALL_ROWS + 1).count() if rows is None else rows
    right = small.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    if rows <= SMALL_ROWS:
        return big.join(F.broadcast(right), on, how).drop(*[f"_right_{k}" for k in keys])
    plain = [F.col(f"`{f.name}`") for f in big.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(SALTS)))
    right = right.withColumn("_right_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = salted.join(shuffled(right), on & (F.col("_salt") == F.col("_right_salt")), how)
    return joined.drop("_salt", "_right_salt", *[f"_right_{k}" for k in keys])


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "index") -> tuple[DataFrame, DataFrame]:
    """Number rows from 0 within their group, and count them: (rows with ``name`` and ``size``, groups with ``size``).

    A range exchange over group and order numbers the rows in each of its parts, however large a group is; ties go by
    their place in ``rows``, which is a settled table. Parts are written before they are counted, so that numbers and
    counts agree when a task runs again.
    """
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [*group, *order, "_tie"]
    placed, _ = settle(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_row", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_row", 33))
    spans, _ = settle(placed.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")))
    # a row per part, and one more per group that begins or ends there
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    spans = spans.select(
        *group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")
    )
    spans, _ = settle(spans)
    out = lookup(placed, spans, [*group, "_part"], "inner")
    out = out.withColumn(name, F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")
    return out, spans.groupBy(*group).agg(F.first("size").alias("size"))
