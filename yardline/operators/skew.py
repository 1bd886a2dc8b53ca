"""Group sizes, and row positions for groups too large for one task.

A window by entity puts each entity in one task. That is right while the largest entity fits, and it is
the cheapest plan (one shuffle). When one entity, or a window without keys, holds more rows than a task
should take, its rows are spread with a range exchange over (keys, order) and numbered from the
partition they landed in; every later step then works on (keys, chunk of positions).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.session import settle

# Rows of one group that a task may take, whatever the size of the table.
GROUP_FLOOR = 1_000_000
# Rows of a lookup table that may be broadcast; a larger one is joined as Spark sees fit.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class GroupSizes:
    total: int
    largest: int  # an upper bound when the total alone already fits
    limit: int

    @property
    def fits(self) -> bool:
        return self.largest <= self.limit


def group_sizes(
    df: DataFrame, keys: Sequence[str], floor: int | None = None, exact_from: float | None = None
) -> GroupSizes:
    """Measure groups. The total is counted first, which is free on a Parquet scan (settle other plans before);
    groups are only counted when the total exceeds the limit (or ``exact_from``)."""
    floor = GROUP_FLOOR if floor is None else floor
    threshold = floor if exact_from is None else min(floor, exact_from)
    if keys and threshold < floor:
        row = _counted(df, keys).agg(F.sum("_n").alias("total"), F.max("_n").alias("largest")).first()
        total, largest = row["total"] or 0, row["largest"] or 0
        return GroupSizes(total, largest, floor)
    total = df.count()
    if total <= floor or not keys:
        return GroupSizes(total, total, floor)
    largest = _counted(df, keys).agg(F.max("_n")).first()[0] or 0
    return GroupSizes(total, largest, floor)


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on keys in which null equals null, as in a group-by."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys with null equal to null, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def ordering(order: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.col(o).desc() if descending else F.col(o).asc() for o in order]


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "_pos",
    *,
    descending: bool = False,
    floor: int | None = None,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 in the given order, however large a group is."""
    sizes = sizes or group_sizes(df, keys, floor)
    spec = Window.partitionBy(*keys).orderBy(*ordering(order, descending))
    if sizes.fits:
        return df.withColumn(name, F.row_number().over(spec).cast("long"))
    if not keys:
        return _spread_positions(df, keys, order, name, descending, sizes.total, sizes.limit)
    large = settle(_counted(df, keys).filter(F.col("_n") > sizes.limit))
    groups, rows = large.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not groups:  # ``sizes`` may have been measured before a filter
        return df.withColumn(name, F.row_number().over(spec).cast("long"))
    large = large.drop("_n")
    if groups <= BROADCAST_ROWS:
        large = F.broadcast(large)
    hot = df.join(large, same_keys(df, large, keys), "left_semi")
    cold = df.join(large, same_keys(df, large, keys), "left_anti")
    cold = cold.withColumn(name, F.row_number().over(spec).cast("long"))
    return cold.unionByName(_spread_positions(hot, keys, order, name, descending, rows, sizes.limit))


def _spread_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, descending: bool, rows: int, limit: int
) -> DataFrame:
    """Positions from a range exchange: rows before this block + place inside the block.

    Range bounds come from a sample, so the numbered rows are written once: block sizes and rows are read
    from the same files even when a lost executor forces tasks to run again.
    """
    by = [F.col(k).asc() for k in keys] + ordering(order, descending)
    parts = max(2, math.ceil(rows / limit))
    numbered = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    numbered = numbered.withColumn("_row", F.monotonically_increasing_id())
    pinned = settle(numbered).withColumn("_block", F.shiftright("_row", 33))
    spans = pinned.groupBy(*keys, "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *keys, "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # one row per block and group in it: at most a row per block more than there are large groups
    if 2 * parts <= BROADCAST_ROWS:
        spans = F.broadcast(spans)
    placed = join_on(pinned, spans, [*keys, "_block"])
    return placed.withColumn(name, F.col("_before") + F.col("_row") - F.col("_first") + 1).drop(
        "_row", "_block", "_first", "_before"
    )
