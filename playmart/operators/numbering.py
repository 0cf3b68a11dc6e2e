"""Gapless numbers over a distributed order, and frames put side by side by them.

Rows are range-partitioned and sorted by the order, and written once so that every row keeps its place. The
rows of each partition are counted; the sum of the counts before it is the partition's offset. No task sees
more than one range, and the driver at most one count per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.shared import saved

_PLACE_BITS = 33  # monotonically_increasing_id: the partition above, the row in it below


def numbered(
    df: DataFrame, order_by: Sequence[str], within: Sequence[str] = (), name: str = "number", start: int = 1
) -> DataFrame:
    """df with numbers start, start + 1, ... by order_by (NULLs first), in all or within groups of columns.

    Rows that tie in order_by get numbers in any order and share a range, so the order should settle most ties.
    A group may hold any share of the rows. No rows give no numbers; names of df are not touched.
    """
    spark = df.sparkSession
    row, keys = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), [*within, *order_by]
    order = [F.col(f"row.`{c}`") for c in keys]
    spread = df.select(row).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(spread.select("row", F.monotonically_increasing_id().alias("place")))
    placed = placed.withColumn("part", F.shiftright("place", _PLACE_BITS))
    groups = [F.col(f"row.`{c}`").alias(f"g{k}") for k, c in enumerate(within)]
    counts = placed.groupBy("part", *groups).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    if within:
        names = [f"g{k}" for k in range(len(within))]
        earlier = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ahead = saved(counts.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
        ahead = ahead.select(F.col("part").alias("p"), *names, "first", "ahead")
        same = F.col("part") == F.col("p")
        for k, c in enumerate(within):
            same = same & F.col(f"row.`{c}`").eqNullSafe(F.col(f"g{k}"))
        joined = placed.join(ahead, same)
    else:
        rows, total = [], 0
        for r in sorted(counts.select("part", "n", "first").collect()):  # one row per partition
            rows.append((r.part, r.first, total))
            total += r.n
        ahead = spark.createDataFrame(rows, "part bigint, first bigint, ahead bigint")
        joined = placed.join(F.broadcast(ahead), "part")
    number = F.col("place") - F.col("first") + F.col("ahead") + F.lit(start)
    return joined.select("row.*", number.cast("bigint").alias(name))


def continued(
    df: DataFrame, stored: DataFrame, order_by: Sequence[str], name: str = "number", start: int = 1
) -> DataFrame:
    """New rows numbered on from the largest number stored; from start if nothing is stored."""
    last = stored.agg(F.max(name)).first()[0]
    return numbered(df, order_by, name=name, start=start if last is None else last + 1)


def side_by_side(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], name: str = "position"
) -> DataFrame:
    """The n-th row of left beside the n-th row of right, with the position from 0.

    Where one frame is longer, the columns of the other are NULL. The two may be partitioned in any way.
    """
    twice = set(left.columns) & set(right.columns)
    if twice:
        raise ValueError(f"columns on both sides: {sorted(twice)}")
    a = numbered(left, left_order, name=name, start=0)
    b = numbered(right, right_order, name=name, start=0)
    return a.join(b, name, "full").select(name, *left.columns, *right.columns)
