"""Places in a whole order, without one task that sees all rows.

The rows are range-partitioned and sorted once and written with a number whose upper
bits are the range and whose lower bits count within it.  One row per range, its count,
then turns these numbers into places in the whole order.  The written table keeps ranges
and numbers what they are, whatever is read again later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesforge.scratch import Scratch

#: ``monotonically_increasing_id`` has the partition above these bits, the row in them.
ROW_BITS = 33


def in_order(df: DataFrame, order: list[Column], scratch: Scratch, *, number: str = "number",
             range_col: str = "range", ranges: int | None = None, label: str = "ordered") -> DataFrame:
    """The rows as a written table, sorted, with their range (ascending in the order) and
    their number in it (from 0).  Rows alike in all of ``order`` are told apart by a random
    salt, so that a value that many rows share is spread over ranges; ``ranges`` is
    Spark's number of shuffle partitions where not given."""
    keys = [*order, F.rand(11)]
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *keys).sortWithinPartitions(*order)
    found = dealt.withColumn(number, F.monotonically_increasing_id())
    low = (1 << ROW_BITS) - 1
    return scratch.table(found.select(*df.columns, F.shiftright(F.col(number), ROW_BITS).cast("int").alias(range_col),
                                      F.col(number).bitwiseAND(F.lit(low)).alias(number)), label)


def range_totals(ordered: DataFrame, range_col: str = "range", **sums: Column) -> DataFrame:
    """One row per range: ``before``, the number of rows in earlier ranges, and the
    running totals of ``sums`` before the range."""
    held = ordered.groupBy(range_col).agg(F.count(F.lit(1)).alias("before"), *[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.orderBy(range_col).rowsBetween(Window.unboundedPreceding, -1)
    return held.select(range_col, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in ("before", *sums)])


def with_places(df: DataFrame, order: list[Column], scratch: Scratch, place: str = "place",
                ranges: int | None = None) -> DataFrame:
    """All rows with their place (from 0) in the whole order; ties in any order."""
    cols = df.columns
    ordered = in_order(df, order, scratch, number="_number", range_col="_range", ranges=ranges)
    # One row per range of the shuffle, whose number is a setting.
    totals = range_totals(ordered, "_range")
    return ordered.join(F.broadcast(totals), "_range").select(
        *[F.col(f"`{c}`") for c in cols], (F.col("before") + F.col("_number")).alias(place))
