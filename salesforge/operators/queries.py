"""QRY1-QRY4: the four read shapes served over the stored sales table.

A sale's ``date`` may carry a time of day; the shapes work by calendar day, and an end
date includes that whole day.  Bounds are plain comparisons of the stored column, so they
reach the Parquet/JDBC scan as pushed filters; ordering with a limit plans as
``TakeOrderedAndProject``.  An offset keeps ``offset + limit`` rows per partition: for
deep pages pass ``after``, the last row of the page before, which is a plain filter, or
build a ``PageIndex``, which reads only the rows of the page.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from salesforge.functions.ordered import in_order, range_totals
from salesforge.functions.schema import SALES_COLUMNS
from salesforge.functions.semantics import ts_lit
from salesforge.scratch import Scratch


def _has_time(value: date | datetime | str) -> bool:
    """Whether a bound names a moment rather than a day."""
    return isinstance(value, datetime) or isinstance(value, str) and len(value.strip()) > len("YYYY-MM-DD")


def _next_day(value: date | str) -> date:
    return (date.fromisoformat(value.strip()) if isinstance(value, str) else value) + timedelta(days=1)


def _date_range(df: DataFrame, start_date: date | datetime | str | None,
                end_date: date | datetime | str | None) -> DataFrame:
    kind = df.schema["date"].dataType
    if start_date is not None:
        df = df.where(F.col("date") >= ts_lit(start_date).cast(kind))
    if end_date is not None and _has_time(end_date):
        df = df.where(F.col("date") <= ts_lit(end_date).cast(kind))
    elif end_date is not None:
        df = df.where(F.col("date") < ts_lit(_next_day(end_date)).cast(kind))
    return df


def _after(df: DataFrame, last: Row | dict, keys: list[str]) -> Column:
    """Rows that come after ``last`` in the page order (date falling, then the other keys
    rising, null last)."""
    last = last.asDict() if isinstance(last, Row) else last
    out, same = F.lit(False), F.lit(True)
    for k in keys:
        c, v = F.col(k), last[k]
        v = ts_lit(v).cast(df.schema[k].dataType) if k == "date" and v is not None else F.lit(v).cast(df.schema[k].dataType)
        later = (c < v) if k == "date" else (c > v)
        out = out | (same & F.when(v.isNull(), F.lit(False)).otherwise(c.isNull() | later))
        same = same & c.eqNullSafe(v)
    return out


def _page_order(df: DataFrame) -> list[Column]:
    names = [c for c in SALES_COLUMNS if c != "date" and c in df.columns]
    return [F.col("date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in names]]


def sales_page(df: DataFrame, start_date=None, end_date=None, product_id: str | None = None,
               limit: int = 100, offset: int = 0, after: Row | dict | None = None) -> DataFrame:
    """QRY1: filtered rows, newest first, one page.  Remaining columns break date ties
    so pages are deterministic (the reference leaves tie order to the database).  ``after``
    continues behind a row; rows equal to it in all columns are skipped with it."""
    df = _date_range(df, start_date, end_date)
    if product_id is not None:
        df = df.where(F.col("product_id") == F.lit(product_id))
    names = ["date", *[c for c in SALES_COLUMNS if c != "date" and c in df.columns]]
    if after is not None:
        df = df.where(_after(df, after, names))
    return df.orderBy(*_page_order(df)).offset(offset).limit(limit)


class PageIndex:
    """QRY1 at any depth: the rows in page order, in ranges with known row counts.

    ``build`` sorts the table once over ranges (newest first, ties as in ``sales_page``)
    and writes it, a folder per range, each row with its number in the range, besides one
    row per range with the number of rows before it.  A page then names the ranges it lies
    in (mostly one) and the numbers in them: it reads those folders only, and from them the
    row groups that hold the numbers.  Nothing is sorted or skipped, however large the
    offset.  The index is as old as its build."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, df: DataFrame, path: str, ranges: int | None = None) -> PageIndex:
        scratch = Scratch(df.sparkSession)
        placed = in_order(df, _page_order(df), scratch, number="_number", range_col="_range", ranges=ranges, label="pages")
        # A task holds neighbouring ranges whole and in order, as the sort has left them.
        placed.repartitionByRange("_range", "_number").sortWithinPartitions("_range", "_number").write.mode("overwrite") \
            .partitionBy("_range").parquet(f"{path}/rows")
        range_totals(placed, "_range").join(placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")), "_range") \
            .write.mode("overwrite").parquet(f"{path}/ranges")
        scratch.release()
        return cls(df.sparkSession, path)

    def page(self, limit: int = 100, offset: int = 0) -> DataFrame:
        """``limit`` rows from ``offset`` on, in page order."""
        held = self.spark.read.parquet(f"{self.path}/ranges")
        hit = held.where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)).collect()
        rows = self.spark.read.parquet(f"{self.path}/rows")
        wanted = [(F.col("_range") == r["_range"]) & (F.col("_number") >= offset - r["before"]) & (F.col("_number") < offset + limit - r["before"])
                  for r in hit]
        rows = rows.where(reduce(Column.__or__, wanted, F.lit(False)))
        return rows.orderBy("_range", "_number").limit(limit).drop("_range", "_number")


def sales_summary(df: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """QRY2: one-row summary of the (optionally date-bounded) table; ``unique_dates``
    counts days."""
    df = _date_range(df, start_date, end_date)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_sales").alias("total_revenue"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.countDistinct("product_id").alias("unique_products"),
        F.countDistinct(F.to_date("date")).alias("unique_dates"),
    )


def sales_by_product(df: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """QRY3: per-product totals, highest revenue first (NULL product is its own group,
    as in SQL)."""
    df = _date_range(df, start_date, end_date)
    return (df.groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.sum("quantity").alias("total_quantity"),
                 F.sum("total_sales").alias("total_revenue"),
                 F.avg("unit_price").alias("avg_unit_price"),
                 F.avg("discount").alias("avg_discount"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product_id")))


def sales_by_date(df: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """QRY4: per-day totals, newest first; ``date`` is the day at midnight, in the
    column's own type."""
    df = _date_range(df, start_date, end_date)
    day = F.to_date("date").cast(df.schema["date"].dataType).alias("date")
    return (df.groupBy(day)
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.sum("quantity").alias("total_quantity"),
                 F.sum("total_sales").alias("total_revenue"),
                 F.avg("unit_price").alias("avg_unit_price"),
                 F.countDistinct("product_id").alias("unique_products"))
            .orderBy(F.col("date").desc_nulls_last()))
