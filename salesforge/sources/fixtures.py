"""Sales views over the driver's TPC-H-style tables.

``sales`` maps one lineitem row to one sale.  ``sales_dirty`` injects deterministic
damage keyed on the order key (every row is kept; damaged copies are *added*), so the
quality and cleaning operators have real work at every scale.  ``sales_text`` is the
same rows as text, as a CSV landing would deliver them.  ``quality_history`` turns the
event stream into one quality report per day.

The SQL twins in ``salesforge.plans.oracle`` define the same views for DuckDB.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The evaluation clock and the damage moduli of the dirty view.
AS_OF = datetime(2001, 6, 30, 0, 0, 0)
QUANTITY_NULL_MOD = 97
QUANTITY_NEGATE_MOD = 101
DISCOUNT_BAD_MOD = 103
PRICE_NULL_MOD = 107
DATE_NULL_MOD = 109
TOTAL_SKEW_MOD = 113
DUPLICATE_MOD = 89
TEXT_QUANTITY_MOD = 127
TEXT_DATE_MOD = 131
TEXT_SUFFIX_MOD = 137  # '12.0d', which is no number
TEXT_US_DATE_MOD = 139  # 01/15/1998
TEXT_NAMED_DATE_MOD = 149  # 15 Jan 1998
TEXT_INFINITE_MOD = 151


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sales_cols(k: Column | None = None) -> list[Column]:
    cols = [
        F.col("l_shipdate").alias("date"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_discount").alias("discount"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("total_sales"),
    ]
    return cols + ([k] if k is not None else [])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: one sale per lineitem row."""
    return table(spark, sf_dir, "lineitem").select(*_sales_cols())


def sales_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 with a time of day (hour and minute from the order key)."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    at = F.col("l_shipdate") + F.make_dt_interval(hours=(k % 24).cast("int"), mins=(k % 60).cast("int"))
    return li.select(at.alias("date"), *_sales_cols()[1:])


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    base = li.select(*_sales_cols(k.alias("k")))
    k = F.col("k")
    out = base.select(
        F.when(k % DATE_NULL_MOD == 0, F.lit(None)).otherwise(F.col("date")).alias("date"),
        "product_id",
        F.when(k % QUANTITY_NULL_MOD == 0, F.lit(None).cast("double"))
         .when(k % QUANTITY_NEGATE_MOD == 0, -F.col("quantity"))
         .otherwise(F.col("quantity")).alias("quantity"),
        F.when(k % PRICE_NULL_MOD == 0, F.lit(None).cast("double"))
         .otherwise(F.col("unit_price")).alias("unit_price"),
        F.when(k % DISCOUNT_BAD_MOD == 0, F.lit(1.5)).otherwise(F.col("discount")).alias("discount"),
        F.when(k % TOTAL_SKEW_MOD == 0, F.col("total_sales") * F.lit(1.5))
         .otherwise(F.col("total_sales")).alias("total_sales"),
        "k",
    )
    # Exact duplicates of some rows, made in the same scan (no second read, no union).
    copies = F.when(k % DUPLICATE_MOD == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("copy", F.explode(copies)).drop("copy")


def sales_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: V1 with nulls, negative quantities, bad discounts, skewed totals, duplicates."""
    return _damaged(spark, sf_dir).drop("k")


def sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: V2 as strings, with unparseable quantities, prices and dates and other date
    forms mixed in."""
    d = _damaged(spark, sf_dir)
    k = F.col("k")
    return d.select(
        F.when(k % TEXT_DATE_MOD == 0, F.lit("invalid-date"))
         .when(k % TEXT_US_DATE_MOD == 0, F.date_format("date", "MM/dd/yyyy"))
         .when(k % TEXT_NAMED_DATE_MOD == 0, F.date_format("date", "dd MMM yyyy"))
         .otherwise(F.col("date").cast("string")).alias("date"),
        "product_id",
        F.when(k % TEXT_QUANTITY_MOD == 0, F.lit("ten"))
         .when(k % TEXT_SUFFIX_MOD == 0, F.concat(F.col("quantity").cast("string"), F.lit("d")))
         .otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.when((k % TEXT_INFINITE_MOD == 0) & F.col("unit_price").isNotNull(), F.lit("Infinity"))
         .otherwise(F.col("unit_price").cast("string")).alias("unit_price"),
        F.col("discount").cast("string").alias("discount"),
        F.col("total_sales").cast("string").alias("total_sales"),
    )


def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: one quality report per event day (timestamp, records, columns, score, issues)."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.to_date("ts").cast("timestamp_ntz").alias("timestamp"))
            .agg(F.count(F.lit(1)).alias("total_records"),
                 (F.lit(20.0) + F.avg("value")).alias("overall_score"),
                 F.count_if(F.col("event_type") == "error").alias("n_issues"))
            .withColumn("total_columns", F.lit(6).cast("bigint")))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history derived from the event stream: a run per event, failed on 'error'."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("ts").alias("timestamp"),
                     (F.col("event_type") != "error").alias("success"),
                     F.col("value").alias("duration_seconds"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured log lines derived from the event stream (level from the event type)."""
    ev = table(spark, sf_dir, "events")
    level = (F.when(F.col("event_type") == "error", F.lit("ERROR"))
             .when(F.col("event_type") == "signup", F.lit("WARNING"))
             .otherwise(F.lit("INFO")))
    return ev.select(F.col("ts").alias("timestamp"), level.alias("level"),
                     F.lit("events").alias("logger"),
                     F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("message"),
                     F.col("user_id").cast("string").alias("user_id"),
                     F.col("event_id"))
