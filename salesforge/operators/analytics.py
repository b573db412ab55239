"""Sales analytics: AGG1-AGG11, WIN1-WIN3, FCT1-FCT2, INS1.

Shapes: wide one-row frames for scalar summaries, long ``(name, value, unit,
description, period)`` frames for metric lists.  Windows without a partition only ever
run over already-aggregated calendar periods (a few hundred rows at most) or over a
``top_n`` result, never over raw rows or product-sized sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesforge.functions.semantics import (
    fmt_fixed, fmt_thousands, num, pairwise_corr, round_half_even, sum0, ts, weekday_name,
)
from salesforge.functions.schema import NUMERIC_SALES_COLUMNS, SALES_COLUMNS
from salesforge.scratch import Scratch
from salesforge.session import materialize

METRIC_COLS = ["name", "value", "unit", "description", "period"]
# Weekday names in calendar order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


# ---------------------------------------------------------------------------------------
# TRF10: preparation
# ---------------------------------------------------------------------------------------
def prepare(df: DataFrame) -> DataFrame:
    """Parse date, add calendar parts, coerce the numeric columns (bad values -> NULL)."""
    cols = {}
    if "date" in df.columns:
        d = ts(df, "date")
        cols.update({"date": d, "year": F.year(d).cast("bigint"), "month": F.month(d).cast("bigint"),
                     "day": F.dayofmonth(d).cast("bigint"), "weekday": weekday_name(d),
                     "quarter": F.quarter(d).cast("bigint")})
    for c in NUMERIC_SALES_COLUMNS:
        if c in df.columns:
            cols[c] = num(df, c)
    return df.withColumns(cols)


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def _long(rows: list[tuple[str, Column, str, Column | str, Column | None]]) -> list[Column]:
    """Struct per metric row, for ``explode`` into the long metric shape."""
    out = []
    for name, value, unit, desc, period in rows:
        out.append(F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"),
                            F.lit(unit).alias("unit"),
                            (F.lit(desc) if isinstance(desc, str) else desc).alias("description"),
                            (period if period is not None else F.lit(None).cast("string")).alias("period")))
    return out


def _explode_long(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    if not structs:
        return one_row.sparkSession.createDataFrame(
            [], "name string, value double, unit string, description string, period string")
    return one_row.select(F.explode(F.array(*structs)).alias("m")).select("m.*")


# ---------------------------------------------------------------------------------------
# AGG1 / AGG2
# ---------------------------------------------------------------------------------------
def basic_metrics(df: DataFrame) -> DataFrame:
    """AGG1: one wide row; an absent column gives 0 (sums, means, counts) or NULL (dates)."""
    zero = F.lit(0.0)
    d = F.col("date") if "date" in df.columns else None
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        (F.date_format(F.min(d), "yyyy-MM-dd") if d is not None else F.lit(None).cast("string")).alias("start_date"),
        (F.date_format(F.max(d), "yyyy-MM-dd") if d is not None else F.lit(None).cast("string")).alias("end_date"),
        (sum0("total_sales") if _has(df, "total_sales") else zero).alias("total_revenue"),
        (sum0("quantity") if _has(df, "quantity") else zero).alias("total_quantity"),
        (F.avg("unit_price") if _has(df, "unit_price") else zero).alias("avg_unit_price"),
        (F.avg("discount") if _has(df, "discount") else zero).alias("avg_discount"),
        (F.countDistinct("product_id") if _has(df, "product_id") else F.lit(0).cast("bigint")).alias("unique_products"),
    )


def _flat_aggs(df: DataFrame) -> list[Column]:
    """Every row-level aggregate the basic and efficiency metric lists need."""
    aggs = []
    if _has(df, "total_sales"):
        aggs += [sum0("total_sales").alias("rev"), F.avg("total_sales").alias("aov")]
    if _has(df, "quantity"):
        aggs += [sum0("quantity").alias("qty"), F.avg("quantity").alias("aqpo")]
    if _has(df, "unit_price"):
        aggs.append(F.avg("unit_price").alias("aup"))
    if _has(df, "discount"):
        aggs.append(F.avg("discount").alias("adisc"))
    if _has(df, "product_id"):
        aggs.append(F.countDistinct("product_id").alias("nprod"))
    if _has(df, "discount", "quantity"):
        aggs.append(pairwise_corr("discount", "quantity").alias("dqc"))
    return aggs


def basic_metrics_long(df: DataFrame, flat: DataFrame | None = None) -> DataFrame:
    """AGG2: the basic metric list (only metrics whose columns exist).  ``flat`` is an
    optional precomputed one-row frame of ``_flat_aggs`` (shared by ``all_metrics``)."""
    if flat is not None:
        return _basic_rows(df, flat)
    aggs, rows = [], []
    if _has(df, "total_sales"):
        aggs += [sum0("total_sales").alias("rev"), F.avg("total_sales").alias("aov")]
    if _has(df, "quantity"):
        aggs.append(sum0("quantity").alias("qty"))
    if _has(df, "unit_price"):
        aggs.append(F.avg("unit_price").alias("aup"))
    if _has(df, "discount"):
        aggs.append(F.avg("discount").alias("adisc"))
    if _has(df, "product_id"):
        aggs.append(F.countDistinct("product_id").alias("nprod"))
    if not aggs:
        return _explode_long(df.limit(0), [])
    return _basic_rows(df, df.agg(*aggs))


def _basic_rows(df: DataFrame, one: DataFrame) -> DataFrame:
    rows = []
    # Metric names, units and descriptions.
    if _has(df, "total_sales"):
        rows.append(("total_revenue", F.col("rev"), "USD", "Total revenue from all sales", None))
    if _has(df, "quantity"):
        rows.append(("total_quantity", F.col("qty"), "units", "Total quantity of products sold", None))
    if _has(df, "total_sales"):
        rows.append(("avg_order_value", F.col("aov"), "USD", "Average value per order", None))
    if _has(df, "unit_price"):
        rows.append(("avg_unit_price", F.col("aup"), "USD", "Average price per unit", None))
    if _has(df, "discount"):
        rows.append(("avg_discount", F.col("adisc") * F.lit(100), "%", "Average discount rate", None))
    if _has(df, "product_id"):
        rows.append(("unique_products", F.col("nprod"), "products", "Number of unique products sold", None))
    return _explode_long(one, _long(rows))


# ---------------------------------------------------------------------------------------
# AGG3 / AGG4 / WIN1 / WIN3 / FCT: calendar periods
# ---------------------------------------------------------------------------------------
def _period_parts(period: str, style: str) -> tuple[Column, Column] | None:
    """(ordering key, label) for a calendar period.  ``style='analyzer'`` labels quarters
    ``YYYY-Qn``; ``style='period'`` labels them like pandas periods, ``YYYYQn``."""
    y, m, q = F.year("date"), F.month("date"), F.quarter("date")
    if period == "month":
        return (y * 12 + m).cast("bigint"), F.format_string("%d-%02d", y, m)
    if period == "quarter":
        sep = "-Q" if style == "analyzer" else "Q"
        return (y * 4 + q).cast("bigint"), F.format_string(f"%d{sep}%d", y, q)
    if period == "year":
        return y.cast("bigint"), F.format_string("%d", y)
    return None


def _period_revenue(df: DataFrame, period: str, style: str = "analyzer") -> DataFrame:
    """Revenue per calendar period, unsorted (for consumers that aggregate or window)."""
    parts = _period_parts(period, style)
    if parts is None or not _has(df, "date", "total_sales"):
        return df.sparkSession.createDataFrame([], "period string, period_order bigint, revenue double")
    order, label = parts
    return (df.where(F.col("date").isNotNull())
            .groupBy(order.alias("period_order"), label.alias("period"))
            .agg(sum0("total_sales").alias("revenue"))
            .select("period", "period_order", "revenue"))


def revenue_by_period(df: DataFrame, period: str = "month", style: str = "analyzer") -> DataFrame:
    """AGG3 / VIZ1: revenue per calendar period, in time order; no gap filling.  An
    unknown period gives an empty frame.  Columns: period, period_order, revenue."""
    return _period_revenue(df, period, style).orderBy("period_order")


def time_based_metrics(df: DataFrame, period: str = "month", per: DataFrame | None = None) -> DataFrame:
    """AGG4: best period (first in time order on ties) and, for months, the mean.
    ``per`` is an optional precomputed ``revenue_by_period`` frame."""
    # Metric names, units and descriptions.
    if period not in ("month", "quarter") or not _has(df, "date", "total_sales"):
        return _explode_long(df.limit(0), [])
    per = per if per is not None else _period_revenue(df, period, style="period")
    one = per.agg(F.max_by("period", F.struct(F.col("revenue"), -F.col("period_order"))).alias("best"),
                  F.max("revenue").alias("best_rev"), F.avg("revenue").alias("avg_rev"))
    if period == "month":
        rows = [("best_month_revenue", F.col("best_rev"), "USD",
                 F.concat(F.lit("Highest revenue month: "), F.col("best")), F.col("best")),
                ("avg_monthly_revenue", F.col("avg_rev"), "USD", "Average monthly revenue", None)]
    else:
        rows = [("best_quarter_revenue", F.col("best_rev"), "USD",
                 F.concat(F.lit("Highest revenue quarter: "), F.col("best")), F.col("best"))]
    # No periods at all: no metric (pandas would fail on an empty idxmax).
    return _explode_long(one.where(F.col("best").isNotNull()), _long(rows))


def revenue_trends(df: DataFrame, period: str = "month") -> DataFrame:
    """WIN1: period-over-period revenue change.  The first period has no predecessor and
    is omitted.  A zero predecessor gives a NULL change (pandas: +-inf) but the direction
    still follows the sign of the current value."""
    per = _period_revenue(df, period, style="analyzer")
    w = Window.orderBy("period_order")  # over calendar periods only
    prev = F.lag("revenue").over(w)
    t = per.withColumn("previous_value", prev).where(F.col("previous_value").isNotNull())
    change = F.try_divide(F.col("revenue") - F.col("previous_value"), F.col("previous_value")) * F.lit(100)
    sign = F.when(F.col("previous_value") == 0, F.signum(F.col("revenue"))).otherwise(F.signum(change))
    return t.select(
        "period", F.lit("revenue").alias("metric"), F.col("revenue").alias("current_value"),
        "previous_value", change.alias("change_percent"),
        F.when(sign > 0, "up").when(sign < 0, "down").otherwise("stable").alias("trend_direction"),
        "period_order")


def trend_metrics(df: DataFrame, periods: int = 3, per: DataFrame | None = None) -> DataFrame:
    """WIN3: mean of the last ``periods`` months against the mean of the ``periods`` months
    ending one month earlier (overlapping windows); needs at least ``periods`` months."""
    if not _has(df, "date", "total_sales"):
        return _explode_long(df.limit(0), [])
    per = per if per is not None else _period_revenue(df, "month")
    rn = F.row_number().over(Window.orderBy(F.col("period_order").desc()))
    r = per.withColumn("rn", rn)
    one = r.agg(F.count(F.lit(1)).alias("n"),
                F.avg(F.when(F.col("rn") <= periods, F.col("revenue"))).alias("recent"),
                F.avg(F.when(F.col("rn").between(2, periods + 1), F.col("revenue"))).alias("earlier"))
    growth = F.try_divide(F.col("recent") - F.col("earlier"), F.col("earlier")) * F.lit(100)
    rows = _long([("revenue_growth_rate", growth, "%",
                   f"Revenue growth rate over last {periods} months", None)])
    return (one.where(F.col("n") >= periods)
            .select(F.explode(F.array(*rows)).alias("m"), growth.alias("trend"))
            .select("m.*", "trend"))


# ---------------------------------------------------------------------------------------
# AGG5 / AGG6 / AGG8 / AGG9
# ---------------------------------------------------------------------------------------
def _products(df: DataFrame) -> DataFrame:
    return (df.where(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(sum0("total_sales").alias("revenue"), sum0("quantity").alias("quantity")))


def product_metrics(df: DataFrame, prod: DataFrame | None = None) -> DataFrame:
    """AGG5: top product by revenue and by quantity (smallest id on ties), and the top-5
    revenue share.  The top 5 come from a bounded top-k, not a sort of all products."""
    # Metric names, units and descriptions.
    if not _has(df, "product_id", "total_sales", "quantity"):
        return _explode_long(df.limit(0), [])
    prod = prod if prod is not None else _products(df)
    # The top 5 come from a bounded top-k; flagging them (broadcast of 5 ids) lets one
    # aggregate produce every figure.
    top5_ids = (prod.orderBy(F.col("revenue").desc(), F.col("product_id")).limit(5)
                .select("product_id", F.lit(True).alias("in_top5")))
    one = prod.join(F.broadcast(top5_ids), "product_id", "left").agg(
        F.min_by("product_id", F.struct(-F.col("revenue"), F.col("product_id"))).alias("top_rev_id"),
        F.max("revenue").alias("top_rev"),
        F.min_by("product_id", F.struct(-F.col("quantity"), F.col("product_id"))).alias("top_qty_id"),
        F.max("quantity").alias("top_qty"),
        F.sum("revenue").alias("total"),
        F.sum(F.when(F.col("in_top5"), F.col("revenue"))).alias("top5"))
    rows = [("top_product_revenue", F.col("top_rev"), "USD",
             F.concat(F.lit("Revenue from top product: "), F.col("top_rev_id")), F.col("top_rev_id")),
            ("top_product_quantity", F.col("top_qty"), "units",
             F.concat(F.lit("Quantity sold of top product: "), F.col("top_qty_id")), F.col("top_qty_id")),
            ("top_5_concentration", F.try_divide(F.col("top5"), F.col("total")) * F.lit(100), "%",
             "Revenue share of top 5 products", None)]
    return _explode_long(one.where(F.col("top_rev_id").isNotNull()), _long(rows))


def product_performance(df: DataFrame, top_n: int = 10) -> DataFrame:
    """AGG6 + WIN2: per-product totals rounded to 2 places (half even), revenue rank
    (descending, ties averaged, computed on the rounded revenue), profit margin from the
    rounded average discount; the ``top_n`` highest-revenue products.

    The rank of a top-n row is (rows above it in the top-n) + (size of its tie group
    + 1) / 2.  Every product with higher revenue is inside the top-n, so only the tie
    group sizes need the full product set: a join against the <= top_n distinct top
    revenues (broadcast; bounded by ``top_n``) -- no window over all products.
    """
    r2 = lambda c: round_half_even(c, 2)
    perf = (df.where(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(r2(sum0("total_sales")).alias("total_revenue"),
                 r2(F.avg("total_sales")).alias("avg_order_value"),
                 F.count("total_sales").alias("order_count"),
                 r2(sum0("quantity")).alias("total_quantity"),
                 r2(F.avg("unit_price")).alias("avg_price"),
                 r2(F.avg("discount")).alias("avg_discount")))
    return _performance(materialize(perf), top_n)  # one row per product; the table is read once


def _performance(perf: DataFrame, top_n: int) -> DataFrame:
    top = perf.orderBy(F.col("total_revenue").desc(), F.col("product_id")).limit(top_n)
    ties = (perf.select("total_revenue")
            .join(F.broadcast(top.select("total_revenue").distinct()), "total_revenue")
            .groupBy("total_revenue").agg(F.count(F.lit(1)).alias("n_equal")))
    above = F.rank().over(Window.orderBy(F.col("total_revenue").desc())) - 1  # top_n rows
    return (top.join(F.broadcast(ties), "total_revenue")
            .withColumn("revenue_rank", (above + (F.col("n_equal") + 1) / F.lit(2.0)).cast("double"))
            .withColumn("profit_margin", (F.lit(1) - F.col("avg_discount")) * F.lit(100))
            .select("product_id", "total_revenue", "avg_order_value", "order_count", "total_quantity",
                    "avg_price", "avg_discount", "revenue_rank", "profit_margin")
            .orderBy(F.col("total_revenue").desc(), F.col("product_id")))


def efficiency_metrics(df: DataFrame, prod: DataFrame | None = None, flat: DataFrame | None = None) -> DataFrame:
    """AGG8: mean revenue per product, mean quantity per order, discount/quantity
    correlation (pairwise complete; NULL for constant input).  ``prod``/``flat`` are
    optional precomputed product totals and row-level aggregates."""
    frames = []
    if _has(df, "product_id", "total_sales"):
        prod = prod if prod is not None else _products(df)
        per_prod = prod.agg(F.avg("revenue").alias("aspp"))
        frames.append(_explode_long(per_prod, _long([("avg_sales_per_product", F.col("aspp"), "USD",
                                                       "Average revenue per product", None)])))
    rows, aggs = [], []
    if _has(df, "quantity"):
        aggs.append(F.avg("quantity").alias("aqpo"))
        rows.append(("avg_quantity_per_order", F.col("aqpo"), "units", "Average quantity per order", None))
    if _has(df, "discount", "quantity"):
        aggs.append(pairwise_corr("discount", "quantity").alias("dqc"))
        rows.append(("discount_quantity_correlation", F.col("dqc"), "correlation",
                     "Correlation between discount and quantity sold", None))
    if rows:
        frames.append(_explode_long(flat if flat is not None else df.agg(*aggs), _long(rows)))
    if not frames:
        return _explode_long(df.limit(0), [])
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def correlation_matrix(df: DataFrame) -> DataFrame:
    """AGG9 / VIZ4: long correlation matrix (col_a, col_b, r) over the available numeric
    columns; every pair in one aggregate, mirrored; unit diagonal for non-constant
    columns.  Fewer than two columns -> empty."""
    cols = [c for c in NUMERIC_SALES_COLUMNS if c in df.columns]
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")
    return _correlation_cells(df.agg(*_correlation_aggs(cols)), cols)


def _correlation_aggs(cols: list[str]) -> list[Column]:
    """Every pair once, and the unit diagonal."""
    aggs = []
    for i, a in enumerate(cols):
        aggs.append(F.when(F.stddev_samp(a) > 0, F.lit(1.0)).alias(f"{a}__{a}"))
        for b in cols[i + 1:]:
            aggs.append(pairwise_corr(a, b).alias(f"{a}__{b}"))
    return aggs


def _correlation_cells(one: DataFrame, cols: list[str]) -> DataFrame:
    cells = []
    for a in cols:
        for b in cols:
            src = f"{a}__{b}" if cols.index(a) <= cols.index(b) else f"{b}__{a}"
            cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(src).alias("r")))
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


# ---------------------------------------------------------------------------------------
# AGG7: seasonality
# ---------------------------------------------------------------------------------------
def seasonal_totals(df: DataFrame) -> DataFrame:
    """Revenue by month-of-year, weekday name and quarter in one aggregation
    (GROUPING SETS).  Columns: dimension, key, key_sort, total."""
    p = df.where(F.col("date").isNotNull()).select(
        F.month("date").alias("m"), weekday_name("date").alias("wd"),
        F.quarter("date").alias("q"), "total_sales")
    g = p.groupingSets([["m"], ["wd"], ["q"]], "m", "wd", "q").agg(
        sum0("total_sales").alias("total"), F.grouping_id().alias("gid"))
    # grouping_id bits (m, wd, q): 1 = not grouped by that column.
    dim = (F.when(F.col("gid") == 3, "monthly").when(F.col("gid") == 5, "daily")
           .otherwise("quarterly"))
    key = F.coalesce(F.col("m").cast("string"), F.col("wd"), F.col("q").cast("string"))
    key_sort = F.coalesce(F.lpad(F.col("m").cast("string"), 2, "0"), F.col("wd"), F.col("q").cast("string"))
    return g.select(dim.alias("dimension"), key.alias("key"), key_sort.alias("key_sort"), "total")


def seasonal_patterns(df: DataFrame) -> DataFrame:
    """AGG7: best and worst key per dimension (first key in sort order on ties)."""
    t = seasonal_totals(df)
    return t.groupBy("dimension").agg(
        F.min_by("key", F.struct(-F.col("total"), F.col("key_sort"))).alias("best"),
        F.min_by("key", F.struct(F.col("total"), F.col("key_sort"))).alias("worst"),
        F.sum("total").alias("total"))


# ---------------------------------------------------------------------------------------
# AGG10 / AGG11
# ---------------------------------------------------------------------------------------
def all_metrics(df: DataFrame) -> DataFrame:
    """AGG10: every metric list, tagged with its category.  The lists share three
    aggregates -- one over the rows, one per month, one per product -- that are settled
    first, so the table is read three times, not once per list."""
    flat = materialize(df.agg(*_flat_aggs(df))) if _flat_aggs(df) else None
    per = materialize(_period_revenue(df, "month", style="period")) if _has(df, "date", "total_sales") else None
    prod = materialize(_products(df)) if _has(df, "product_id", "total_sales", "quantity") else None
    frames = [("basic", basic_metrics_long(df, flat)), ("time_based", time_based_metrics(df, "month", per)),
              ("product", product_metrics(df, prod)), ("trends", trend_metrics(df, 3, per).drop("trend")),
              ("efficiency", efficiency_metrics(df, prod, flat))]
    out = None
    for cat, f in frames:
        f = f.select(F.lit(cat).alias("category"), *METRIC_COLS)
        out = f if out is None else out.unionByName(f)
    return out


def metric_summary(df: DataFrame) -> DataFrame:
    """AGG10 summary: metric count per category."""
    return all_metrics(df).groupBy("category").agg(F.count(F.lit(1)).alias("total_metrics"))


def load_metrics(transformed: DataFrame, daily: DataFrame | None = None,
                 records_processed: int | None = None) -> DataFrame:
    """AGG11: revenue and distinct products of the loaded rows, plus the daily rollup's
    revenue, quantity and day count when given."""
    r = transformed.agg(F.count(F.lit(1)).alias("records_processed"),
                        sum0("total_sales").alias("total_sales"),
                        F.countDistinct("product_id").alias("unique_products")).first().asDict()
    if records_processed is not None:
        r["records_processed"] = records_processed
    cols = ["records_processed bigint", "total_sales double", "unique_products bigint"]
    vals = [r["records_processed"], float(r["total_sales"]), r["unique_products"]]
    if daily is not None:
        d = daily.agg(sum0("total_revenue").alias("a"), sum0("total_quantity").alias("b"),
                      F.count(F.lit(1)).alias("c")).first()
        cols += ["daily_total_revenue double", "daily_total_quantity double", "days_of_sales bigint"]
        vals += [float(d["a"]), float(d["b"]), d["c"]]
    # one bounded row assembled on the driver from two one-row aggregates
    return transformed.sparkSession.createDataFrame([tuple(vals)], ", ".join(cols))


# ---------------------------------------------------------------------------------------
# FCT1 / FCT2
# ---------------------------------------------------------------------------------------
def forecast(df: DataFrame, periods: int = 12, method: str = "simple") -> DataFrame:
    """Monthly revenue forecast.

    ``simple``: mean of the last 3 months repeated ``periods`` times (nothing when fewer
    than 3 months).  ``trend``: least-squares line over month ordinals 0..n-1 (observed
    months only), extrapolated to n..n+periods-1 (nothing when fewer than 2 months).
    Columns: step, forecast_value, method, trend_slope, confidence.
    """
    if method not in ("simple", "trend"):
        raise ValueError(f"Unknown forecasting method: {method}")
    per = _period_revenue(df, "month")
    x = F.row_number().over(Window.orderBy("period_order")) - 1  # calendar months only
    pts = per.withColumn("x", x.cast("double"))
    if method == "simple":
        whole = Window.partitionBy()  # over calendar months only
        one = (pts.withColumn("n", F.count(F.lit(1)).over(whole)).withColumn("last", F.max("x").over(whole))
               .where(F.col("x") > F.col("last") - 3)
               .groupBy("n").agg(F.avg("revenue").alias("level")).where(F.col("n") >= 3))
        steps = one.select(F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"), "level")
        return steps.select(F.col("step").cast("bigint"), F.col("level").alias("forecast_value"),
                            F.lit("simple_moving_average").alias("method"),
                            F.lit(None).cast("double").alias("trend_slope"),
                            F.lit("low").alias("confidence"))
    one = pts.agg(F.count(F.lit(1)).alias("n"), F.regr_slope("revenue", "x").alias("slope"),
                  F.regr_intercept("revenue", "x").alias("intercept")).where(F.col("n") >= 2)
    steps = one.select(F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"), "n", "slope", "intercept")
    xi = (F.col("n") + F.col("step") - 1).cast("double")
    return steps.select(F.col("step").cast("bigint"),
                        (F.col("slope") * xi + F.col("intercept")).alias("forecast_value"),
                        F.lit("linear_trend").alias("method"), F.col("slope").alias("trend_slope"),
                        F.lit("medium").alias("confidence"))


# ---------------------------------------------------------------------------------------
# INS1
# ---------------------------------------------------------------------------------------
def insights(df: DataFrame, anomaly_count: DataFrame | None = None, money_dp: int | None = None,
             flat: DataFrame | None = None, prod: DataFrame | None = None, seasons: DataFrame | None = None) -> DataFrame:
    """INS1: insight rows (type, title, description, value_num, value_text).

    ``anomaly_count`` is a one-row frame with column ``n`` (IQR anomaly rows); see
    ``salesforge.operators.anomalies.anomaly_count``.  ``money_dp`` snaps revenue sums
    to that many places before they are formatted, so the text does not depend on the
    order in which partial sums were added.  ``flat`` (rev, disc), ``prod`` (product_id,
    revenue) and ``seasons`` (``seasonal_patterns``) are optional precomputed frames.
    """
    # The types, titles and texts of the insights below.
    spark = df.sparkSession
    snap = (lambda c: round_half_even(c, money_dp)) if money_dp is not None else (lambda c: c)
    frames = []
    cols = ["type", "title", "description", "value_num", "value_text"]
    scalars = [a for a, ok in ((snap(sum0("total_sales")).alias("rev"), _has(df, "total_sales")),
                               (F.avg("discount").alias("disc"), _has(df, "discount"))) if ok]
    if flat is not None:
        flat = flat.select(snap(F.col("rev")).alias("rev"), "disc")
    elif scalars:
        flat = materialize(df.agg(*scalars))  # one pass for both scalar insights
    if _has(df, "total_sales"):
        rev = flat.select(F.col("rev").alias("v")).where(F.col("v") > 0)
        frames.append(rev.select(F.lit("revenue").alias("type"), F.lit("Total Revenue").alias("title"),
                                 F.concat(F.lit("Total revenue generated: $"), fmt_thousands("v", 2)).alias("description"),
                                 F.col("v").alias("value_num"), F.lit(None).cast("string").alias("value_text")))
    if _has(df, "product_id", "total_sales"):
        if prod is None:
            prod = (df.where(F.col("product_id").isNotNull()).groupBy("product_id")
                    .agg(sum0("total_sales").alias("revenue")))
        top = prod.agg(F.min_by("product_id", F.struct(-F.col("revenue"), F.col("product_id"))).alias("pid"),
                       snap(F.max("revenue")).alias("v")).where(F.col("pid").isNotNull())
        frames.append(top.select(F.lit("product").alias("type"), F.lit("Top Performing Product").alias("title"),
                                 F.format_string("Product %s generated $%s in revenue", F.col("pid"),
                                                 fmt_thousands("v", 2)).alias("description"),
                                 F.lit(None).cast("double").alias("value_num"), F.col("pid").alias("value_text")))
    if _has(df, "discount"):
        disc = flat.select(F.col("disc").alias("v"))
        frames.append(disc.select(F.lit("discount").alias("type"), F.lit("Average Discount").alias("title"),
                                  F.concat(F.lit("Average discount rate: "),
                                           fmt_fixed(F.col("v") * 100, 1), F.lit("%")).alias("description"),
                                  F.col("v").alias("value_num"), F.lit(None).cast("string").alias("value_text")))
    if _has(df, "date"):
        months = (seasons if seasons is not None else seasonal_patterns(df)).where(F.col("dimension") == "monthly")
        frames.append(months.select(F.lit("seasonal").alias("type"), F.lit("Peak Sales Month").alias("title"),
                                    F.format_string("Month %s shows the highest sales volume", F.col("best")).alias("description"),
                                    F.col("best").cast("double").alias("value_num"),
                                    F.col("best").alias("value_text")))
    if anomaly_count is not None:
        a = anomaly_count.where(F.col("n") > 0)
        frames.append(a.select(F.lit("anomaly").alias("type"), F.lit("Data Anomalies Detected").alias("title"),
                               F.format_string("Found %d anomalous records that may need investigation",
                                               F.col("n")).alias("description"),
                               F.col("n").cast("double").alias("value_num"),
                               F.lit(None).cast("string").alias("value_text")))
    if not frames:
        return spark.createDataFrame([], "type string, title string, description string, "
                                         "value_num double, value_text string")
    out = frames[0].select(*cols)
    for f in frames[1:]:
        out = out.unionByName(f.select(*cols))
    return out


# ---------------------------------------------------------------------------------------
# INS2
# ---------------------------------------------------------------------------------------
def analysis_report(df: DataFrame, anomaly_count: DataFrame | None = None, top_n: int = 10,
                    money_dp: int | None = None) -> dict[str, DataFrame]:
    """INS2: the frames of the analysis report (basic metrics, insights, product
    performance, seasonal patterns, correlations); write them with
    ``sinks.write_frames_json``.

    Two scans feed all of them: one aggregate of row-level figures, and one GROUPING SETS
    aggregate by day and by product, settled (one row per day and per product), from which
    the seasons, the products and the number of products are derived.  A table that lacks
    a sales column gets the frames one by one, as far as its columns go."""
    if not _has(df, *SALES_COLUMNS):
        return {"basic_metrics": basic_metrics(df), "insights": insights(df, anomaly_count, money_dp),
                "product_performance": product_performance(df, top_n), "seasonal_patterns": seasonal_patterns(df),
                "correlations": correlation_matrix(df)}
    scratch = Scratch(df.sparkSession)
    one = scratch.table(df.agg(
        F.count(F.lit(1)).alias("total_records"), F.date_format(F.min("date"), "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("end_date"), sum0("total_sales").alias("total_revenue"),
        sum0("quantity").alias("total_quantity"), F.avg("unit_price").alias("avg_unit_price"),
        F.avg("discount").alias("avg_discount"), *_correlation_aggs(NUMERIC_SALES_COLUMNS)), "figures")
    rows = df.select(F.to_date("date").cast("timestamp_ntz").alias("day"), "product_id", *NUMERIC_SALES_COLUMNS)
    sets = scratch.table(rows.groupingSets([["day"], ["product_id"]], "day", "product_id").agg(
        F.grouping_id().alias("gid"), *[f(c).alias(f"{n}_{c}") for c in NUMERIC_SALES_COLUMNS for n, f in (("sum", sum0), ("count", F.count))]), "sets")
    # grouping_id bits (day, product): 1 = not grouped by that column.
    days = sets.where(F.col("gid") == 1).select(F.col("day").alias("date"), F.col("sum_total_sales").alias("total_sales"))
    prods = sets.where((F.col("gid") == 2) & F.col("product_id").isNotNull())
    mean = lambda c: round_half_even(F.try_divide(F.col(f"sum_{c}"), F.col(f"count_{c}")), 2)
    perf = prods.select("product_id", round_half_even("sum_total_sales", 2).alias("total_revenue"), mean("total_sales").alias("avg_order_value"),
                        F.col("count_total_sales").alias("order_count"), round_half_even("sum_quantity", 2).alias("total_quantity"),
                        mean("unit_price").alias("avg_price"), mean("discount").alias("avg_discount"))
    names = ["total_records", "start_date", "end_date", "total_revenue", "total_quantity", "avg_unit_price", "avg_discount", "unique_products"]
    count = prods.agg(F.count(F.lit(1)).alias("unique_products"))
    basic = one.unionByName(count, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in names])  # two one-row frames
    seasons = seasonal_patterns(days)
    flat = one.select(F.col("total_revenue").alias("rev"), F.col("avg_discount").alias("disc"))
    return {"basic_metrics": basic,
            "insights": insights(df, anomaly_count, money_dp, flat, prods.select("product_id", F.col("sum_total_sales").alias("revenue")), seasons),
            "product_performance": _performance(perf, top_n), "seasonal_patterns": seasons,
            "correlations": _correlation_cells(one, NUMERIC_SALES_COLUMNS)}
