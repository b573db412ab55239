"""VIZ1-VIZ7: the data behind each chart (drawing is left to the caller).

Only bounded frames come out: per-period series, a top-n, 7/12/4-row calendars,
``bins`` histogram rows per column and ``bins x bins`` scatter cells per pair.  Raw
scatter points are never shipped: at scale they are replaced by 2-D binned counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesforge.functions.schema import NUMERIC_SALES_COLUMNS, SALES_COLUMNS
from salesforge.functions.semantics import finite, num, sum0, weekday_name
from salesforge.operators.analytics import WEEKDAYS, _correlation_aggs, correlation_matrix, revenue_by_period
from salesforge.scratch import Scratch

HIST_COLUMNS = ["total_sales", "quantity", "unit_price", "discount"]
# The scatter pairs (x, y).
SCATTER_PAIRS = [("quantity", "total_sales"), ("unit_price", "total_sales"), ("discount", "quantity"),
                 ("unit_price", "quantity")]


def revenue_trend(df: DataFrame, period: str = "month") -> DataFrame:
    """VIZ1."""
    return revenue_by_period(df, period)


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """VIZ2: the ``n`` highest-revenue products (bounded top-k; ties by product id)."""
    return (df.where(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(sum0("total_sales").alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("product_id")).limit(n))


def month_pattern(df: DataFrame) -> DataFrame:
    """VIZ3a: revenue by month of year (months present only)."""
    return (df.where(F.col("date").isNotNull()).groupBy(F.month("date").cast("bigint").alias("month"))
            .agg(sum0("total_sales").alias("revenue")).orderBy("month"))


def weekday_pattern(df: DataFrame) -> DataFrame:
    """VIZ3b: revenue by weekday in Monday..Sunday order; a weekday without sales is
    kept with NULL revenue.  The calendar side is a fixed 7-row frame (broadcast)."""
    cal = df.sparkSession.createDataFrame([(i, d) for i, d in enumerate(WEEKDAYS)], "day_index bigint, weekday string")
    per = (df.where(F.col("date").isNotNull()).groupBy(weekday_name("date").alias("weekday"))
           .agg(sum0("total_sales").alias("revenue")))
    return F.broadcast(cal).join(per, "weekday", "left").select("day_index", "weekday", "revenue").orderBy("day_index")


def quarter_share(df: DataFrame) -> DataFrame:
    """VIZ3c: revenue per quarter and its share of the total (%)."""
    per = (df.where(F.col("date").isNotNull()).groupBy(F.quarter("date").cast("bigint").alias("quarter"))
           .agg(sum0("total_sales").alias("revenue")))
    total = F.sum("revenue").over(Window.partitionBy())  # over the <= 4 quarter rows
    return (per.select("quarter", F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("label"), "revenue",
                       (F.try_divide(F.col("revenue"), total) * F.lit(100.0)).alias("share_pct"))
            .orderBy("quarter"))


def yearly_revenue(df: DataFrame) -> DataFrame:
    """VIZ3d: revenue per calendar year."""
    return (df.where(F.col("date").isNotNull()).groupBy(F.year("date").cast("bigint").alias("year"))
            .agg(sum0("total_sales").alias("revenue")).orderBy("year"))


def _range(lo: float, hi: float) -> tuple[float, float]:
    # numpy's default range for a constant sample
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)


def _bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """numpy.histogram bin index: edges ``lo + i * (hi - lo) / bins`` (last edge = hi),
    the last bin closed.  The first guess ``i0`` from the scaled offset is corrected
    against its two edges as numpy does (step down if below the lower edge, otherwise
    up if at/after the upper edge and not the last bin), written as one flat expression
    so whole-stage codegen keeps it small."""
    step = (hi - lo) / bins
    norm = bins / (hi - lo)
    i0 = F.least(F.lit(bins - 1), F.floor((x - F.lit(lo)) * F.lit(norm)).cast("int"))
    lower = i0.cast("double") * F.lit(step) + F.lit(lo)
    upper = F.when(i0 + 1 >= bins, F.lit(hi)).otherwise((i0 + 1).cast("double") * F.lit(step) + F.lit(lo))
    down = x < lower
    up = (~down) & (x >= upper) & (i0 != bins - 1)
    return i0 - down.cast("int") + up.cast("int")


def _edges(ends: dict[str, tuple[float, float]], bins: int) -> list[tuple]:
    """(column, bin, lower edge, upper edge)."""
    out = []
    for c, (lo, hi) in ends.items():
        step = (hi - lo) / bins
        out += [(c, i, lo + i * step, hi if i == bins - 1 else lo + (i + 1) * step) for i in range(bins)]
    return out


def histograms(df: DataFrame, bins: int = 30, columns: list[str] | None = None) -> DataFrame:
    """VIZ5: equal-width histograms (column, bin, bin_lo, bin_hi, count); every bin is
    present (empty ones with 0); non-finite values are in none.  Ranges come from one min/max aggregate."""
    columns = [c for c in (columns or HIST_COLUMNS) if c in df.columns]
    vals = df.select(*[finite(num(df, c)).alias(c) for c in columns])
    mm = vals.agg(*[x for c in columns for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    parts, ends = [], {}
    for c in columns:
        if mm[f"lo_{c}"] is None:
            continue
        ends[c] = lo, hi = _range(float(mm[f"lo_{c}"]), float(mm[f"hi_{c}"]))
        parts.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"),
                                                            _bin(F.col(c), lo, hi, bins).alias("bin"))))
    spark = df.sparkSession
    schema = "column string, bin int, bin_lo double, bin_hi double"
    if not parts:
        return spark.createDataFrame([], schema + ", count long")
    counts = (vals.select(F.explode(F.array(*parts)).alias("h")).where(F.col("h").isNotNull())
              .groupBy("h.column", "h.bin").count())
    edges = spark.createDataFrame(_edges(ends, bins), schema)  # bins x columns rows
    return (F.broadcast(edges).join(counts, ["column", "bin"], "left")
            .select("column", F.col("bin").cast("bigint"), "bin_lo", "bin_hi",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("column", "bin"))


def scatter_bins(df: DataFrame, bins: int = 20, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """VIZ6: 2-D binned point counts (pair, x_bin, y_bin, count) for each scatter pair;
    empty cells are omitted."""
    pairs = [(a, b) for a, b in (pairs or SCATTER_PAIRS) if a in df.columns and b in df.columns]
    cols = sorted({c for p in pairs for c in p})
    vals = df.select(*[num(df, c).alias(c) for c in cols])
    mm = vals.agg(*[x for c in cols for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    # One bin per column in its own projection (not one per pair use), then pair the ints.
    bins_of = {}
    for c in cols:
        if mm[f"lo_{c}"] is not None:
            lo, hi = _range(float(mm[f"lo_{c}"]), float(mm[f"hi_{c}"]))
            bins_of[c] = _bin(F.col(c), lo, hi, bins).alias(f"b_{c}")
    binned = vals.select(*bins_of.values())
    parts = [F.when(F.col(f"b_{a}").isNotNull() & F.col(f"b_{b}").isNotNull(),
                    F.struct(F.lit(f"{a}:{b}").alias("pair"), F.col(f"b_{a}").alias("x_bin"),
                             F.col(f"b_{b}").alias("y_bin")))
             for a, b in pairs if a in bins_of and b in bins_of]
    if not parts:
        return df.sparkSession.createDataFrame([], "pair string, x_bin bigint, y_bin bigint, count long")
    return (binned.select(F.explode(F.array(*parts)).alias("p")).where(F.col("p").isNotNull())
            .groupBy("p.pair", F.col("p.x_bin").cast("bigint").alias("x_bin"),
                     F.col("p.y_bin").cast("bigint").alias("y_bin")).count())


def date_revenue_bins(df: DataFrame, bins: int = 20) -> DataFrame:
    """VIZ6 (date vs revenue): revenue-bin counts per calendar month."""
    mm = df.agg(F.min("total_sales").alias("lo"), F.max("total_sales").alias("hi")).first()
    if mm["lo"] is None:
        return df.sparkSession.createDataFrame([], "month string, y_bin bigint, count long")
    lo, hi = _range(float(mm["lo"]), float(mm["hi"]))
    return (df.where(F.col("date").isNotNull() & F.col("total_sales").isNotNull())
            .groupBy(F.date_format("date", "yyyy-MM").alias("month"),
                     _bin(F.col("total_sales"), lo, hi, bins).cast("bigint").alias("y_bin")).count())


def dashboard(df: DataFrame, bins: int = 20, top_n: int = 5) -> dict[str, DataFrame]:
    """VIZ7: every chart frame of the dashboard, from two scans.

    The first is one aggregate: the ranges of the numeric columns and the correlations.
    The second gives every row its bins and is one GROUPING SETS aggregate: by all bins
    together, by month and revenue bin, and by product.  Its result (at most ``bins`` to
    the fourth rows, and one per month's bin and per product) is settled; pairs are
    margins of the joint bins, histograms margins of the pairs.  Bins are over finite values.  A table that lacks a sales column gets
    the frames one by one, as far as its columns go."""
    if not all(c in df.columns for c in SALES_COLUMNS):
        return {"revenue_trend": revenue_trend(df, "month"), "top_products": top_products(df, top_n),
                "month_pattern": month_pattern(df), "correlations": correlation_matrix(df),
                "histograms": histograms(df, bins), "scatter": scatter_bins(df, bins), "date_revenue": date_revenue_bins(df, bins)}
    spark, scratch = df.sparkSession, Scratch(df.sparkSession)
    figures = df.agg(*[x for c in HIST_COLUMNS for x in (F.min(finite(num(df, c))).alias(f"lo_{c}"), F.max(finite(num(df, c))).alias(f"hi_{c}"))],
                     *_correlation_aggs(NUMERIC_SALES_COLUMNS)).first()
    ends = {c: _range(float(figures[f"lo_{c}"]), float(figures[f"hi_{c}"])) for c in HIST_COLUMNS if figures[f"lo_{c}"] is not None}
    values = df.select((F.year("date") * 12 + F.month("date")).cast("bigint").alias("month"), "product_id", "total_sales",
                       *[finite(num(df, c)).alias(f"f_{c}") for c in HIST_COLUMNS])
    binned = values.select("month", "product_id", "total_sales", *[
        (_bin(F.col(f"f_{c}"), *ends[c], bins) if c in ends else F.lit(None)).cast("int").alias(f"b_{c}") for c in HIST_COLUMNS])

    joint = [f"b_{c}" for c in HIST_COLUMNS]
    keys = [*joint, "month", "product_id"]
    grouped = binned.groupingSets([joint, ["month", "b_total_sales"], ["product_id"]], *keys)
    sets = scratch.table(grouped.agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), sum0("total_sales").alias("v")), "charts")
    # grouping_id has one bit per key, the first one highest: 1 = not grouped by it.
    of = lambda *by: sets.where(F.col("gid") == sum(1 << i for i, k in enumerate(reversed(keys)) if k not in by))
    months = of("month", "b_total_sales").where("month is not null").withColumn("m", F.pmod(F.col("month") - 1, F.lit(12)) + 1)
    label = F.format_string("%d-%02d", F.expr("(month - m) div 12"), F.col("m"))
    revenue = F.sum("v").alias("revenue")
    cells = F.array(*[F.struct(F.lit(at).alias("at"), F.col(f"b_{p}").cast("bigint").alias("x"), F.col(f"b_{q}").cast("bigint").alias("y"))
                      for at, (p, q) in enumerate(SCATTER_PAIRS)])
    pairs = of(*joint).select("n", F.explode(cells).alias("c")).groupBy("c.at", "c.x", "c.y").agg(F.sum("n").alias("n"))  # at most bins^4 rows
    pairs = pairs.withColumn("pair", F.element_at(F.array(*[F.lit(f"{p}:{q}") for p, q in SCATTER_PAIRS]), F.col("at") + 1))
    # A column's histogram is a margin of the first pair it belongs to.
    margins = F.explode(F.array(*[F.when(F.col("at") == at, F.struct(F.lit(c).alias("column"), F.col("xy"[pair.index(c)]).alias("bin"), "n"))
                                  for c in HIST_COLUMNS for at, pair in [next((i, p) for i, p in enumerate(SCATTER_PAIRS) if c in p)]]))
    edges = spark.createDataFrame(_edges(ends, bins), "column string, bin bigint, bin_lo double, bin_hi double")  # bins x columns rows
    counts = (pairs.select(margins.alias("h")).where(F.col("h.bin").isNotNull()).select("h.*")
              .groupBy("column", "bin").agg(F.sum("n").alias("n")))
    corr = [(p, q, figures[f"{p}__{q}" if NUMERIC_SALES_COLUMNS.index(p) <= NUMERIC_SALES_COLUMNS.index(q) else f"{q}__{p}"])
             for p in NUMERIC_SALES_COLUMNS for q in NUMERIC_SALES_COLUMNS]
    return {
        "revenue_trend": months.groupBy(label.alias("period"), F.col("month").alias("period_order")).agg(revenue).orderBy("period_order"),
        "top_products": of("product_id").where("product_id is not null").select("product_id", F.col("v").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "product_id").limit(top_n),
        "month_pattern": months.groupBy(F.col("m").alias("month")).agg(revenue).orderBy("month"),
        "correlations": spark.createDataFrame(corr, "col_a string, col_b string, r double"),
        "histograms": F.broadcast(edges).join(counts, ["column", "bin"], "left").select(
            "column", "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("count")).orderBy("column", "bin"),
        "scatter": pairs.where("x is not null and y is not null").select("pair", F.col("x").alias("x_bin"), F.col("y").alias("y_bin"), F.col("n").alias("count")),
        "date_revenue": months.where("b_total_sales is not null").select(
            label.alias("month"), F.col("b_total_sales").cast("bigint").alias("y_bin"), F.col("n").alias("count"))}
