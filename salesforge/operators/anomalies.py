"""OUT1-OUT4: outlier summaries and anomalous rows.

Bounds come from one exact-quantile pass (IQR) or one mean/std aggregate (z-score); both
are bounded one-row results injected into the row plan as literals, so the row filter
is a plain codegen'd predicate.  Anomalous rows are produced in a single pass: each row
carries an array of the tags it earned and is exploded (one output row per offending
column), with no per-column union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesforge.functions.quantiles import exact_quantiles
from salesforge.functions.semantics import numeric_columns, pct
from salesforge.operators.fingerprint import row_key

ANOMALY_COLUMNS = ["total_sales", "quantity", "unit_price"]


def iqr_bounds(df: DataFrame, columns: list[str], approx: bool = False
               ) -> dict[str, tuple[float | None, float | None]]:
    """1.5 x IQR fences per column (None when the column has no values); ``approx``
    uses one GK pass instead of exact quartiles."""
    qs = exact_quantiles(df, columns, [0.25, 0.75], approx=approx)
    out = {}
    for c in columns:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = (None, None)
        else:
            iqr = q3 - q1
            out[c] = (q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    return out


def zscore_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and sample standard deviation per column, one aggregate."""
    row = df.agg(*[x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def _flag(c: str, method: str, params: tuple) -> Column:
    x = F.col(c)
    if method == "iqr":
        lo, hi = params
        if lo is None:
            return F.lit(False)
        return F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))
    mean, std = params
    if mean is None or std is None:
        return F.lit(False)
    # abs((x - mean) / std) > 3; a zero deviation gives no outliers (pandas: inf/NaN).
    return F.coalesce(F.abs(F.try_divide(x - F.lit(mean), F.lit(std))) > F.lit(3.0), F.lit(False))


def _params(df: DataFrame, columns: list[str], method: str) -> dict:
    if method == "iqr":
        return iqr_bounds(df, columns)
    if method == "zscore":
        return zscore_stats(df, columns)
    raise ValueError(f"Unsupported outlier detection method: {method}")


def outlier_summary(df: DataFrame, columns: list[str] | None = None, method: str = "iqr") -> DataFrame:
    """OUT1/OUT2: per column with at least one outlier: count and percentage of all rows,
    with the bounds used (IQR fences, or mean/std for z-score)."""
    columns = columns or numeric_columns(df)
    params = _params(df, columns, method)
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(_flag(c, method, params[c])).alias(f"o{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"o{i}").alias("outlier_count"),
                     F.lit(params[c][0]).cast("double").alias("lower" if method == "iqr" else "mean"),
                     F.lit(params[c][1]).cast("double").alias("upper" if method == "iqr" else "std"))
            for i, c in enumerate(columns)]
    out = one.select("__n", F.explode(F.array(*rows)).alias("r")).select("__n", "r.*")
    return (out.where(F.col("outlier_count") > 0)
            .withColumn("outlier_percentage", pct("outlier_count", "__n")).drop("__n"))


def outlier_rows(df: DataFrame, columns: list[str] | None = None, method: str = "iqr", places: int | None = None) -> DataFrame:
    """The outlier rows themselves for OUT1/OUT2 (the reference lists row positions; a
    distributed table has none, so rows are returned with the offending column and
    ``row_key``, by which they can be joined back)."""
    columns = columns or numeric_columns(df)
    params = _params(df, columns, method)
    # explode + filter (not array_compact, a lambda function that leaves codegen)
    tags = F.array(*[F.when(_flag(c, method, params[c]), F.lit(c)) for c in columns])
    keyed = df.withColumn("row_key", row_key(df, places))
    return keyed.withColumn("outlier_column", F.explode(tags)).where(F.col("outlier_column").isNotNull())


def anomalies(df: DataFrame, method: str = "iqr") -> DataFrame:
    """OUT3/OUT4: rows outside the fences of total_sales, quantity or unit_price, tagged
    ``{column}_outlier`` (IQR) or ``{column}_zscore_outlier``; a row appears once per
    offending column.  An unknown method gives no rows."""
    cols = [c for c in ANOMALY_COLUMNS if c in df.columns]
    if method not in ("iqr", "zscore") or not cols:
        return df.withColumn("anomaly_type", F.lit(None).cast("string")).limit(0)
    params = _params(df, cols, method)
    suffix = "_outlier" if method == "iqr" else "_zscore_outlier"
    tags = F.array(*[F.when(_flag(c, method, params[c]), F.lit(c + suffix)) for c in cols])
    return df.withColumn("anomaly_type", F.explode(tags)).where(F.col("anomaly_type").isNotNull())


def anomaly_count(df: DataFrame, method: str = "iqr") -> DataFrame:
    """Number of anomaly rows (one-row frame, column ``n``) without materialising them."""
    cols = [c for c in ANOMALY_COLUMNS if c in df.columns]
    if method not in ("iqr", "zscore") or not cols:
        return df.sparkSession.createDataFrame([(0,)], "n long")
    params = _params(df, cols, method)
    hits = sum((_flag(c, method, params[c]).cast("long") for c in cols), F.lit(0).cast("long"))
    return df.agg(F.coalesce(F.sum(hits), F.lit(0).cast("long")).alias("n"))
