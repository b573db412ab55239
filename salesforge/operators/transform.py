"""TRF1-TRF9: cleaning and derivation of sales rows.

Statistics that a later step depends on (the mean used for imputation, each column's
mean/std for the sequential three-sigma filter) are one-row aggregates: they are
computed, brought back as a bounded row and applied as literals, so every row filter is
a plain predicate that Parquet can even use for pushdown.  The three sigma passes are
inherently sequential (each column's statistics are computed on the rows that survived
the previous column) and are kept that way.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesforge.functions.semantics import (
    FRACTIONAL_TYPES, num, round_half_even, safe_div, ts, ts_lit,
)

SIGMA_COLUMNS = ["quantity", "unit_price", "total_sales"]


_UNSET = object()


def impute(df: DataFrame, mean_price=_UNSET) -> DataFrame:
    """TRF1: quantity NULL -> 0, unit_price NULL -> mean of the present prices,
    discount NULL -> 0; total_sales is left alone."""
    if mean_price is _UNSET:
        mean_price = df.agg(F.avg(num(df, "unit_price"))).first()[0]
    fills = {"quantity": F.coalesce(num(df, "quantity"), F.lit(0.0)),
             "discount": F.coalesce(num(df, "discount"), F.lit(0.0))}
    price = num(df, "unit_price")
    fills["unit_price"] = F.coalesce(price, F.lit(mean_price)) if mean_price is not None else price
    return df.withColumns(fills)


def sigma_filter(df: DataFrame, columns: list[str] | None = None, k: float = 3.0,
                 undefined_std: str = "drop", rel_tol: float = 1e-9,
                 first_stats: tuple[float | None, float | None] | None = None) -> DataFrame:
    """TRF2: for each column in turn keep ``abs(x - mean) <= k * std`` with mean and
    sample std of the rows still present.  NULL values fail the test; a single row has
    an undefined std, which drops everything (``undefined_std='drop'``, as the
    reference behaves) or keeps the step a no-op (``'keep'``).  ``first_stats`` lets a
    caller pass the first column's (mean, std) when it already computed them.

    ``rel_tol`` absorbs the last-bit error of a floating mean on a constant column
    (Spark's mean of a constant 0.1 is 0.1 + 2e-17 with std 0, which would drop every
    row where pandas keeps them all).
    """
    columns = columns or SIGMA_COLUMNS
    for i, c in enumerate(columns):
        x = num(df, c)
        if i == 0 and first_stats is not None:
            mean, std = first_stats
        else:
            row = df.agg(F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).first()
            mean, std = row["m"], row["s"]
        if mean is None or std is None:
            if undefined_std == "keep" and mean is not None:
                continue
            df = df.where(F.lit(False))
            continue
        bound = k * std + rel_tol * abs(mean)
        df = df.where(F.abs(x - F.lit(mean)) <= F.lit(bound))
    return df


def clean(df: DataFrame, **sigma_opts) -> DataFrame:
    """TRF1 then TRF2.  The imputation mean and the first column's statistics do not
    depend on each other (quantity is filled with 0, not a statistic), so they share
    one aggregate."""
    cols = sigma_opts.pop("columns", None) or SIGMA_COLUMNS
    if cols[0] == "quantity":
        q0 = F.coalesce(num(df, "quantity"), F.lit(0.0))
        r = df.agg(F.avg(num(df, "unit_price")).alias("p"), F.avg(q0).alias("m"),
                   F.stddev_samp(q0).alias("s")).first()
        return sigma_filter(impute(df, r["p"]), cols, first_stats=(r["m"], r["s"]), **sigma_opts)
    return sigma_filter(impute(df), cols, **sigma_opts)


def parse_dates(df: DataFrame, errors: str = "raise") -> DataFrame:
    """TRF3: ``date`` to timestamp.  ``raise`` fails the job on an unparseable value;
    ``coerce`` turns it into NULL."""
    parsed = ts(df, "date")
    if errors == "raise":
        bad = F.col("date").isNotNull() & parsed.isNull()
        parsed = F.when(bad, F.raise_error(F.concat(F.lit("unparseable date: "),
                                                    F.col("date").cast("string")))).otherwise(parsed)
    return df.withColumn("date", parsed)


def drop_future(df: DataFrame, as_of: datetime) -> DataFrame:
    """TRF4: keep rows dated on or before ``as_of`` (a missing date is dropped)."""
    return df.where(F.col("date") <= ts_lit(as_of))


def validate_dates(df: DataFrame, as_of: datetime, errors: str = "raise") -> DataFrame:
    """TRF3 then TRF4."""
    return drop_future(parse_dates(df, errors), as_of)


def calculate_metrics(df: DataFrame) -> DataFrame:
    """TRF5-TRF6: total_sales = q*p*(1-d) only when absent; gross_sales, discount_amount
    and profit_margin = (total - discount_amount) / gross (NULL for zero gross)."""
    q, p, d = F.col("quantity"), F.col("unit_price"), F.col("discount")
    if "total_sales" not in df.columns:
        df = df.withColumn("total_sales", q * p * (F.lit(1) - d))
    gross = q * p
    return df.withColumns({"gross_sales": gross, "discount_amount": gross * d}).withColumn(
        "profit_margin", safe_div(F.col("total_sales") - F.col("discount_amount"), F.col("gross_sales")))


def normalize_names(df: DataFrame) -> DataFrame:
    """TRF7: lower-case, trim, spaces to underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def round_numeric(df: DataFrame, dp: int = 2) -> DataFrame:
    """TRF8: every floating column rounded half-to-even (integral columns unchanged)."""
    return df.withColumns({f.name: round_half_even(F.col(f"`{f.name}`"), dp)
                           for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL_TYPES)})


def standardize_columns(df: DataFrame) -> DataFrame:
    """TRF7 then TRF8."""
    return round_numeric(normalize_names(df))


def transform(df: DataFrame, as_of: datetime, date_errors: str = "raise", **sigma_opts) -> DataFrame:
    """TRF9: clean -> validate dates -> derive metrics -> standardise."""
    df = clean(df, **sigma_opts)
    df = validate_dates(df, as_of, date_errors)
    df = calculate_metrics(df)
    return standardize_columns(df)
