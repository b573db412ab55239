"""Null, NaN, rounding and division rules shared by every operator.

The behaviour being reproduced is that of a pandas table: NaN counts as missing, sums of
nothing are 0, ``round`` is half-to-even on the scaled binary value, ``x/0`` is not an
error, and ``std`` is the sample deviation.  Spark differs on each point, so the
operators use these helpers instead of the raw functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)
TEMPORAL_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def null_double() -> Column:
    return F.lit(None).cast("double")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(field_type(df, name), NUMERIC_TYPES)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns pandas would pick with ``select_dtypes(include=number)``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL so that sum/avg/comparisons skip it as pandas does."""
    return F.nanvl(col(c), null_double())


# How a number is written, and the date forms read besides ISO 8601.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DATE_FORMATS = ["MM/dd/yyyy", "dd MMM yyyy", "yyyy/MM/dd", "dd-MMM-yyyy", "MMM d, yyyy"]


def finite(c: str | Column) -> Column:
    """NaN and infinities become NULL: ranges, histograms and quantiles are over finite
    values only."""
    return F.when(F.abs(col(c)) < F.lit(float("inf")), col(c))


def number_text(c: str | Column) -> Column:
    """Text to double; what is not a plain decimal number is NULL (also '12d' and '12f',
    which a bare cast accepts, and spelled-out infinities and NaN, which would make
    every later mean and sum useless)."""
    t = F.trim(col(c))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def date_text(c: str | Column, formats: list[str] | None = None) -> Column:
    """Text to timestamp_ntz: ISO 8601 first, then ``formats`` in turn; NULL if none fits."""
    t = F.trim(col(c))
    others = [F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in (DATE_FORMATS if formats is None else formats)]
    return F.coalesce(t.try_cast("timestamp_ntz"), *others)


def num(df: DataFrame, name: str) -> Column:
    """``pd.to_numeric(errors='coerce')``: any column to double, bad values to NULL."""
    t = field_type(df, name)
    if isinstance(t, NUMERIC_TYPES):
        return nan_to_null(F.col(name).cast("double"))
    if isinstance(t, T.StringType):
        return number_text(name)
    return null_double()


def ts(df: DataFrame, name: str) -> Column:
    """``pd.to_datetime(errors='coerce')`` to timestamp_ntz; bad values to NULL."""
    t = field_type(df, name)
    if isinstance(t, T.TimestampNTZType):
        return F.col(name)
    if isinstance(t, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    if isinstance(t, T.StringType):
        return date_text(name)
    return F.lit(None).cast("timestamp_ntz")


# English weekday names, Sunday first (Spark's dayofweek: 1 = Sunday).
WEEKDAY_NAMES_SUNDAY_FIRST = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_name(c: str | Column) -> Column:
    """pandas ``day_name()``: an array lookup by ``dayofweek`` (much cheaper per row than
    formatting the date with a pattern)."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_NAMES_SUNDAY_FIRST]), F.dayofweek(col(c)))


def ts_lit(value) -> Column:
    """A timestamp_ntz literal from a datetime/date/ISO string, independent of the
    Python process' and the session's time zones."""
    if hasattr(value, "strftime"):
        fmt = "%Y-%m-%d %H:%M:%S.%f" if hasattr(value, "hour") else "%Y-%m-%d"
        value = value.strftime(fmt)
    return F.lit(str(value)).cast("timestamp_ntz")


def round_half_even(c: str | Column, dp: int = 2) -> Column:
    """numpy ``around``: scale, round half to even, unscale (``Column.round`` is half-up)."""
    scale = 10 ** dp
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def round_significant(c: str | Column, digits: int = 10) -> Column:
    """Round half-to-even to ``digits`` significant digits (scale by an exact power of
    ten, ``rint``, unscale); 0, NULL and NaN pass through."""
    c = col(c)
    e = F.floor(F.log10(F.abs(c)))
    shift = (F.lit(digits - 1) - e).cast("double")
    up = F.rint(c * F.pow(F.lit(10.0), shift)) / F.pow(F.lit(10.0), shift)
    down = F.rint(c / F.pow(F.lit(10.0), -shift)) * F.pow(F.lit(10.0), -shift)
    return (F.when(c.isNull() | F.isnan(c) | (c == 0), c)
            .when(shift >= 0, up).otherwise(down))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Division that yields NULL (not an error, not inf) for a zero or NULL divisor."""
    return F.try_divide(col(a), col(b))


def pct(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100`` in pandas operation order; NULL for an empty whole."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double")) * F.lit(100.0)


def sum0(c: str | Column) -> Column:
    """pandas ``Series.sum``: the sum of no values is 0, not NULL."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def pairwise_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over rows where both values are present.

    NULL instead of an error for constant input (Spark's ``corr`` divides by zero under
    ANSI mode); this matches pandas' NaN for a zero-variance column.
    """
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x)
    ys = F.when(both, y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))


def fmt_fixed(c: str | Column, dp: int) -> Column:
    """Python ``f'{x:.{dp}f}'``.  Java's formatter rounds half-up on the decimal
    digits, so the value is first rounded half-even on its binary value."""
    return F.format_string(f"%.{dp}f", round_half_even(c, dp))


def fmt_thousands(c: str | Column, dp: int = 2) -> Column:
    """Python ``f'{x:,.{dp}f}'``."""
    return F.format_number(round_half_even(c, dp), dp)


def first_token(c: str | Column) -> Column:
    """``name.split('_')[0]``."""
    return F.substring_index(col(c), "_", 1)
