"""SCH1-SCH3 gates, TYP1-TYP2 typing, VAL1-VAL3 sales validation and the EXP1
expectation suite.

Gates are eager by nature (they decide whether a run continues), but every gate over
the data is a single aggregate pass that counts all failing values of all columns at
once.  Validation can either raise on the first bad cast (``mode="raise"``, as the
reference does) or split the rows into accepted and rejected frames with a reason
(``mode="quarantine"``), which is what a job over billions of rows needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesforge.errors import PipelineError
from salesforge.functions.quantiles import exact_quantiles
from salesforge.functions.schema import NUMERIC_SALES_COLUMNS, VALIDATION_REQUIRED, ValidationConfig
from salesforge.functions.semantics import (
    FRACTIONAL_TYPES, INTEGRAL_TYPES, NUMERIC_TYPES, TEMPORAL_TYPES, num, safe_div, ts,
)


# ---------------------------------------------------------------------------------------
# SCH1-SCH3
# ---------------------------------------------------------------------------------------
def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str], error_code: str | None = None) -> DataFrame:
    """SCH1: fail when a required column is absent (schema only, no job)."""
    miss = missing_columns(df, required)
    if miss:
        msg = f"Missing required columns: {miss}"
        if error_code:
            raise PipelineError(msg, error_code, {"columns": miss})
        raise ValueError(msg)
    return df


def _unparseable(df: DataFrame, c: str, kind: str) -> Column:
    """Non-null values that do not parse as ``kind`` ('numeric' or 'datetime')."""
    parsed = num(df, c) if kind == "numeric" else ts(df, c)
    raw = F.col(c)
    bad = raw.isNotNull() & parsed.isNull()
    if isinstance(df.schema[c].dataType, FRACTIONAL_TYPES):
        bad = F.lit(False)  # NaN is a valid (missing) number
    return bad


def gate_report(df: DataFrame, config: ValidationConfig | None = None) -> DataFrame:
    """SCH2-SCH3 as rows (check_order, check, column, failing, passed), one pass."""
    config = config or ValidationConfig()
    checks = [("type", c, _unparseable(df, c, k)) for c, k in config.type_checks.items() if c in df.columns]
    checks += [("range", c, (num(df, c) < F.lit(lo)) | (num(df, c) > F.lit(hi)))
               for c, (lo, hi) in config.range_checks.items() if c in df.columns]
    one = df.agg(F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("check_order"), F.lit(kind).alias("check"),
                                    F.lit(c).alias("column"), F.count_if(bad).alias("failing"))
                           for i, (kind, c, bad) in enumerate(checks)]).alias("r"))
    rows = one.select(F.explode("r").alias("r")).select("r.*")
    return rows.withColumn("passed", F.col("failing") == 0)


def gate(df: DataFrame, config: ValidationConfig | None = None) -> DataFrame:
    """The error texts.  SCH1-SCH3 in one pass: required columns, strict type parse, inclusive ranges
    (NULL passes).  Raises ``ValueError`` naming the first failing column."""
    config = config or ValidationConfig()
    require_columns(df, config.required_columns)
    type_checks = {c: k for c, k in config.type_checks.items() if c in df.columns}
    range_checks = {c: r for c, r in config.range_checks.items() if c in df.columns}
    if not type_checks and not range_checks:
        return df
    aggs = [F.count_if(_unparseable(df, c, k)).alias(f"t_{c}") for c, k in type_checks.items()]
    aggs += [F.count_if((num(df, c) < F.lit(lo)) | (num(df, c) > F.lit(hi))).alias(f"r_{c}")
             for c, (lo, hi) in range_checks.items()]
    row = df.agg(*aggs).first()
    for c, k in type_checks.items():
        if row[f"t_{c}"]:
            raise ValueError(f"Invalid type for column {c}. Expected {k}")
    for c, (lo, hi) in range_checks.items():
        if row[f"r_{c}"]:
            raise ValueError(f"Values in {c} must be between {lo} and {hi}")
    return df


# ---------------------------------------------------------------------------------------
# TYP1 / TYP2
# ---------------------------------------------------------------------------------------
# The validator's column types.
SALES_TYPE_CHECKS = {"product_id": "str", "quantity": "int", "unit_price": "float",
                     "discount": "float", "total_sales": "float"}


def _cast(df: DataFrame, c: str, kind: str) -> tuple[Column, Column]:
    """(cast value, failure flag) for one column; ``int`` truncates toward zero and
    rejects NULL/NaN/inf like ``astype(int)``; ``float`` rejects unparseable text."""
    t = df.schema[c].dataType
    if kind == "str":
        return F.col(c).cast("string"), F.lit(False)
    if kind == "float":
        v = num(df, c)
        return v, (F.col(c).isNotNull() & v.isNull()) if not isinstance(t, NUMERIC_TYPES) else F.lit(False)
    if kind == "int":
        v = num(df, c)
        finite = v.isNotNull() & (F.abs(v) < F.lit(9.2e18))  # also excludes inf
        return F.when(finite, v.cast("bigint")), ~finite
    raise ValueError(f"unknown type {kind}")


def cast_types(df: DataFrame, type_checks: dict[str, str] | None = None,
               mode: str = "raise") -> tuple[DataFrame, DataFrame | None]:
    """TYP1.  ``raise``: one counting pass, then fail naming the first bad column
    (VALIDATION_002).  ``quarantine``: (cast rows, rejected rows with ``reason``)."""
    type_checks = type_checks or SALES_TYPE_CHECKS
    casts = {c: _cast(df, c, k) for c, k in type_checks.items() if c in df.columns}
    if mode == "raise":
        row = df.agg(*[F.count_if(bad).alias(c) for c, (_, bad) in casts.items()]).first()
        for c, (_, _bad) in casts.items():
            if row[c]:
                raise PipelineError(f"Type validation failed for column {c}: {row[c]} values cannot be "
                                    f"converted to {type_checks[c]}", "VALIDATION_002",
                                    {"column": c, "expected_type": type_checks[c]})
        return df.withColumns({c: v for c, (v, _) in casts.items()}), None
    reason = F.coalesce(*[F.when(bad, F.lit(f"{c}_not_{type_checks[c]}")) for c, (_, bad) in casts.items()],
                        F.lit(None).cast("string"))
    tagged = df.withColumn("reason", reason)
    bad_rows = tagged.where(F.col("reason").isNotNull())
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    return good.withColumns({c: _cast(good, c, k)[0] for c, k in type_checks.items() if c in good.columns}), bad_rows


def impute_values(df: DataFrame, columns: list[str], strategy: str = "median") -> dict[str, float]:
    """Replacement value per column: exact median, approximate median
    (``approx_median``, one pass), mean, or 0 for any other strategy."""
    if strategy in ("median", "approx_median"):
        qs = exact_quantiles(df, columns, [0.5], approx=strategy == "approx_median")
        return {c: qs[c][0] for c in columns}
    if strategy == "mean":
        row = df.agg(*[F.avg(num(df, c)).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    return {c: 0.0 for c in columns}


def clean_numeric_columns(df: DataFrame, columns: list[str], strategy: str = "median") -> DataFrame:
    """TYP2: coerce to double (bad -> NULL), then fill NULLs with the column's median /
    mean / 0.  Integral columns keep their type (the fill value is cast)."""
    fills = impute_values(df, columns, strategy)
    out = {}
    for c in columns:
        t = df.schema[c].dataType
        v = num(df, c)
        if fills[c] is not None:
            v = F.coalesce(v, F.lit(fills[c]))
        out[c] = v.cast(t) if isinstance(t, INTEGRAL_TYPES) else v
    return df.withColumns(out)


# ---------------------------------------------------------------------------------------
# VAL1-VAL3
# ---------------------------------------------------------------------------------------
def positive_filter(df: DataFrame) -> DataFrame:
    """VAL1: keep ``quantity > 0 AND unit_price > 0``."""
    return df.where((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def relative_total_ok(tolerance: float = 0.01) -> Column:
    """VAL2 flag: ``abs(ts - q*p*(1-d)) / ts <= tol``; a zero or missing total is not
    consistent, a negative total always is (its ratio is negative)."""
    calc = F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount"))
    ratio = safe_div(F.abs(F.col("total_sales") - calc), F.col("total_sales"))
    return F.coalesce(ratio <= F.lit(tolerance), F.lit(False))


@dataclass
class ValidationResult:
    accepted: DataFrame
    rejected: DataFrame | None
    summary: DataFrame


def validate_sales(df: DataFrame, mode: str = "raise", strategy: str = "median",
                   tolerance: float = 0.01) -> ValidationResult:
    """VAL3: SCH1 -> TYP1 -> TYP2 -> VAL1, with VAL2 counted (nothing dropped for it).

    All three outputs derive from one staged frame that carries each row's typed values,
    its imputed values and its rejection reason, so accepted + rejected = input by
    construction.  ``summary`` is one row: input_rows, accepted_rows, rejected_rows,
    total_discrepancies (accepted rows failing the relative total check).
    """
    require_columns(df, VALIDATION_REQUIRED, "VALIDATION_001")
    if mode == "raise":
        cast_types(df, SALES_TYPE_CHECKS, "raise")  # one counting pass; raises on a bad cast
    casts = {c: _cast(df, c, k) for c, k in SALES_TYPE_CHECKS.items()}
    reason = F.coalesce(*[F.when(bad, F.lit(f"{c}_not_{SALES_TYPE_CHECKS[c]}")) for c, (_, bad) in casts.items()],
                        F.lit(None).cast("string"))
    typed = df.select(*[(casts[c][0] if c in casts else F.col(c)).alias(c) for c in VALIDATION_REQUIRED],
                      reason.alias("reason"))
    fills = impute_values(typed.where(F.col("reason").isNull()), NUMERIC_SALES_COLUMNS, strategy)
    clean = {}
    for c in NUMERIC_SALES_COLUMNS:
        v = F.col(c) if fills[c] is None else F.coalesce(F.col(c), F.lit(fills[c]))
        clean[f"{c}__clean"] = v.cast(typed.schema[c].dataType)
    staged = typed.withColumns(clean).withColumn(
        "ok", F.col("reason").isNull() & F.coalesce((F.col("quantity__clean") > 0) & (F.col("unit_price__clean") > 0),
                                                   F.lit(False)))

    def cleaned(c: str):
        return F.col(f"{c}__clean").alias(c) if c in NUMERIC_SALES_COLUMNS else F.col(c)

    accepted = staged.where("ok").select(*[cleaned(c) for c in VALIDATION_REQUIRED])
    rejected = None
    if mode == "quarantine":
        why = F.coalesce(F.col("reason"),
                         F.when(~F.coalesce(F.col("quantity__clean") > 0, F.lit(False)), F.lit("non_positive_quantity"))
                         .otherwise(F.lit("non_positive_price")))
        # a row that failed typing keeps its raw (typed) values; a non-positive row its cleaned ones
        vals = [F.when(F.col("reason").isNull(), F.col(f"{c}__clean")).otherwise(F.col(c)).alias(c)
                if c in NUMERIC_SALES_COLUMNS else F.col(c) for c in VALIDATION_REQUIRED]
        rejected = staged.where(~F.col("ok")).select(*vals, why.alias("reason"))
    q, p, d, t = (F.col(f"{c}__clean") for c in NUMERIC_SALES_COLUMNS)
    ratio = safe_div(F.abs(t - q * p * (F.lit(1) - d)), t)
    consistent = F.coalesce(ratio <= F.lit(tolerance), F.lit(False))
    summary = staged.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if("ok").alias("accepted_rows"),
                         F.count_if(F.col("ok") & ~consistent).alias("total_discrepancies"))
    summary = summary.select("input_rows", "accepted_rows",
                             (F.col("input_rows") - F.col("accepted_rows")).alias("rejected_rows"),
                             "total_discrepancies")
    return ValidationResult(accepted, rejected, summary)


# ---------------------------------------------------------------------------------------
# EXP1: expectation suite
# ---------------------------------------------------------------------------------------
# The suite's columns, types and ranges.
EXPECT_EXIST = ["date", "product_id", "quantity", "unit_price"]
EXPECT_TYPES = {"date": "datetime64", "product_id": "object", "quantity": "int64", "unit_price": "float64"}
EXPECT_RANGES = [("quantity", 0, 10000), ("unit_price", 0, 100000)]
EXPECT_NOT_NULL = ["product_id", "date"]
EXPECT_REGEX = ("product_id", r"^P\d{3}$")
EXPECT_DISCOUNT = ("discount", 0, 1)


def _type_matches(t: T.DataType, expected: str) -> bool:
    return {"datetime64": isinstance(t, TEMPORAL_TYPES),
            "object": isinstance(t, T.StringType),
            "int64": isinstance(t, INTEGRAL_TYPES),
            "float64": isinstance(t, FRACTIONAL_TYPES)}[expected]


def expectation_suite(df: DataFrame) -> DataFrame:
    """EXP1: the 14 checks as rows (check, column, passed, unexpected_count).
    Existence/type checks read the schema; the value checks share one aggregate.  A
    value check on an absent column fails."""
    cols = set(df.columns)
    checks: list[tuple[str, str, Column | bool]] = []
    for c in EXPECT_EXIST:
        checks.append(("expect_column_to_exist", c, c in cols))
    for c, t in EXPECT_TYPES.items():
        checks.append(("expect_column_values_to_be_of_type", c,
                       c in cols and _type_matches(df.schema[c].dataType, t)))
    aggs = {}
    for c, lo, hi in EXPECT_RANGES + [EXPECT_DISCOUNT]:
        if c in cols:
            v = num(df, c)
            aggs[f"between_{c}"] = F.count_if(v.isNotNull() & ((v < lo) | (v > hi)))
    for c in EXPECT_NOT_NULL:
        if c in cols:
            aggs[f"notnull_{c}"] = F.count_if(F.col(c).isNull())
    rc, pattern = EXPECT_REGEX
    if rc in cols:
        aggs[f"regex_{rc}"] = F.count_if(F.col(rc).isNotNull() & ~F.col(rc).cast("string").rlike(pattern))

    def value_check(name: str, c: str, key: str):
        checks.append((name, c, key if key in aggs else False))

    for c, _, _ in EXPECT_RANGES:
        value_check("expect_column_values_to_be_between", c, f"between_{c}")
    for c in EXPECT_NOT_NULL:
        value_check("expect_column_values_to_not_be_null", c, f"notnull_{c}")
    value_check("expect_column_values_to_match_regex", rc, f"regex_{rc}")
    value_check("expect_column_values_to_be_between", EXPECT_DISCOUNT[0], f"between_{EXPECT_DISCOUNT[0]}")

    one = df.agg(*[v.alias(k) for k, v in aggs.items()]) if aggs else df.sparkSession.range(1)
    rows = []
    for i, (name, c, res) in enumerate(checks):
        if isinstance(res, str):
            cnt = F.col(res)
            passed = cnt == 0
        else:
            cnt = F.lit(None).cast("bigint")
            passed = F.lit(bool(res))
        rows.append(F.struct(F.lit(i + 1).cast("bigint").alias("check_order"), F.lit(name).alias("check"),
                             F.lit(c).alias("column"), passed.alias("passed"), cnt.alias("unexpected_count")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def expectation_summary(df: DataFrame) -> DataFrame:
    """EXP1 score: passed / 14 x 100, with the counts."""
    s = expectation_suite(df)
    return s.agg(F.count(F.lit(1)).alias("total_checks"),
                 F.count_if("passed").alias("passed_checks")).withColumn(
        "quality_score", F.col("passed_checks") / F.col("total_checks") * F.lit(100.0))
