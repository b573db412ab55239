"""LEG1-LEG5: the legacy quality scorer (completeness, IQR outliers, business rules).

The comprehensive score runs the exact-quantile passes for the IQR fences and then one
aggregate for every count it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesforge.functions.semantics import NUMERIC_TYPES
from salesforge.operators.anomalies import _flag, iqr_bounds
from salesforge.operators.fingerprint import row_key

ALERT_THRESHOLD = 80.0


def _nonnull(df: DataFrame, c: str):
    t = df.schema[c].dataType
    x = F.nanvl(F.col(c), F.lit(None).cast("double")) if isinstance(t, NUMERIC_TYPES) else F.col(c)
    return F.count(x)


def completeness(df: DataFrame) -> DataFrame:
    """LEG1: per column: missing values and completeness %, with the row count."""
    one = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[_nonnull(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), (F.col("total_rows") - F.col(f"c{i}")).alias("missing_values"))
            for i, c in enumerate(df.columns)]
    out = one.select("total_rows", F.explode(F.array(*rows)).alias("r")).select("total_rows", "r.*")
    return out.withColumn("completeness_percentage",
                          (F.lit(1.0) - F.try_divide(F.col("missing_values").cast("double"),
                                                     F.col("total_rows").cast("double"))) * F.lit(100.0))


def _calc():
    return F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount"))


def business_rule_flags() -> dict[str, object]:
    """The three rules as row predicates (NULL counts as not violated).  The total check
    is relative; a zero total violates it only when the computed total is non-zero
    (pandas: x/0 = inf > 0.01), a negative total never does."""
    ts_, calc = F.col("total_sales"), _calc()
    rel = F.when(ts_ == 0, calc != 0).otherwise(F.try_divide(F.abs(ts_ - calc), ts_) > F.lit(0.01))
    # Rule names.
    return {"Positive Quantity": F.col("quantity") <= 0,
            "Total Sales Calculation": rel,
            "Discount Range": (F.col("discount") < 0) | (F.col("discount") > 1)}


def business_rules(df: DataFrame) -> DataFrame:
    """LEG2: (rule, invalid_records) for each violated rule, in rule order."""
    flags = business_rule_flags()
    one = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"b{i}") for i, p in enumerate(flags.values())])
    rows = [F.struct(F.lit(i + 1).cast("bigint").alias("rule_order"), F.lit(name).alias("rule"),
                     F.col(f"b{i}").alias("invalid_records")) for i, name in enumerate(flags)]
    return (one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .where(F.col("invalid_records") > 0))


def business_rule_rows(df: DataFrame, places: int | None = None) -> DataFrame:
    """LEG2 details: the violating rows with ``rule`` (a row once per rule it violates)
    and ``row_key`` (``fingerprint.row_key``), by which they can be joined back."""
    tags = F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in business_rule_flags().items()])
    keyed = df.withColumn("row_key", row_key(df, places))
    return keyed.withColumn("rule", F.explode(tags)).where(F.col("rule").isNotNull())


def business_rules_summary(df: DataFrame) -> DataFrame:
    """LEG2 totals: valid_records is every row; invalid_records sums over rules (a row
    violating two rules counts twice)."""
    flags = business_rule_flags()
    bad = sum((F.coalesce(p, F.lit(False)).cast("long") for p in flags.values()), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("valid_records"),
                  F.coalesce(F.sum(bad), F.lit(0).cast("long")).alias("invalid_records"))


def _counts(df: DataFrame, outlier_columns: list[str] | None) -> dict:
    """Everything the comprehensive check needs, from one aggregate after the fences."""
    numeric = [c for c in (outlier_columns or df.columns) if isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    fences = iqr_bounds(df, numeric)
    flags = business_rule_flags()
    r = df.agg(F.count(F.lit(1)).alias("n"),
               *[_nonnull(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)],
               *[F.count_if(_flag(c, "iqr", fences[c])).alias(f"o{i}") for i, c in enumerate(numeric)],
               *[F.count_if(F.coalesce(p, F.lit(False))).alias(f"b{i}") for i, p in enumerate(flags.values())]).first()
    n = r["n"]
    complete = {c: (1.0 - (n - r[f"c{i}"]) / n) * 100.0 if n else None for i, c in enumerate(df.columns)}
    outliers = {c: r[f"o{i}"] / n * 100.0 if n else 0.0 for i, c in enumerate(numeric)}
    violations = {name: r[f"b{i}"] for i, name in enumerate(flags)}
    comp = sum((100.0 - v for v in complete.values() if v is not None and v < 95), 0.0)
    outl, bad = sum(outliers.values(), 0.0), sum(violations.values())
    rules = bad / max(n, 1) * 100.0
    return {"n": n, "complete": complete, "outliers": outliers, "violations": violations, "comp": comp, "outl": outl,
            "rules": rules, "bad": bad, "score": max(0.0, min(100.0 - comp - outl - rules, 100.0))}


def comprehensive_report(df: DataFrame, outlier_columns: list[str] | None = None) -> DataFrame:
    """LEG4: the four parts of the check as rows (section, name, value): completeness %
    per column, outlier % per numeric column, violations per rule, the score."""
    x = _counts(df, outlier_columns)
    rows = [("completeness", c, v) for c, v in x["complete"].items()]
    rows += [("outliers", c, v) for c, v in x["outliers"].items()]
    rows += [("business_rules", c, float(v)) for c, v in x["violations"].items()]
    rows.append(("score", "data_quality_score", x["score"]))
    return df.sparkSession.createDataFrame(rows, "section string, name string, value double")


def quality_score(df: DataFrame, outlier_columns: list[str] | None = None) -> DataFrame:
    """LEG3/LEG4/LEG5: the comprehensive check as one row: completeness penalty, outlier
    percentage sum, business-rule penalty, the clamped score and the alert flag.

    After the IQR fences (exact quantiles), ONE aggregate counts everything: non-null
    cells per column, outliers per numeric column and business-rule violations."""
    x = _counts(df, outlier_columns)
    return df.sparkSession.createDataFrame(
        [(x["comp"], x["outl"], x["rules"], x["n"], x["bad"], x["score"], x["score"] < ALERT_THRESHOLD)],
        "completeness_penalty double, outlier_penalty double, business_rule_penalty double, "
        "valid_records bigint, invalid_records bigint, data_quality_score double, alert boolean")

