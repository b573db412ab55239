"""Registrations for validation (VAL3, TYP2, EXP1), transformation (TRF9), load
metrics (AGG11) and the dataset fingerprint (FPR1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesforge.functions.schema import NUMERIC_SALES_COLUMNS
from salesforge.functions.semantics import number_text
from salesforge.operators import analytics as A
from salesforge.operators import fingerprint as FP
from salesforge.operators import queries as Q
from salesforge.operators import transform as T
from salesforge.operators import validate as V
from salesforge.plans.oracle import AS_OF_SQL, DATE, DIRTY_CTE, EXACT_ROW_KEY, NUM, ROW_KEY, SALES_CTE, TEXT_CTE, R, with_
from salesforge.plans.registry import register, stable
from salesforge.sources import fixtures as FX
from salesforge.sources import sinks as SK

# ---------------------------------------------------------------------------------------
# VAL3 (quarantine mode) on the dirty view
# ---------------------------------------------------------------------------------------
VALIDATE_CTES = """,
t AS (SELECT date, product_id, CAST(trunc(quantity) AS BIGINT) AS quantity, unit_price, discount, total_sales
      FROM sales_dirty WHERE quantity IS NOT NULL AND abs(quantity) < 9.2e18),
med AS (SELECT quantile_cont(unit_price, 0.5) AS mp, quantile_cont(discount, 0.5) AS md,
               quantile_cont(total_sales, 0.5) AS mt FROM t),
c AS (SELECT date, product_id, quantity, coalesce(unit_price, mp) AS unit_price,
             coalesce(discount, md) AS discount, coalesce(total_sales, mt) AS total_sales FROM t, med)
"""


@register("validated_sales", with_(DIRTY_CTE) + VALIDATE_CTES + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, {R('discount', 6)} AS discount,
       {R('total_sales', 6)} AS total_sales
FROM c WHERE quantity > 0 AND unit_price > 0""")
def _validated_sales(spark, sf_dir):
    return stable(V.validate_sales(FX.sales_dirty(spark, sf_dir), mode="quarantine").accepted, dp=6)


@register("rejected_sales", with_(DIRTY_CTE) + VALIDATE_CTES + f"""
SELECT date, product_id, CAST(NULL AS BIGINT) AS quantity, {R('unit_price', 6)} AS unit_price,
       {R('discount', 6)} AS discount, {R('total_sales', 6)} AS total_sales, 'quantity_not_int' AS reason
FROM sales_dirty WHERE NOT (quantity IS NOT NULL AND abs(quantity) < 9.2e18)
UNION ALL
SELECT date, product_id, quantity, {R('unit_price', 6)}, {R('discount', 6)}, {R('total_sales', 6)},
       CASE WHEN NOT coalesce(quantity > 0, false) THEN 'non_positive_quantity' ELSE 'non_positive_price' END
FROM c WHERE NOT coalesce(quantity > 0 AND unit_price > 0, false)""")
def _rejected_sales(spark, sf_dir):
    return stable(V.validate_sales(FX.sales_dirty(spark, sf_dir), mode="quarantine").rejected, dp=6)


@register("validation_summary", with_(DIRTY_CTE) + VALIDATE_CTES + """,
acc AS (SELECT * FROM c WHERE quantity > 0 AND unit_price > 0)
SELECT (SELECT count(*) FROM sales_dirty) AS input_rows, count(*) AS accepted_rows,
       (SELECT count(*) FROM sales_dirty) - count(*) AS rejected_rows,
       count(*) FILTER (WHERE NOT coalesce(
           CASE WHEN total_sales = 0 THEN NULL
                ELSE abs(total_sales - quantity * unit_price * (1 - discount)) / total_sales END <= 0.01,
           false)) AS total_discrepancies
FROM acc""")
def _validation_summary(spark, sf_dir):
    return stable(V.validate_sales(FX.sales_dirty(spark, sf_dir), mode="quarantine").summary)


@register("numeric_coercion", with_(TEXT_CTE) + f""",
v AS (SELECT date, product_id, {NUM('quantity')} AS quantity, {NUM('unit_price')} AS unit_price,
             {NUM('discount')} AS discount, {NUM('total_sales')} AS total_sales FROM sales_text),
med AS (SELECT quantile_cont(quantity, 0.5) AS mq, quantile_cont(unit_price, 0.5) AS mp,
               quantile_cont(discount, 0.5) AS md, quantile_cont(total_sales, 0.5) AS mt FROM v)
SELECT date, product_id, {R('coalesce(quantity, mq)', 6)} AS quantity, {R('coalesce(unit_price, mp)', 6)} AS unit_price,
       {R('coalesce(discount, md)', 6)} AS discount, {R('coalesce(total_sales, mt)', 6)} AS total_sales
FROM v, med""")
def _numeric_coercion(spark, sf_dir):
    return stable(V.clean_numeric_columns(FX.sales_text(spark, sf_dir), NUMERIC_SALES_COLUMNS, "median"), dp=6)


# ---------------------------------------------------------------------------------------
# EXP1
# ---------------------------------------------------------------------------------------
def _exp_sql(src: str = "sales") -> str:
    ints = "('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT')"
    rows = [
        (1, "expect_column_to_exist", "date", "typeof(max(date)) IS NOT NULL", "NULL"),
        (2, "expect_column_to_exist", "product_id", "typeof(max(product_id)) IS NOT NULL", "NULL"),
        (3, "expect_column_to_exist", "quantity", "typeof(max(quantity)) IS NOT NULL", "NULL"),
        (4, "expect_column_to_exist", "unit_price", "typeof(max(unit_price)) IS NOT NULL", "NULL"),
        (5, "expect_column_values_to_be_of_type", "date",
         "typeof(max(date)) IN ('TIMESTAMP', 'DATE', 'TIMESTAMP WITH TIME ZONE')", "NULL"),
        (6, "expect_column_values_to_be_of_type", "product_id", "typeof(max(product_id)) = 'VARCHAR'", "NULL"),
        (7, "expect_column_values_to_be_of_type", "quantity", f"typeof(max(quantity)) IN {ints}", "NULL"),
        (8, "expect_column_values_to_be_of_type", "unit_price", "typeof(max(unit_price)) IN ('DOUBLE', 'FLOAT')",
         "NULL"),
    ]
    counted = [
        (9, "expect_column_values_to_be_between", "quantity",
         "count(*) FILTER (WHERE quantity IS NOT NULL AND (quantity < 0 OR quantity > 10000))"),
        (10, "expect_column_values_to_be_between", "unit_price",
         "count(*) FILTER (WHERE unit_price IS NOT NULL AND (unit_price < 0 OR unit_price > 100000))"),
        (11, "expect_column_values_to_not_be_null", "product_id", "count(*) FILTER (WHERE product_id IS NULL)"),
        (12, "expect_column_values_to_not_be_null", "date", "count(*) FILTER (WHERE date IS NULL)"),
        (13, "expect_column_values_to_match_regex", "product_id",
         "count(*) FILTER (WHERE product_id IS NOT NULL AND NOT regexp_matches(product_id, '^P\\d{3}$'))"),
        (14, "expect_column_values_to_be_between", "discount",
         "count(*) FILTER (WHERE discount IS NOT NULL AND (discount < 0 OR discount > 1))"),
    ]
    parts = [f"SELECT CAST({o} AS BIGINT) AS check_order, '{n}' AS \"check\", '{c}' AS \"column\", {p} AS passed, "
             f"CAST({u} AS BIGINT) AS unexpected_count FROM {src}" for o, n, c, p, u in rows]
    parts += [f"SELECT CAST({o} AS BIGINT), '{n}', '{c}', ({e}) = 0, CAST({e} AS BIGINT) FROM {src}"
              for o, n, c, e in counted]
    return "\nUNION ALL\n".join(parts)


EXP_SQL = _exp_sql()


@register("expectation_suite", with_(SALES_CTE) + EXP_SQL)
def _expectation_suite(spark, sf_dir):
    return stable(V.expectation_suite(FX.sales(spark, sf_dir)))


@register("expectation_summary", with_(SALES_CTE) + f"""
SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
       {R('CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) * 100')} AS quality_score
FROM ({EXP_SQL})""")
def _expectation_summary(spark, sf_dir):
    return stable(V.expectation_summary(FX.sales(spark, sf_dir)))


# ---------------------------------------------------------------------------------------
# TRF9 on the dirty view
# ---------------------------------------------------------------------------------------
def _sigma(src: str, col: str, n: int) -> str:
    return (f"s{n} AS (SELECT avg({col}) AS m, stddev_samp({col}) AS s FROM {src}),\n"
            f"f{n} AS (SELECT {src}.* FROM {src}, s{n} "
            f"WHERE abs({col} - m) <= 3 * s + 1e-9 * abs(m))")


TRANSFORM_CTES = f""",
i AS (SELECT date, product_id, coalesce(quantity, 0.0) AS quantity,
             coalesce(unit_price, (SELECT avg(unit_price) FROM sales_dirty)) AS unit_price,
             coalesce(discount, 0.0) AS discount, total_sales FROM sales_dirty),
{_sigma('i', 'quantity', 1)},
{_sigma('f1', 'unit_price', 2)},
{_sigma('f2', 'total_sales', 3)},
d AS (SELECT * FROM f3 WHERE date <= {AS_OF_SQL}),
m AS (SELECT *, quantity * unit_price AS gross_sales, quantity * unit_price * discount AS discount_amount FROM d),
transformed AS (
  SELECT date, product_id, {R('quantity', 2)} AS quantity, {R('unit_price', 2)} AS unit_price,
         {R('discount', 2)} AS discount, {R('total_sales', 2)} AS total_sales,
         {R('gross_sales', 2)} AS gross_sales, {R('discount_amount', 2)} AS discount_amount,
         {R('CASE WHEN gross_sales = 0 THEN NULL ELSE (total_sales - discount_amount) / gross_sales END', 2)}
           AS profit_margin
  FROM m)
"""


def _transformed(spark, sf_dir):
    return T.transform(FX.sales_dirty(spark, sf_dir), FX.AS_OF)


@register("transformed_sales", with_(DIRTY_CTE) + TRANSFORM_CTES + f"""
SELECT date, product_id, {R('quantity', 6)} AS quantity, {R('unit_price', 6)} AS unit_price, {R('discount', 6)} AS discount,
       {R('total_sales', 6)} AS total_sales, {R('gross_sales', 6)} AS gross_sales,
       {R('discount_amount', 6)} AS discount_amount, {R('profit_margin', 6)} AS profit_margin
FROM transformed""")
def _transformed_sales(spark, sf_dir):
    return stable(_transformed(spark, sf_dir), dp=6)


@register("load_metrics", with_(DIRTY_CTE) + TRANSFORM_CTES + f""",
daily AS (SELECT date, count(*) AS total_records, sum(quantity) AS total_quantity,
                 sum(total_sales) AS total_revenue FROM transformed GROUP BY date)
SELECT (SELECT count(*) FROM transformed) AS records_processed,
       {R('(SELECT coalesce(sum(total_sales), 0) FROM transformed)', 4)} AS total_sales,
       (SELECT count(DISTINCT product_id) FROM transformed) AS unique_products,
       {R('coalesce(sum(total_revenue), 0)', 4)} AS daily_total_revenue,
       {R('coalesce(sum(total_quantity), 0)', 4)} AS daily_total_quantity, count(*) AS days_of_sales
FROM daily""")
def _load_metrics(spark, sf_dir):
    t = _transformed(spark, sf_dir)
    return stable(A.load_metrics(t, Q.sales_by_date(t)),
                  sums=("total_sales", "daily_total_revenue", "daily_total_quantity"))


@register("dataset_fingerprint", with_(DIRTY_CTE) + f"""
SELECT count(*) AS rows, CAST(coalesce(sum(CAST(('0x' || substr({EXACT_ROW_KEY}, 1, 15)) AS HUGEINT)), 0) AS VARCHAR) AS fingerprint
FROM sales_dirty""")
def _dataset_fingerprint(spark, sf_dir):
    return FP.fingerprint(FX.sales_dirty(spark, sf_dir), portable=True)


# ---------------------------------------------------------------------------------------
# SCH2-SCH3 as a report, TRF3, and the stored projection with its rejects (SNK2)
# ---------------------------------------------------------------------------------------
@register("gate_report", with_(TEXT_CTE) + f""",
r AS (SELECT 1 AS check_order, 'type' AS "check", 'quantity' AS "column", count(*) FILTER (WHERE quantity IS NOT NULL AND {NUM('quantity')} IS NULL) AS failing FROM sales_text
UNION ALL SELECT 2, 'type', 'unit_price', count(*) FILTER (WHERE unit_price IS NOT NULL AND {NUM('unit_price')} IS NULL) FROM sales_text
UNION ALL SELECT 3, 'type', 'date', count(*) FILTER (WHERE date IS NOT NULL AND {DATE('date')} IS NULL) FROM sales_text
UNION ALL SELECT 4, 'range', 'quantity', count(*) FILTER (WHERE {NUM('quantity')} < 0 OR {NUM('quantity')} > 1000) FROM sales_text
UNION ALL SELECT 5, 'range', 'unit_price', count(*) FILTER (WHERE {NUM('unit_price')} < 0 OR {NUM('unit_price')} > 10000) FROM sales_text)
SELECT CAST(check_order AS BIGINT) AS check_order, "check", "column", failing, failing = 0 AS passed FROM r""")
def _gate_report(spark, sf_dir):
    return stable(V.gate_report(FX.sales_text(spark, sf_dir)))


@register("parsed_dates", with_(TEXT_CTE) + f"""
SELECT {DATE('date')} AS date, product_id, count(*) AS n FROM sales_text GROUP BY 1, 2""")
def _parsed_dates(spark, sf_dir):
    parsed = T.parse_dates(FX.sales_text(spark, sf_dir), "coerce")
    return stable(parsed.groupBy("date", "product_id").count().withColumnRenamed("count", "n"))


RECORDS_CTES = f""",
typed AS (SELECT *, CAST({DATE('date')} AS DATE) AS d, TRY_CAST(replace(product_id, 'P', '') AS INTEGER) AS p,
                 CASE WHEN abs({NUM('quantity')}) < 2147483648.0 THEN CAST(trunc({NUM('quantity')}) AS INTEGER) END AS q,
                 {NUM('unit_price')} AS u, {NUM('discount')} AS s, {NUM('total_sales')} AS t FROM sales_text),
tagged AS (SELECT *, CASE WHEN d IS NULL THEN 'date_invalid' WHEN p IS NULL THEN 'product_id_invalid' WHEN q IS NULL THEN 'quantity_invalid'
                          WHEN u IS NULL THEN 'unit_price_invalid' WHEN t IS NULL THEN 'total_sales_invalid'
                          WHEN discount IS NOT NULL AND s IS NULL THEN 'discount_invalid' END AS reason FROM typed)
"""


@register("sales_records", with_(TEXT_CTE) + RECORDS_CTES + f"""
SELECT d AS date, CAST(p AS BIGINT) AS product_id, CAST(q AS BIGINT) AS quantity, {R('u', 6)} AS unit_price,
       {R('coalesce(s, 0)', 6)} AS discount, {R('t', 6)} AS total_sales FROM tagged WHERE reason IS NULL""")
def _sales_records(spark, sf_dir):
    records, _ = SK.to_sales_records(FX.sales_text(spark, sf_dir))
    return stable(records.drop("created_at"), dp=6)


@register("sales_record_rejects", with_(TEXT_CTE) + RECORDS_CTES + f"""
SELECT date, product_id, quantity, {R(NUM('unit_price'))} AS unit_price, CASE WHEN u IS NULL THEN unit_price END AS unit_price_text,
       {R('TRY_CAST(discount AS DOUBLE)')} AS discount, {R('TRY_CAST(total_sales AS DOUBLE)')} AS total_sales, reason
FROM tagged WHERE reason IS NOT NULL""")
def _sales_record_rejects(spark, sf_dir):
    # All rejects; a price that is no finite number is compared as the text it came as.
    _, rejects = SK.to_sales_records(FX.sales_text(spark, sf_dir))
    price = number_text("unit_price")
    rejects = rejects.select("date", "product_id", "quantity", price.alias("unit_price"), F.when(price.isNull(), F.col("unit_price")).alias("unit_price_text"),
                             *[F.col(c).try_cast("double").alias(c) for c in ("discount", "total_sales")], "reason")
    return stable(rejects)


# ---------------------------------------------------------------------------------------
# TRF5 (totals that are absent) and TRF7 (names that need normalising)
# ---------------------------------------------------------------------------------------
@register("computed_totals", with_(SALES_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount,
       {R('quantity * unit_price * (1 - discount)', 6)} AS total_sales, {R('quantity * unit_price', 6)} AS gross_sales
FROM sales""")
def _computed_totals(spark, sf_dir):
    out = T.calculate_metrics(FX.sales(spark, sf_dir).drop("total_sales"))
    return stable(out.drop("discount_amount", "profit_margin"), dp=6)


@register("normalized_names", with_(DIRTY_CTE) + f"""
SELECT date, product_id, {R(R('quantity', 2), 6)} AS quantity, {R(R('unit_price', 2), 6)} AS unit_price,
       {R(R('discount', 2), 6)} AS discount, {R(R('total_sales', 2), 6)} AS total_sales FROM sales_dirty""")
def _normalized_names(spark, sf_dir):
    raw = FX.sales_dirty(spark, sf_dir).toDF("Date ", " PRODUCT ID", "Quantity", "Unit Price", "DISCOUNT", "Total Sales")
    return stable(T.standardize_columns(raw), dp=6)
