"""Parameterised variants: filtered query shapes, individual transform steps, other views."""

from __future__ import annotations

from salesforge.operators import analytics as A
from salesforge.operators import anomalies as O
from salesforge.operators import queries as Q
from salesforge.operators import quality as DQ
from salesforge.operators import rules as RU
from salesforge.operators import transform as T
from salesforge.operators import validate as V
from salesforge.plans.catalog.analytics import _iqr_cte, _trend_sql
from salesforge.plans.catalog.etl import TRANSFORM_CTES, _exp_sql
from salesforge.plans.catalog.quality import _issues_sql, _metrics_sql, _rules_sql
from salesforge.plans.oracle import DIRTY_CTE, ROW_KEY, SALES_CTE, TEXT_CTE, R, with_
from salesforge.plans.registry import register, stable
from salesforge.sources import fixtures as FX

START, END = "1998-01-01", "1998-12-31"
RANGE_SQL = f"date >= TIMESTAMP '{START}' AND date <= TIMESTAMP '{END}'"
PRODUCT = "P100"


@register("sales_page_product", with_(SALES_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, {R('total_sales', 6)} AS total_sales
FROM sales WHERE product_id = '{PRODUCT}'
ORDER BY date DESC NULLS LAST, product_id NULLS LAST, quantity NULLS LAST, unit_price NULLS LAST,
         discount NULLS LAST, total_sales NULLS LAST
LIMIT 50""")
def _sales_page_product(spark, sf_dir):
    return stable(Q.sales_page(FX.sales(spark, sf_dir), product_id=PRODUCT, limit=50), dp=6)


@register("sales_summary_1998", with_(SALES_CTE) + f"""
SELECT count(*) AS total_records, sum(quantity) AS total_quantity, {R('sum(total_sales)', 4)} AS total_revenue,
       {R('avg(unit_price)')} AS avg_unit_price, count(DISTINCT product_id) AS unique_products,
       count(DISTINCT date) AS unique_dates
FROM sales WHERE {RANGE_SQL}""")
def _sales_summary_1998(spark, sf_dir):
    return stable(Q.sales_summary(FX.sales(spark, sf_dir), START, END), sums=("total_revenue",))


@register("sales_by_product_1998", with_(SALES_CTE) + f"""
SELECT product_id, count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       {R('avg(discount)')} AS avg_discount
FROM sales WHERE {RANGE_SQL} GROUP BY product_id""")
def _sales_by_product_1998(spark, sf_dir):
    return stable(Q.sales_by_product(FX.sales(spark, sf_dir), START, END), sums=("total_revenue",))


@register("sales_by_date_1998", with_(SALES_CTE) + f"""
SELECT date, count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       count(DISTINCT product_id) AS unique_products
FROM sales WHERE {RANGE_SQL} GROUP BY date""")
def _sales_by_date_1998(spark, sf_dir):
    return stable(Q.sales_by_date(FX.sales(spark, sf_dir), START, END), sums=("total_revenue",))


@register("revenue_trends_year", _trend_sql("CAST(year(date) AS VARCHAR)", "year(date)"))
def _revenue_trends_year(spark, sf_dir):
    return stable(A.revenue_trends(FX.sales(spark, sf_dir), "year"), sums=("current_value", "previous_value"))


# ---------------------------------------------------------------------------------------
# Transform steps on the dirty view
# ---------------------------------------------------------------------------------------
@register("sigma_filtered_sales", with_(DIRTY_CTE) + TRANSFORM_CTES + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, {R('total_sales', 6)} AS total_sales
FROM f3""")
def _sigma_filtered_sales(spark, sf_dir):
    return stable(T.clean(FX.sales_dirty(spark, sf_dir)), dp=6)


@register("derived_metrics", with_(SALES_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, {R('total_sales', 6)} AS total_sales,
       {R('quantity * unit_price', 6)} AS gross_sales, {R('quantity * unit_price * discount', 6)} AS discount_amount,
       {R('CASE WHEN quantity * unit_price = 0 THEN NULL ELSE (total_sales - quantity * unit_price * discount) / (quantity * unit_price) END', 6)}
         AS profit_margin
FROM sales""")
def _derived_metrics(spark, sf_dir):
    return stable(T.calculate_metrics(FX.sales(spark, sf_dir)), dp=6)


# ---------------------------------------------------------------------------------------
# OUT1 rows, EXP1 and DQ on other views
# ---------------------------------------------------------------------------------------
NUM4 = ["quantity", "unit_price", "discount", "total_sales"]


@register("outlier_rows_iqr", with_(SALES_CTE, _iqr_cte("sales", NUM4)) + "\nUNION ALL\n".join(
    f"SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, "
    f"{R('total_sales', 6)} AS total_sales, {ROW_KEY} AS row_key, '{c}' AS outlier_column FROM sales, bnd "
    f"WHERE {c} < {c}_lo OR {c} > {c}_hi" for c in NUM4))
def _outlier_rows_iqr(spark, sf_dir):
    return stable(O.outlier_rows(FX.sales(spark, sf_dir), method="iqr", places=4), dp=6)


@register("expectation_suite_dirty", with_(DIRTY_CTE) + _exp_sql("sales_dirty"))
def _expectation_suite_dirty(spark, sf_dir):
    return stable(V.expectation_suite(FX.sales_dirty(spark, sf_dir)))


@register("quality_metrics_clean", _metrics_sql(SALES_CTE, "sales", True))
def _quality_metrics_clean(spark, sf_dir):
    return stable(DQ.run_all_checks(FX.sales(spark, sf_dir), FX.AS_OF, samples=False).metrics_df())


@register("quality_issues_text", _issues_sql(TEXT_CTE, "sales_text", False))
def _quality_issues_text(spark, sf_dir):
    rep = DQ.run_all_checks(FX.sales_text(spark, sf_dir), FX.AS_OF, samples=False)
    return stable(rep.issues_df().drop("sample_data"))


@register("rule_results_clean", _rules_sql(SALES_CTE, "sales"))
def _rule_results_clean(spark, sf_dir):
    return stable(RU.DataQualityRules().run_all(FX.sales(spark, sf_dir), FX.AS_OF))
