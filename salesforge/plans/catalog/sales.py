"""Registrations: Spark builder + DuckDB twin for each operator (see ``registry``)."""

from __future__ import annotations

from salesforge.operators import queries as Q
from salesforge.operators import transform as T
from salesforge.plans.oracle import DIRTY_CTE, INTRADAY_CTE, SALES_CTE, R, with_
from salesforge.plans.registry import register, stable
from salesforge.scratch import Scratch
from salesforge.sources import fixtures as FX

# ---------------------------------------------------------------------------------------
# TRF1
# ---------------------------------------------------------------------------------------
@register("imputed_sales", with_(DIRTY_CTE) + f""",
i AS (SELECT date, product_id, coalesce(quantity, 0.0) AS quantity,
             coalesce(unit_price, (SELECT avg(unit_price) FROM sales_dirty)) AS unit_price,
             coalesce(discount, 0.0) AS discount, total_sales FROM sales_dirty)
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, {R('total_sales', 6)} AS total_sales
FROM i""")
def _imputed_sales(spark, sf_dir):
    return stable(T.impute(FX.sales_dirty(spark, sf_dir)), dp=6)


# ---------------------------------------------------------------------------------------
# QRY1-QRY4
# ---------------------------------------------------------------------------------------
PAGE_START, PAGE_END = "1998-01-01", "1998-12-31"


@register("sales_page", with_(SALES_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount,
       {R('total_sales', 6)} AS total_sales
FROM sales
WHERE date >= TIMESTAMP '{PAGE_START}' AND date <= TIMESTAMP '{PAGE_END}'
ORDER BY date DESC NULLS LAST, product_id NULLS LAST, quantity NULLS LAST,
         unit_price NULLS LAST, discount NULLS LAST, total_sales NULLS LAST
LIMIT 100 OFFSET 20""")
def _sales_page(spark, sf_dir):
    return stable(Q.sales_page(FX.sales(spark, sf_dir), PAGE_START, PAGE_END, limit=100, offset=20), dp=6)


DEEP_OFFSET = 50_500


@register("sales_page_deep", with_(SALES_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount,
       {R('total_sales', 6)} AS total_sales
FROM sales
ORDER BY date DESC NULLS LAST, product_id NULLS LAST, quantity NULLS LAST,
         unit_price NULLS LAST, discount NULLS LAST, total_sales NULLS LAST
LIMIT 100 OFFSET {DEEP_OFFSET}""")
def _sales_page_deep(spark, sf_dir):
    index = Q.PageIndex.build(FX.sales(spark, sf_dir), Scratch(spark).folder("page-index"))
    return stable(index.page(limit=100, offset=DEEP_OFFSET), dp=6)


@register("sales_page_after", with_(SALES_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount,
       {R('total_sales', 6)} AS total_sales
FROM (SELECT DISTINCT * FROM sales)
ORDER BY date DESC NULLS LAST, product_id NULLS LAST, quantity NULLS LAST,
         unit_price NULLS LAST, discount NULLS LAST, total_sales NULLS LAST
LIMIT 100 OFFSET 40""")
def _sales_page_after(spark, sf_dir):
    # The page behind the 40th row, by its values instead of an offset.
    df = FX.sales(spark, sf_dir).distinct()
    last = Q.sales_page(df, limit=1, offset=39).first()
    return stable(Q.sales_page(df, limit=100, after=last), dp=6)


@register("sales_summary", with_(SALES_CTE) + f"""
SELECT count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       count(DISTINCT product_id) AS unique_products, count(DISTINCT CAST(date AS DATE)) AS unique_dates
FROM sales""")
def _sales_summary(spark, sf_dir):
    return stable(Q.sales_summary(FX.sales(spark, sf_dir)), sums=("total_revenue",))


@register("sales_by_product", with_(SALES_CTE) + f"""
SELECT product_id, count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       {R('avg(discount)')} AS avg_discount
FROM sales GROUP BY product_id ORDER BY total_revenue DESC""")
def _sales_by_product(spark, sf_dir):
    return stable(Q.sales_by_product(FX.sales(spark, sf_dir)), sums=("total_revenue",))


@register("sales_by_date", with_(SALES_CTE) + f"""
SELECT date, count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       count(DISTINCT product_id) AS unique_products
FROM sales GROUP BY date ORDER BY date DESC""")
def _sales_by_date(spark, sf_dir):
    return stable(Q.sales_by_date(FX.sales(spark, sf_dir)), sums=("total_revenue",))


# ---------------------------------------------------------------------------------------
# The same shapes over sales with a time of day: days, and whole end days
# ---------------------------------------------------------------------------------------
_DAYS = f"date >= TIMESTAMP '{PAGE_START}' AND CAST(date AS DATE) <= DATE '{PAGE_END}'"


@register("sales_page_intraday", with_(INTRADAY_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount,
       {R('total_sales', 6)} AS total_sales
FROM sales WHERE {_DAYS}
ORDER BY date DESC NULLS LAST, product_id NULLS LAST, quantity NULLS LAST,
         unit_price NULLS LAST, discount NULLS LAST, total_sales NULLS LAST
LIMIT 100""")
def _sales_page_intraday(spark, sf_dir):
    return stable(Q.sales_page(FX.sales_intraday(spark, sf_dir), PAGE_START, PAGE_END, limit=100), dp=6)


@register("sales_summary_intraday", with_(INTRADAY_CTE) + f"""
SELECT count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       count(DISTINCT product_id) AS unique_products, count(DISTINCT CAST(date AS DATE)) AS unique_dates
FROM sales WHERE {_DAYS}""")
def _sales_summary_intraday(spark, sf_dir):
    return stable(Q.sales_summary(FX.sales_intraday(spark, sf_dir), PAGE_START, PAGE_END), sums=("total_revenue",))


@register("sales_by_product_intraday", with_(INTRADAY_CTE) + f"""
SELECT product_id, count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       {R('avg(discount)')} AS avg_discount
FROM sales WHERE {_DAYS} GROUP BY product_id""")
def _sales_by_product_intraday(spark, sf_dir):
    return stable(Q.sales_by_product(FX.sales_intraday(spark, sf_dir), PAGE_START, PAGE_END), sums=("total_revenue",))


@register("sales_by_date_intraday", with_(INTRADAY_CTE) + f"""
SELECT CAST(CAST(date AS DATE) AS TIMESTAMP) AS date, count(*) AS total_records, sum(quantity) AS total_quantity,
       {R('sum(total_sales)', 4)} AS total_revenue, {R('avg(unit_price)')} AS avg_unit_price,
       count(DISTINCT product_id) AS unique_products
FROM sales WHERE {_DAYS} GROUP BY 1""")
def _sales_by_date_intraday(spark, sf_dir):
    return stable(Q.sales_by_date(FX.sales_intraday(spark, sf_dir), PAGE_START, PAGE_END), sums=("total_revenue",))
