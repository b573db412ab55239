"""Registrations for the chart-data operators (VIZ2, VIZ3, VIZ5, VIZ6)."""

from __future__ import annotations

from salesforge.operators import charts as C
from salesforge.plans.oracle import SALES_CTE, R, with_
from salesforge.plans.registry import register, stable
from salesforge.sources import fixtures as FX


def _sales(spark, sf_dir):
    return FX.sales(spark, sf_dir)


@register("chart_top_products", with_(SALES_CTE) + f"""
SELECT product_id, {R('coalesce(sum(total_sales), 0)', 4)} AS revenue
FROM sales WHERE product_id IS NOT NULL GROUP BY product_id
ORDER BY coalesce(sum(total_sales), 0) DESC, product_id LIMIT 10""")
def _chart_top_products(spark, sf_dir):
    return stable(C.top_products(_sales(spark, sf_dir), 10), sums=("revenue",))


@register("chart_month_pattern", with_(SALES_CTE) + f"""
SELECT month(date) AS month, {R('coalesce(sum(total_sales), 0)', 4)} AS revenue
FROM sales WHERE date IS NOT NULL GROUP BY 1""")
def _chart_month_pattern(spark, sf_dir):
    return stable(C.month_pattern(_sales(spark, sf_dir)), sums=("revenue",))


@register("chart_weekday_pattern", with_(SALES_CTE) + f""",
cal AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
                              (5, 'Saturday'), (6, 'Sunday')) t(day_index, weekday)),
per AS (SELECT dayname(date) AS weekday, coalesce(sum(total_sales), 0) AS revenue
        FROM sales WHERE date IS NOT NULL GROUP BY 1)
SELECT CAST(day_index AS BIGINT) AS day_index, weekday, {R('revenue', 4)} AS revenue
FROM cal LEFT JOIN per USING (weekday)""")
def _chart_weekday_pattern(spark, sf_dir):
    return stable(C.weekday_pattern(_sales(spark, sf_dir)), sums=("revenue",))


@register("chart_quarter_share", with_(SALES_CTE) + f""",
per AS (SELECT quarter(date) AS quarter, coalesce(sum(total_sales), 0) AS revenue
        FROM sales WHERE date IS NOT NULL GROUP BY 1)
SELECT quarter, 'Q' || CAST(quarter AS VARCHAR) AS label, {R('revenue', 4)} AS revenue,
       {R('revenue / (SELECT sum(revenue) FROM per) * 100.0')} AS share_pct
FROM per""")
def _chart_quarter_share(spark, sf_dir):
    return stable(C.quarter_share(_sales(spark, sf_dir)), sums=("revenue",))


@register("chart_yearly_revenue", with_(SALES_CTE) + f"""
SELECT year(date) AS year, {R('coalesce(sum(total_sales), 0)', 4)} AS revenue
FROM sales WHERE date IS NOT NULL GROUP BY 1""")
def _chart_yearly_revenue(spark, sf_dir):
    return stable(C.yearly_revenue(_sales(spark, sf_dir)), sums=("revenue",))


def _bin_sql(x: str, lo: str, hi: str, bins: int) -> str:
    """SQL twin of ``charts._bin`` (numpy.histogram bin assignment)."""
    step = f"(({hi} - {lo}) / {bins})"
    norm = f"({bins} / ({hi} - {lo}))"
    i0 = f"least({bins - 1}, CAST(floor(({x} - {lo}) * {norm}) AS INTEGER))"
    lower = f"(CAST({i0} AS DOUBLE) * {step} + {lo})"
    upper = f"(CASE WHEN {i0} + 1 >= {bins} THEN {hi} ELSE CAST({i0} + 1 AS DOUBLE) * {step} + {lo} END)"
    down = f"({x} < {lower})"
    up = f"(NOT {down} AND {x} >= {upper} AND {i0} <> {bins - 1})"
    return f"({i0} - CAST({down} AS INTEGER) + CAST({up} AS INTEGER))"


def _range_cte(cols: list[str]) -> str:
    sel = ", ".join(f"CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS {c}_lo, "
                    f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS {c}_hi" for c in cols)
    return f"rng AS (SELECT {sel} FROM sales)"


def _hist_sql(bins: int = 30) -> str:
    cols = C.HIST_COLUMNS
    parts = []
    for c in cols:
        step = f"(({c}_hi - {c}_lo) / {bins})"
        parts.append(f"""SELECT '{c}' AS "column", CAST(g.b AS BIGINT) AS bin,
       {R(f'CAST(g.b AS DOUBLE) * {step} + {c}_lo')} AS bin_lo,
       {R(f'CASE WHEN g.b = {bins - 1} THEN {c}_hi ELSE CAST(g.b + 1 AS DOUBLE) * {step} + {c}_lo END')} AS bin_hi,
       (SELECT count(*) FROM sales WHERE {c} IS NOT NULL AND {_bin_sql(c, f'rng.{c}_lo', f'rng.{c}_hi', bins)} = g.b)
         AS count
FROM rng, range(0, {bins}) g(b)""")
    return with_(SALES_CTE, _range_cte(cols)) + "\nUNION ALL\n".join(parts)


@register("chart_histograms", _hist_sql(30))
def _chart_histograms(spark, sf_dir):
    return stable(C.histograms(_sales(spark, sf_dir), 30))


def _scatter_sql(bins: int = 20) -> str:
    cols = sorted({c for p in C.SCATTER_PAIRS for c in p})
    parts = [f"""SELECT '{a}:{b}' AS pair, CAST({_bin_sql(a, f'{a}_lo', f'{a}_hi', bins)} AS BIGINT) AS x_bin,
       CAST({_bin_sql(b, f'{b}_lo', f'{b}_hi', bins)} AS BIGINT) AS y_bin, count(*) AS count
FROM sales, rng WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2, 3""" for a, b in C.SCATTER_PAIRS]
    return with_(SALES_CTE, _range_cte(cols)) + "\nUNION ALL\n".join(parts)


@register("chart_scatter_bins", _scatter_sql(20))
def _chart_scatter_bins(spark, sf_dir):
    return stable(C.scatter_bins(_sales(spark, sf_dir), 20))


@register("chart_date_revenue_bins", with_(SALES_CTE, _range_cte(["total_sales"])) + f"""
SELECT strftime(date, '%Y-%m') AS month,
       CAST({_bin_sql('total_sales', 'total_sales_lo', 'total_sales_hi', 20)} AS BIGINT) AS y_bin, count(*) AS count
FROM sales, rng WHERE date IS NOT NULL AND total_sales IS NOT NULL GROUP BY 1, 2""")
def _chart_date_revenue_bins(spark, sf_dir):
    return stable(C.date_revenue_bins(_sales(spark, sf_dir), 20))
