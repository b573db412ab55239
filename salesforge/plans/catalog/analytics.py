"""Registrations for AGG1-AGG10, WIN1-WIN3, FCT1-FCT2, OUT1-OUT4 and INS1."""

from __future__ import annotations

from salesforge.operators import analytics as A
from salesforge.operators import anomalies as O
from salesforge.plans.oracle import SALES_CTE, R, with_
from salesforge.plans.registry import register, stable
from salesforge.sources import fixtures as FX

NUM4 = ["quantity", "unit_price", "discount", "total_sales"]
# Long metric rows whose value is a sum of money/units (rounded at 4 places).
SUM_ROWS = ("total_revenue", "total_quantity", "unique_products", "best_month_revenue", "best_quarter_revenue", "top_product_revenue", "top_product_quantity")


def _sales(spark, sf_dir):
    return FX.sales(spark, sf_dir)


def _nan_null(e: str) -> str:
    return f"(CASE WHEN isnan({e}) THEN NULL ELSE {e} END)"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _standalone(frag: str) -> str:
    return with_(SALES_CTE) + f"SELECT * FROM ({frag})"


# ---------------------------------------------------------------------------------------
# SQL fragments over the ``sales`` CTE (self-contained SELECTs, reusable in unions)
# ---------------------------------------------------------------------------------------
BASIC_LONG_SQL = f"""
WITH a AS (SELECT coalesce(sum(total_sales), 0) AS rev, avg(total_sales) AS aov,
                  coalesce(sum(quantity), 0) AS qty, avg(unit_price) AS aup, avg(discount) AS adisc,
                  count(DISTINCT product_id) AS nprod FROM sales)
""" + _union([
    f"SELECT 'total_revenue' AS name, {R('rev', 4)} AS value, 'USD' AS unit, 'Total revenue from all sales' AS description, CAST(NULL AS VARCHAR) AS period FROM a",
    f"SELECT 'total_quantity', {R('qty', 4)}, 'units', 'Total quantity of products sold', NULL FROM a",
    f"SELECT 'avg_order_value', {R('aov')}, 'USD', 'Average value per order', NULL FROM a",
    f"SELECT 'avg_unit_price', {R('aup')}, 'USD', 'Average price per unit', NULL FROM a",
    f"SELECT 'avg_discount', {R('adisc * 100')}, '%', 'Average discount rate', NULL FROM a",
    f"SELECT 'unique_products', {R('nprod', 4)}, 'products', 'Number of unique products sold', NULL FROM a",
])

MONTHLY_SQL = """per AS (
  SELECT strftime(date, '%Y-%m') AS period, year(date) * 12 + month(date) AS ord,
         coalesce(sum(total_sales), 0) AS revenue
  FROM sales WHERE date IS NOT NULL GROUP BY 1, 2)"""

TIME_MONTH_SQL = f"""
WITH {MONTHLY_SQL},
best AS (SELECT period, revenue FROM per ORDER BY revenue DESC, ord LIMIT 1)
""" + _union([
    f"SELECT 'best_month_revenue' AS name, {R('revenue', 4)} AS value, 'USD' AS unit, 'Highest revenue month: ' || period AS description, period FROM best",
    f"SELECT 'avg_monthly_revenue', {R('avg(revenue)')}, 'USD', 'Average monthly revenue', NULL FROM per HAVING count(*) > 0",
])

TIME_QUARTER_SQL = f"""
WITH per AS (
  SELECT CAST(year(date) AS VARCHAR) || 'Q' || CAST(quarter(date) AS VARCHAR) AS period,
         year(date) * 4 + quarter(date) AS ord, coalesce(sum(total_sales), 0) AS revenue
  FROM sales WHERE date IS NOT NULL GROUP BY 1, 2),
best AS (SELECT period, revenue FROM per ORDER BY revenue DESC, ord LIMIT 1)
SELECT 'best_quarter_revenue' AS name, {R('revenue', 4)} AS value, 'USD' AS unit,
       'Highest revenue quarter: ' || period AS description, period FROM best"""

PRODUCT_SQL = f"""
WITH prod AS (SELECT product_id, coalesce(sum(total_sales), 0) AS revenue, coalesce(sum(quantity), 0) AS quantity
              FROM sales WHERE product_id IS NOT NULL GROUP BY 1),
tr AS (SELECT product_id, revenue FROM prod ORDER BY revenue DESC, product_id LIMIT 1),
tq AS (SELECT product_id, quantity FROM prod ORDER BY quantity DESC, product_id LIMIT 1),
t5 AS (SELECT sum(revenue) AS top5 FROM (SELECT revenue FROM prod ORDER BY revenue DESC LIMIT 5)),
tot AS (SELECT sum(revenue) AS total FROM prod)
""" + _union([
    f"SELECT 'top_product_revenue' AS name, {R('revenue', 4)} AS value, 'USD' AS unit, 'Revenue from top product: ' || product_id AS description, product_id AS period FROM tr",
    f"SELECT 'top_product_quantity', {R('quantity', 4)}, 'units', 'Quantity sold of top product: ' || product_id, product_id FROM tq",
    f"SELECT 'top_5_concentration', {R('CASE WHEN total = 0 THEN NULL ELSE top5 / total END * 100')}, '%', 'Revenue share of top 5 products', NULL FROM t5, tot",
])

GROWTH_SQL = f"""
WITH {MONTHLY_SQL},
r AS (SELECT revenue, row_number() OVER (ORDER BY ord DESC) AS rn FROM per),
g AS (SELECT count(*) AS n, avg(CASE WHEN rn <= 3 THEN revenue END) AS recent,
             avg(CASE WHEN rn BETWEEN 2 AND 4 THEN revenue END) AS earlier FROM r)
SELECT 'revenue_growth_rate' AS name,
       {R('CASE WHEN earlier = 0 THEN NULL ELSE (recent - earlier) / earlier END * 100')} AS value,
       '%' AS unit, 'Revenue growth rate over last 3 months' AS description,
       CAST(NULL AS VARCHAR) AS period
FROM g WHERE n >= 3"""

EFFICIENCY_SQL = f"""
WITH pp AS (SELECT avg(rev) AS aspp FROM (SELECT product_id, coalesce(sum(total_sales), 0) AS rev
                                          FROM sales WHERE product_id IS NOT NULL GROUP BY 1)),
f AS (SELECT avg(quantity) AS aqpo, corr(discount, quantity) AS dqc FROM sales)
""" + _union([
    f"SELECT 'avg_sales_per_product' AS name, {R('aspp')} AS value, 'USD' AS unit, 'Average revenue per product' AS description, CAST(NULL AS VARCHAR) AS period FROM pp",
    f"SELECT 'avg_quantity_per_order', {R('aqpo')}, 'units', 'Average quantity per order', NULL FROM f",
    f"SELECT 'discount_quantity_correlation', {R(_nan_null('dqc'))}, 'correlation', 'Correlation between discount and quantity sold', NULL FROM f",
])


def _corr_sql() -> str:
    aggs, cells = [], []
    for i, a in enumerate(NUM4):
        aggs.append(f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0 END AS {a}__{a}")
        for b in NUM4[i + 1:]:
            aggs.append(f"{_nan_null(f'corr({a}, {b})')} AS {a}__{b}")
    for a in NUM4:
        for b in NUM4:
            src = f"{a}__{b}" if NUM4.index(a) <= NUM4.index(b) else f"{b}__{a}"
            cells.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(src)} AS r FROM c")
    return f"WITH c AS (SELECT {', '.join(aggs)} FROM sales)\n" + _union(cells)


# ---------------------------------------------------------------------------------------
# AGG1-AGG4
# ---------------------------------------------------------------------------------------
@register("basic_metrics", with_(SALES_CTE) + f"""
SELECT count(*) AS total_records, strftime(min(date), '%Y-%m-%d') AS start_date,
       strftime(max(date), '%Y-%m-%d') AS end_date, {R('coalesce(sum(total_sales), 0)', 4)} AS total_revenue,
       {R('coalesce(sum(quantity), 0)', 4)} AS total_quantity, {R('avg(unit_price)')} AS avg_unit_price,
       {R('avg(discount)')} AS avg_discount, count(DISTINCT product_id) AS unique_products
FROM sales""")
def _basic_metrics(spark, sf_dir):
    return stable(A.basic_metrics(_sales(spark, sf_dir)), sums=("total_revenue", "total_quantity"))


@register("basic_metrics_long", _standalone(BASIC_LONG_SQL))
def _basic_metrics_long(spark, sf_dir):
    return stable(A.basic_metrics_long(_sales(spark, sf_dir)), sum_rows=SUM_ROWS)


@register("revenue_by_month", with_(SALES_CTE) + f"""
SELECT strftime(date, '%Y-%m') AS period, year(date) * 12 + month(date) AS period_order,
       {R('coalesce(sum(total_sales), 0)', 4)} AS revenue
FROM sales WHERE date IS NOT NULL GROUP BY 1, 2 ORDER BY 2""")
def _revenue_by_month(spark, sf_dir):
    return stable(A.revenue_by_period(_sales(spark, sf_dir), "month"), sums=("revenue",))


@register("revenue_by_quarter", with_(SALES_CTE) + f"""
SELECT CAST(year(date) AS VARCHAR) || '-Q' || CAST(quarter(date) AS VARCHAR) AS period,
       year(date) * 4 + quarter(date) AS period_order, {R('coalesce(sum(total_sales), 0)', 4)} AS revenue
FROM sales WHERE date IS NOT NULL GROUP BY 1, 2 ORDER BY 2""")
def _revenue_by_quarter(spark, sf_dir):
    return stable(A.revenue_by_period(_sales(spark, sf_dir), "quarter"), sums=("revenue",))


@register("revenue_by_year", with_(SALES_CTE) + f"""
SELECT CAST(year(date) AS VARCHAR) AS period, year(date) AS period_order,
       {R('coalesce(sum(total_sales), 0)', 4)} AS revenue
FROM sales WHERE date IS NOT NULL GROUP BY 1, 2 ORDER BY 2""")
def _revenue_by_year(spark, sf_dir):
    return stable(A.revenue_by_period(_sales(spark, sf_dir), "year"), sums=("revenue",))


@register("time_metrics_month", _standalone(TIME_MONTH_SQL))
def _time_metrics_month(spark, sf_dir):
    return stable(A.time_based_metrics(_sales(spark, sf_dir), "month"), sum_rows=SUM_ROWS)


@register("time_metrics_quarter", _standalone(TIME_QUARTER_SQL))
def _time_metrics_quarter(spark, sf_dir):
    return stable(A.time_based_metrics(_sales(spark, sf_dir), "quarter"), sum_rows=SUM_ROWS)


# ---------------------------------------------------------------------------------------
# AGG5-AGG10
# ---------------------------------------------------------------------------------------
@register("product_metrics", _standalone(PRODUCT_SQL))
def _product_metrics(spark, sf_dir):
    return stable(A.product_metrics(_sales(spark, sf_dir)), sum_rows=SUM_ROWS)


def _r2(e: str) -> str:
    return R(R(e, 2))


@register("product_performance", with_(SALES_CTE) + f""",
perf AS (
  SELECT product_id, {R('coalesce(sum(total_sales), 0)', 2)} AS total_revenue,
         {R('avg(total_sales)', 2)} AS avg_order_value, count(total_sales) AS order_count,
         {R('coalesce(sum(quantity), 0)', 2)} AS total_quantity, {R('avg(unit_price)', 2)} AS avg_price,
         {R('avg(discount)', 2)} AS avg_discount
  FROM sales WHERE product_id IS NOT NULL GROUP BY 1),
ranked AS (
  SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC) AS DOUBLE)
              + CAST(count(*) OVER (PARTITION BY total_revenue) - 1 AS DOUBLE) / 2 AS revenue_rank,
         (1 - avg_discount) * 100 AS profit_margin
  FROM perf)
SELECT product_id, {R('total_revenue')} AS total_revenue, {R('avg_order_value')} AS avg_order_value,
       order_count, {R('total_quantity')} AS total_quantity, {R('avg_price')} AS avg_price,
       {R('avg_discount')} AS avg_discount, {R('revenue_rank')} AS revenue_rank,
       {R('profit_margin')} AS profit_margin
FROM ranked ORDER BY total_revenue DESC, product_id LIMIT 10""")
def _product_performance(spark, sf_dir):
    return stable(A.product_performance(_sales(spark, sf_dir), top_n=10))


@register("seasonal_totals", with_(SALES_CTE) + f""",
b AS (SELECT month(date) AS m, dayname(date) AS wd, quarter(date) AS q, total_sales
      FROM sales WHERE date IS NOT NULL)
SELECT 'monthly' AS dimension, CAST(m AS VARCHAR) AS key, lpad(CAST(m AS VARCHAR), 2, '0') AS key_sort,
       {R('coalesce(sum(total_sales), 0)', 4)} AS total FROM b GROUP BY m
UNION ALL
SELECT 'daily', wd, wd, {R('coalesce(sum(total_sales), 0)', 4)} FROM b GROUP BY wd
UNION ALL
SELECT 'quarterly', CAST(q AS VARCHAR), CAST(q AS VARCHAR), {R('coalesce(sum(total_sales), 0)', 4)} FROM b GROUP BY q""")
def _seasonal_totals(spark, sf_dir):
    return stable(A.seasonal_totals(_sales(spark, sf_dir)), sums=("total",))


@register("seasonal_patterns", with_(SALES_CTE) + """,
b AS (SELECT month(date) AS m, dayname(date) AS wd, quarter(date) AS q, total_sales
      FROM sales WHERE date IS NOT NULL),
t AS (
  SELECT 'monthly' AS dimension, CAST(m AS VARCHAR) AS key, lpad(CAST(m AS VARCHAR), 2, '0') AS key_sort,
         coalesce(sum(total_sales), 0) AS total FROM b GROUP BY m
  UNION ALL SELECT 'daily', wd, wd, coalesce(sum(total_sales), 0) FROM b GROUP BY wd
  UNION ALL SELECT 'quarterly', CAST(q AS VARCHAR), CAST(q AS VARCHAR), coalesce(sum(total_sales), 0)
  FROM b GROUP BY q)
""" + f"""SELECT dimension, first(key ORDER BY total DESC, key_sort) AS best,
       first(key ORDER BY total, key_sort) AS worst, {R('sum(total)', 4)} AS total
FROM t GROUP BY dimension""")
def _seasonal_patterns(spark, sf_dir):
    return stable(A.seasonal_patterns(_sales(spark, sf_dir)), sums=("total",))


@register("efficiency_metrics", _standalone(EFFICIENCY_SQL))
def _efficiency_metrics(spark, sf_dir):
    return stable(A.efficiency_metrics(_sales(spark, sf_dir)))


@register("correlation_matrix", _standalone(_corr_sql()))
def _correlation_matrix(spark, sf_dir):
    return stable(A.correlation_matrix(_sales(spark, sf_dir)))


@register("all_metrics", with_(SALES_CTE) + _union([
    f"SELECT '{cat}' AS category, name, value, unit, description, period FROM ({frag})"
    for cat, frag in [("basic", BASIC_LONG_SQL), ("time_based", TIME_MONTH_SQL),
                      ("product", PRODUCT_SQL), ("trends", GROWTH_SQL),
                      ("efficiency", EFFICIENCY_SQL)]]))
def _all_metrics(spark, sf_dir):
    return stable(A.all_metrics(_sales(spark, sf_dir)), sum_rows=SUM_ROWS)


@register("metric_summary", with_(SALES_CTE) + "SELECT category, count(*) AS total_metrics FROM (" + _union([
    f"SELECT '{cat}' AS category, name FROM ({frag})"
    for cat, frag in [("basic", BASIC_LONG_SQL), ("time_based", TIME_MONTH_SQL),
                      ("product", PRODUCT_SQL), ("trends", GROWTH_SQL),
                      ("efficiency", EFFICIENCY_SQL)]]) + ") GROUP BY category")
def _metric_summary(spark, sf_dir):
    return stable(A.metric_summary(_sales(spark, sf_dir)))


# ---------------------------------------------------------------------------------------
# WIN1 / WIN3 / FCT1 / FCT2
# ---------------------------------------------------------------------------------------
def _trend_sql(label: str, order: str) -> str:
    return with_(SALES_CTE) + f""",
per AS (SELECT {label} AS period, {order} AS period_order, coalesce(sum(total_sales), 0) AS revenue
        FROM sales WHERE date IS NOT NULL GROUP BY 1, 2),
l AS (SELECT *, lag(revenue) OVER (ORDER BY period_order) AS previous_value FROM per),
c AS (SELECT *, CASE WHEN previous_value = 0 THEN NULL
                     ELSE (revenue - previous_value) / previous_value * 100 END AS change_percent
      FROM l WHERE previous_value IS NOT NULL)
SELECT period, 'revenue' AS metric, {R('revenue', 4)} AS current_value, {R('previous_value', 4)} AS previous_value,
       {R('change_percent')} AS change_percent,
       CASE WHEN (CASE WHEN previous_value = 0 THEN sign(revenue) ELSE sign(change_percent) END) > 0 THEN 'up'
            WHEN (CASE WHEN previous_value = 0 THEN sign(revenue) ELSE sign(change_percent) END) < 0 THEN 'down'
            ELSE 'stable' END AS trend_direction,
       period_order
FROM c"""


@register("revenue_trends_month", _trend_sql("strftime(date, '%Y-%m')", "year(date) * 12 + month(date)"))
def _revenue_trends_month(spark, sf_dir):
    return stable(A.revenue_trends(_sales(spark, sf_dir), "month"), sums=("current_value", "previous_value"))


@register("revenue_trends_quarter", _trend_sql(
    "CAST(year(date) AS VARCHAR) || '-Q' || CAST(quarter(date) AS VARCHAR)", "year(date) * 4 + quarter(date)"))
def _revenue_trends_quarter(spark, sf_dir):
    return stable(A.revenue_trends(_sales(spark, sf_dir), "quarter"), sums=("current_value", "previous_value"))


@register("revenue_growth", with_(SALES_CTE) + f"""
SELECT *, value AS trend FROM ({GROWTH_SQL})""")
def _revenue_growth(spark, sf_dir):
    return stable(A.trend_metrics(_sales(spark, sf_dir), 3))


@register("forecast_simple", with_(SALES_CTE) + f""",
{MONTHLY_SQL},
r AS (SELECT revenue, row_number() OVER (ORDER BY ord DESC) AS rn, count(*) OVER () AS n FROM per),
lvl AS (SELECT avg(revenue) AS level FROM r WHERE rn <= 3 HAVING max(n) >= 3)
SELECT CAST(s.step AS BIGINT) AS step, {R('level', 2)} AS forecast_value,
       'simple_moving_average' AS method, CAST(NULL AS DOUBLE) AS trend_slope, 'low' AS confidence
FROM lvl, range(1, 13) s(step)""")
def _forecast_simple(spark, sf_dir):
    return stable(A.forecast(_sales(spark, sf_dir), 12, "simple"), 2)


@register("forecast_trend", with_(SALES_CTE) + f""",
{MONTHLY_SQL},
pts AS (SELECT revenue, CAST(row_number() OVER (ORDER BY ord) - 1 AS DOUBLE) AS x FROM per),
fit AS (SELECT count(*) AS n, regr_slope(revenue, x) AS slope, regr_intercept(revenue, x) AS intercept
        FROM pts HAVING count(*) >= 2)
SELECT CAST(s.step AS BIGINT) AS step, {R('slope * CAST(n + s.step - 1 AS DOUBLE) + intercept', 2)} AS forecast_value,
       'linear_trend' AS method, {R('slope', 2)} AS trend_slope, 'medium' AS confidence
FROM fit, range(1, 13) s(step)""")
def _forecast_trend(spark, sf_dir):
    return stable(A.forecast(_sales(spark, sf_dir), 12, "trend"), 2)


# ---------------------------------------------------------------------------------------
# OUT1-OUT4, INS1
# ---------------------------------------------------------------------------------------
PREP_CTE = """p AS (SELECT *, year(date) AS year, month(date) AS month, day(date) AS day,
                  dayname(date) AS weekday, quarter(date) AS quarter FROM sales)"""


def _iqr_cte(src: str, cols: list[str]) -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in cols)
    bs = ", ".join(f"{c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_hi"
                   for c in cols)
    return f"q AS (SELECT {qs} FROM {src}),\nbnd AS (SELECT {bs} FROM q)"


def _z_cte(src: str, cols: list[str]) -> str:
    ms = ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in cols)
    return f"bnd AS (SELECT {ms} FROM {src})"


def _flag_sql(c: str, method: str) -> str:
    if method == "iqr":
        return f"({c} < {c}_lo OR {c} > {c}_hi)"
    return f"(abs(({c} - {c}_m) / nullif({c}_s, 0)) > 3)"


def _rows_sql(c: str) -> str:
    return "date, product_id, quantity, unit_price, discount, total_sales, year, month, day, weekday, quarter"


def _anomalies_sql(method: str) -> str:
    cols = ["total_sales", "quantity", "unit_price"]
    suffix = "_outlier" if method == "iqr" else "_zscore_outlier"
    cte = _iqr_cte("p", cols) if method == "iqr" else _z_cte("p", cols)
    sel = (f"date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, "
           f"{R('total_sales', 6)} AS total_sales, year, month, day, weekday, quarter")
    return with_(SALES_CTE, PREP_CTE, cte) + _union(
        [f"SELECT {sel}, '{c}{suffix}' AS anomaly_type FROM p, bnd WHERE {_flag_sql(c, method)}" for c in cols])


@register("anomalies_iqr", _anomalies_sql("iqr"))
def _anomalies_iqr(spark, sf_dir):
    return stable(O.anomalies(A.prepare(_sales(spark, sf_dir)), "iqr"), dp=6)


@register("anomalies_zscore", _anomalies_sql("zscore"))
def _anomalies_zscore(spark, sf_dir):
    return stable(O.anomalies(A.prepare(_sales(spark, sf_dir)), "zscore"), dp=6)


def _summary_sql(method: str) -> str:
    cte = _iqr_cte("sales", NUM4) if method == "iqr" else _z_cte("sales", NUM4)
    a, b = ("lower", "upper") if method == "iqr" else ("mean", "std")
    sa, sb = ("lo", "hi") if method == "iqr" else ("m", "s")
    parts = [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {_flag_sql(c, method)}) AS outlier_count, "
             f"{R(f'any_value({c}_{sa})')} AS {a}, {R(f'any_value({c}_{sb})')} AS {b}, "
             f"{R(f'CAST(count(*) FILTER (WHERE {_flag_sql(c, method)}) AS DOUBLE) / count(*) * 100')} AS outlier_percentage "
             f"FROM sales, bnd" for c in NUM4]
    return with_(SALES_CTE, cte) + f"SELECT * FROM ({_union(parts)}) WHERE outlier_count > 0"


@register("outlier_summary_iqr", _summary_sql("iqr"))
def _outlier_summary_iqr(spark, sf_dir):
    return stable(O.outlier_summary(_sales(spark, sf_dir), method="iqr"))


@register("outlier_summary_zscore", _summary_sql("zscore"))
def _outlier_summary_zscore(spark, sf_dir):
    return stable(O.outlier_summary(_sales(spark, sf_dir), method="zscore"))


@register("insights", with_(SALES_CTE, PREP_CTE, _iqr_cte("p", ["total_sales", "quantity", "unit_price"])) + f""",
rev AS (SELECT {R('coalesce(sum(total_sales), 0)', 4)} AS v FROM sales),
prod AS (SELECT product_id, coalesce(sum(total_sales), 0) AS revenue FROM sales
         WHERE product_id IS NOT NULL GROUP BY 1),
top AS (SELECT product_id AS pid, {R('revenue', 4)} AS v FROM prod ORDER BY revenue DESC, product_id LIMIT 1),
disc AS (SELECT avg(discount) AS v FROM sales),
mon AS (SELECT month(date) AS m, coalesce(sum(total_sales), 0) AS total FROM sales
        WHERE date IS NOT NULL GROUP BY 1),
best AS (SELECT m FROM mon ORDER BY total DESC, m LIMIT 1),
anom AS (SELECT count(*) FILTER (WHERE {_flag_sql('total_sales', 'iqr')})
              + count(*) FILTER (WHERE {_flag_sql('quantity', 'iqr')})
              + count(*) FILTER (WHERE {_flag_sql('unit_price', 'iqr')}) AS n FROM p, bnd)
""" + _union([
    "SELECT 'revenue' AS type, 'Total Revenue' AS title, 'Total revenue generated: $' || format('{:,.2f}', v) AS description, " + R('v') + " AS value_num, CAST(NULL AS VARCHAR) AS value_text FROM rev WHERE v > 0",
    "SELECT 'product', 'Top Performing Product', 'Product ' || pid || ' generated $' || format('{:,.2f}', v) || ' in revenue', NULL, pid FROM top",
    f"SELECT 'discount', 'Average Discount', 'Average discount rate: ' || printf('%.1f', v * 100) || '%', {R('v')}, NULL FROM disc",
    "SELECT 'seasonal', 'Peak Sales Month', 'Month ' || CAST(m AS VARCHAR) || ' shows the highest sales volume', CAST(m AS DOUBLE), CAST(m AS VARCHAR) FROM best",
    "SELECT 'anomaly', 'Data Anomalies Detected', 'Found ' || CAST(n AS VARCHAR) || ' anomalous records that may need investigation', CAST(n AS DOUBLE), NULL FROM anom WHERE n > 0",
]))
def _insights(spark, sf_dir):
    df = _sales(spark, sf_dir)
    return stable(A.insights(df, O.anomaly_count(A.prepare(df), "iqr"), money_dp=4))
