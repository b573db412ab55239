"""Registrations of the bundles (INS2, VIZ7): the rows of every frame in long form, against
the twins of the single frames.

A row of a frame becomes one row per double it holds: the frame's name, its other values
as one text, the double's name and value (a row without doubles keeps an empty name)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesforge.operators import analytics as A
from salesforge.operators import anomalies as O
from salesforge.operators import charts as C
from salesforge.plans import registry
from salesforge.plans.catalog.charts import _hist_sql
from salesforge.plans.registry import register, stable
from salesforge.sources import fixtures as FX


def _twin(name: str) -> str:
    return registry._SQL[name]


#: frame: (twin, its other columns, its doubles, those of them that are sums of money)
REPORT = {
    "basic_metrics": (_twin("basic_metrics"), ["total_records", "start_date", "end_date", "unique_products"],
                      ["total_revenue", "total_quantity", "avg_unit_price", "avg_discount"], ("total_revenue", "total_quantity")),
    "insights": (_twin("insights"), ["type", "title", "description", "value_text"], ["value_num"], ()),
    "product_performance": (_twin("product_performance"), ["product_id", "order_count"],
                            ["total_revenue", "avg_order_value", "total_quantity", "avg_price", "avg_discount", "revenue_rank", "profit_margin"], ()),
    "seasonal_patterns": (_twin("seasonal_patterns"), ["dimension", "best", "worst"], ["total"], ("total",)),
    "correlations": (_twin("correlation_matrix"), ["col_a", "col_b"], ["r"], ()),
}
DASHBOARD = {
    "revenue_trend": (_twin("revenue_by_month"), ["period", "period_order"], ["revenue"], ("revenue",)),
    "top_products": (f"SELECT * FROM ({_twin('chart_top_products')}) ORDER BY revenue DESC, product_id LIMIT 5", ["product_id"], ["revenue"], ("revenue",)),
    "month_pattern": (_twin("chart_month_pattern"), ["month"], ["revenue"], ("revenue",)),
    "correlations": (_twin("correlation_matrix"), ["col_a", "col_b"], ["r"], ()),
    "histograms": (_hist_sql(20), ["column", "bin", "count"], ["bin_lo", "bin_hi"], ()),
    "scatter": (_twin("chart_scatter_bins"), ["pair", "x_bin", "y_bin", "count"], [], ()),
    "date_revenue": (_twin("chart_date_revenue_bins"), ["month", "y_bin", "count"], [], ()),
}


def _rows_of(frames: dict[str, DataFrame], spec: dict) -> DataFrame:
    out = []
    for name, df in frames.items():
        _, texts, doubles, sums = spec[name]
        key = F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in texts])
        cells = [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in doubles] or [
            F.struct(F.lit("").alias("field"), F.lit(None).cast("double").alias("value"))]
        out.append(stable(df, sums=sums).select(F.lit(name).alias("frame"), key.alias("key"), F.explode(F.array(*cells)).alias("c")).select("frame", "key", "c.*"))
    return reduce(DataFrame.unionByName, out)


def _rows_sql(spec: dict) -> str:
    parts = []
    for name, (sql, texts, doubles, _) in spec.items():
        key = "concat_ws('|', " + ", ".join(f'CAST("{c}" AS VARCHAR)' for c in texts) + ")"
        parts += [f"SELECT '{name}' AS frame, {key} AS key, '{c}' AS field, {c or 'CAST(NULL AS DOUBLE)'} AS value FROM ({sql})" for c in doubles or [""]]
    return "\nUNION ALL\n".join(parts)


@register("analysis_report", _rows_sql(REPORT))
def _analysis_report(spark, sf_dir):
    df = FX.sales(spark, sf_dir)
    return _rows_of(A.analysis_report(df, O.anomaly_count(A.prepare(df), "iqr"), money_dp=4), REPORT)


@register("dashboard", _rows_sql(DASHBOARD))
def _dashboard(spark, sf_dir):
    return _rows_of(C.dashboard(FX.sales(spark, sf_dir)), DASHBOARD)
