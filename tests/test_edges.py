"""Edge cases: empty frame, one row, all-NULL and constant columns."""

from datetime import datetime

from pyspark.sql import functions as F

from salesforge.operators import analytics as A
from salesforge.operators import anomalies as O
from salesforge.operators import charts as C
from salesforge.operators import legacy as L
from salesforge.operators import quality as DQ
from salesforge.operators import rules as RU
from salesforge.operators import validate as V

from frames import SALES_DDL

AS_OF = datetime(2024, 2, 1)


def _typed(spark, rows):
    return spark.createDataFrame(rows, SALES_DDL).withColumn("date", F.col("date").cast("timestamp_ntz"))


def test_empty_frame(spark):
    df = _typed(spark, [])
    rep = DQ.run_all_checks(df, AS_OF)
    assert rep.total_records == 0 and not rep.is_acceptable()
    assert all(m["value"] is None for m in rep.metrics if m["name"] != "uniqueness")
    r = A.basic_metrics(df).first()
    assert (r["total_records"], r["total_revenue"], r["unique_products"]) == (0, 0.0, 0)
    assert A.product_performance(df).count() == 0
    assert A.time_based_metrics(df).count() == 0 and A.revenue_trends(df).count() == 0
    assert A.forecast(df, 3, "trend").count() == 0 and A.forecast(df, 3, "simple").count() == 0
    assert O.anomalies(df).count() == 0 and O.outlier_summary(df).count() == 0
    assert C.histograms(df).count() == 0
    res = V.validate_sales(df, mode="quarantine")
    assert res.accepted.count() == 0 and res.summary.first()["input_rows"] == 0
    rr = {r["rule_name"]: r for r in RU.DataQualityRules().run_all(df, AS_OF).collect()}
    assert rr["positive_quantities"]["passed"] is False and rr["positive_quantities"]["score"] is None
    assert L.quality_score(df).first()["data_quality_score"] == 100.0


def test_one_row_and_constant_columns(spark):
    one = _typed(spark, [("2024-01-15", "P001", 2.0, 10.0, 0.1, 18.0)])
    assert A.correlation_matrix(one).where(F.col("r").isNotNull()).count() == 0  # no variance: NULL, not an error
    e = {r["name"]: r["value"] for r in A.efficiency_metrics(one).collect()}
    assert e["discount_quantity_correlation"] is None
    const = _typed(spark, [("2024-01-15", "P001", 2.0, 10.0, 0.1, 18.0)] * 20)
    assert O.anomalies(const, "zscore").count() == 0 and O.anomalies(const, "iqr").count() == 0
    h = C.histograms(const, 30).agg(F.sum("count")).first()[0]
    assert h == 80  # 4 columns x 20 rows, constant range [x-0.5, x+0.5]


def test_all_null_column(spark):
    df = _typed(spark, [("2024-01-15", "P001", None, 10.0, 0.1, 18.0), ("2024-01-16", "P002", None, 5.0, 0.0, 5.0)])
    r = A.basic_metrics(df).first()
    assert r["total_quantity"] == 0.0  # pandas: the sum of nothing is 0
    rep = DQ.run_all_checks(df, AS_OF)
    by = {m["name"]: m for m in rep.metrics}
    assert by["completeness_quantity"]["value"] == 0.0 and not by["completeness_quantity"]["passed"]
    filled = V.clean_numeric_columns(df, ["quantity"], "median")
    assert filled.where(F.col("quantity").isNull()).count() == 2  # no median to fill with
