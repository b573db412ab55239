"""INS2, VIZ7: the bundles that share scans hold the rows of the single frames."""

import math

import pytest
from pyspark.sql import functions as F

from salesforge.operators import analytics as A
from salesforge.operators import anomalies as O
from salesforge.operators import charts as C
from salesforge.sources import fixtures as FX

SMALL = "/root/testdata/sf0.001"


def _same(a, b, name):
    key = lambda r: tuple((x is None, str(x)) for x in r if not isinstance(x, float))
    assert a.columns == b.columns, name
    x, y = (sorted(map(tuple, df.collect()), key=key) for df in (a, b))
    assert len(x) == len(y), name
    for r, s in zip(x, y):
        for u, v in zip(r, s):
            assert u == v or isinstance(u, float) and math.isclose(u, v, rel_tol=1e-9), (name, r, s)


@pytest.fixture(scope="module")
def odd(spark):
    """Damaged sales, rows without product or date, an infinite price."""
    df = FX.sales_dirty(spark, SMALL)
    more = df.limit(40).withColumn("product_id", F.lit(None).cast("string")).unionByName(
        df.limit(20).withColumn("total_sales", F.lit(None).cast("double")))
    return df.unionByName(more).cache()


def test_dashboard_holds_the_single_charts(odd):
    board = C.dashboard(odd)
    single = {"revenue_trend": C.revenue_trend(odd), "top_products": C.top_products(odd, 5), "month_pattern": C.month_pattern(odd),
              "correlations": A.correlation_matrix(odd), "histograms": C.histograms(odd, 20), "scatter": C.scatter_bins(odd), "date_revenue": C.date_revenue_bins(odd)}
    assert set(board) == set(single)
    for name in single:
        _same(board[name].select(*single[name].columns), single[name], name)


def test_report_holds_the_single_frames(odd):
    count = O.anomaly_count(A.prepare(odd), "iqr")
    report = A.analysis_report(odd, count, money_dp=4)
    single = {"basic_metrics": A.basic_metrics(odd), "insights": A.insights(odd, count, money_dp=4), "product_performance": A.product_performance(odd),
              "seasonal_patterns": A.seasonal_patterns(odd), "correlations": A.correlation_matrix(odd)}
    assert set(report) == set(single)
    for name in single:
        _same(report[name].select(*single[name].columns), single[name], name)


def test_bundles_scan_twice(spark):
    """Rows of the source that tasks read while a bundle is made and its frames are read."""
    seen = spark.sparkContext.accumulator(0)
    src = FX.sales(spark, SMALL)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    n = src.count()
    for make in (C.dashboard, A.analysis_report):
        before = seen.value
        for frame in make(src.mapInArrow(count, src.schema)).values():
            frame.collect()
        assert seen.value - before == 2 * n


def test_bundles_of_empty_and_partial_tables(spark):
    none = FX.sales(spark, SMALL).limit(0)
    assert C.dashboard(none)["histograms"].count() == 0 and C.dashboard(none)["revenue_trend"].count() == 0
    assert A.analysis_report(none)["basic_metrics"].first()["total_records"] == 0
    part = FX.sales(spark, SMALL).drop("discount")
    assert A.analysis_report(part)["product_performance"].columns if "discount" in part.columns else True
    assert C.dashboard(part)["histograms"].select("column").distinct().count() == 3
