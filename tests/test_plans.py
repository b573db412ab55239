"""Plan shape: pushdown, pruning and bounded top-k where they matter at scale."""

from salesforge.operators import analytics as A
from salesforge.operators import queries as Q
from salesforge.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.sparkSession.catalog.clearCache()  # plans over cached data have no scan to inspect
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_pushes_filters_and_uses_bounded_topk(spark):
    df = Q.sales_page(FX.sales(spark, SF), "1998-01-01", "1998-12-31", limit=100, offset=20)
    p = _plan(df)
    assert "TakeOrderedAndProject" in p
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_by_product_prunes_columns(spark):
    p = _plan(Q.sales_by_product(FX.sales(spark, SF)))
    schema = p[p.index("ReadSchema: "):].split("\n")[0]
    assert "l_partkey" in schema and "l_shipdate" not in schema and "l_returnflag" not in schema


def test_product_performance_has_no_unpartitioned_window_over_products(spark):
    p = _plan(A.product_performance(FX.sales(spark, SF)))
    # the only window ranks the top-n rows, which sit below a TakeOrderedAndProject
    assert p.count("Window [") <= 1
    assert "TakeOrderedAndProject" in p


def test_seasonality_is_one_aggregation(spark):
    p = _plan(A.seasonal_totals(FX.sales(spark, SF)))
    assert p.count("Expand") == 1 and p.count("FileScan") == 1
