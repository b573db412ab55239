"""Invariants from the test strategy: totals agree across operators on the whole tables."""

import pytest
from pyspark.sql import functions as F

from salesforge.operators import analytics as A
from salesforge.operators import charts as C
from salesforge.operators import validate as V
from salesforge.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_histogram_counts_equal_non_null_rows(spark):
    df = FX.sales_dirty(spark, SF)
    h = {r["column"]: r["n"] for r in C.histograms(df, 30).groupBy("column").agg(F.sum("count").alias("n")).collect()}
    nn = df.agg(*[F.count(c).alias(c) for c in C.HIST_COLUMNS]).first()
    assert h == {c: nn[c] for c in C.HIST_COLUMNS}


def test_shares_and_seasonal_totals_add_up(spark):
    df = FX.sales(spark, SF)
    revenue = df.agg(F.sum("total_sales")).first()[0]
    assert sum(r["share_pct"] for r in C.quarter_share(df).collect()) == pytest.approx(100.0)
    for dim, total in ((r["dimension"], r["t"]) for r in
                       A.seasonal_totals(df).groupBy("dimension").agg(F.sum("total").alias("t")).collect()):
        assert total == pytest.approx(revenue, rel=1e-12), dim
    assert sum(r["revenue"] for r in A.revenue_by_period(df, "year").collect()) == pytest.approx(revenue, rel=1e-12)


def test_accepted_plus_rejected_is_input(spark):
    df = FX.sales_dirty(spark, SF)
    res = V.validate_sales(df, mode="quarantine")
    s = res.summary.first()
    assert res.accepted.count() == s["accepted_rows"]
    assert res.rejected.count() == s["rejected_rows"]
    assert s["accepted_rows"] + s["rejected_rows"] == s["input_rows"] == df.count()
