"""Every registered query against its DuckDB twin on the small tables (exact match after
the registry's rounding), plus schema stability of the smoke entry."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from salesforge.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "orders", "events", "part", "customer", "supplier", "nation", "region"]


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool, float)):
        return float(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_a_twin_or_is_declared():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    rel = duck.sql(E.oracle_sql()[name])
    dcols = rel.columns
    assert sorted(dcols) == cols
    tmap = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    assert {f.name: tmap.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields} \
        == dtypes
    drows = sorted((tuple(_norm(r[dcols.index(c)]) for c in cols) for r in rel.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows


def test_entry_smoke(spark):
    a = E.entry(spark)
    assert a.columns == ["product_id", "total_revenue", "avg_order_value", "order_count", "total_quantity",
                         "avg_price", "avg_discount", "revenue_rank", "profit_margin"]
    assert 0 < a.count() <= 10


def test_all_rejects_are_returned(spark):
    from salesforge.sources import fixtures, sinks

    _, rejects = sinks.to_sales_records(fixtures.sales_text(spark, SF))
    found = E.queries()["sales_record_rejects"](spark, SF).toPandas()
    assert len(found) == rejects.count()
    price = found[found.reason == "unit_price_invalid"]
    assert (price.unit_price_text == "Infinity").any() and price.unit_price_text.isna().any()
