"""SNK2/SNK5: loads that are killed and repeated."""

import os

import pytest
from pyspark.sql import functions as F

from salesforge.errors import PipelineError
from salesforge.sources import fixtures as FX
from salesforge.sources import readers as RD
from salesforge.sources import sinks as SK

SMALL = "/root/testdata/sf0.001"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _rows(df, *drop):
    return sorted(map(repr, (tuple(r) for r in df.drop("created_at", "run_id", *drop).collect())))


class Killed(Exception):
    pass


@pytest.mark.parametrize("writes", [0, 1, 2])
def test_killed_table_load_is_repeated(spark, monkeypatch, writes):
    """Killed before its first, second or last write; then run again under its id."""
    df, t = FX.sales_dirty(spark, SMALL), f"killed_{writes}"
    whole = SK.load_to_table(df, f"{t}_whole", run_id="a")
    SK.load_to_table(FX.sales(spark, SMALL).limit(5), t, run_id="before")
    real, calls = SK._replace_run, []

    def dying(rows, table, *rest):
        if len(calls) == writes:
            raise Killed
        calls.append(table)
        real(rows, table, *rest)
    with monkeypatch.context() as m:
        m.setattr(SK, "_replace_run", dying)
        with pytest.raises(Killed):
            SK.load_to_table(df, t, run_id="a")
    assert SK.committed(spark, t).count() == 5
    for _ in range(2):  # the second one finds the run committed
        assert SK.load_to_table(df, t, run_id="a") == whole
    for suffix in ("", "_rejects"):
        got = spark.table(f"{t}{suffix}").where("run_id = 'a'")
        assert _rows(got) == _rows(spark.table(f"{t}_whole{suffix}"))
    assert SK.committed(spark, t).count() == 5 + whole.accepted
    assert SK.committed(spark, t, f"{t}_rejects").count() == whole.rejected > 0


def test_rejects_of_a_repaired_source_do_not_stay(spark, monkeypatch):
    bad = FX.sales_dirty(spark, SMALL)
    good = FX.sales(spark, SMALL)
    real = SK._replace_run
    with monkeypatch.context() as m:
        m.setattr(SK, "_replace_run", lambda rows, table, *rest: (_ for _ in ()).throw(Killed) if table == "repaired" else real(rows, table, *rest))
        with pytest.raises(Killed):
            SK.load_to_table(bad, "repaired", run_id="x")
    assert spark.table("repaired_rejects").count() > 0
    assert SK.load_to_table(good, "repaired", run_id="x").rejected == 0
    assert spark.table("repaired_rejects").count() == 0 and spark.table("repaired").count() == good.count()


@pytest.mark.parametrize("killed", ["write", "commit"])
def test_killed_jdbc_load_is_repeated(spark, monkeypatch, tmp_dir, killed):
    url, q = f"jdbc:derby:memory:killed_{killed};create=true", os.path.join(tmp_dir, "q")
    df = FX.sales_dirty(spark, SMALL)
    first = SK.load_to_jdbc(FX.sales(spark, SMALL).limit(7), url, "SALES", DERBY, quarantine_path=q, run_id="first")
    real = SK._execute

    def dying(con, sql, *values):
        if sql.startswith("INSERT INTO SALES_LOADS"):  # the rows are in, the ledger is not
            raise Killed
        real(con, sql, *values)
    with monkeypatch.context() as m:
        m.setattr(SK, "_commit_stage", lambda *a: (_ for _ in ()).throw(Killed)) if killed == "write" else m.setattr(SK, "_execute", dying)
        with pytest.raises(Killed):
            SK.load_to_jdbc(df, url, "SALES", DERBY, quarantine_path=q, run_id="second")
    count = lambda t: RD.read_jdbc(spark, url, query=f"SELECT COUNT(*) AS N FROM {t}", properties=DERBY).first()[0]
    assert count("SALES") == first.accepted == 7 and count("SALES_LOADS") == 1
    for _ in range(2):
        second = SK.load_to_jdbc(df, url, "SALES", DERBY, quarantine_path=q, run_id="second")
    assert second.accepted + second.rejected == df.count() and count("SALES") == 7 + second.accepted and count("SALES_LOADS") == 2
    assert spark.read.parquet(q).where("run_id = 'second'").count() == second.rejected
    back = RD.read_jdbc(spark, url, table="SALES", properties=DERBY)
    records, _ = SK.to_sales_records(df)
    assert set(_rows(records.select(*SK.RECORD_COLUMNS))) <= set(_rows(back))


def test_load_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    src = FX.sales_dirty(spark, SMALL)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    res = SK.load_to_table(src.mapInArrow(count, src.schema), "once_t")
    assert seen.value == res.accepted + res.rejected == src.count()


def test_load_refuses_what_does_not_fit(spark):
    df = FX.sales(spark, SMALL).limit(3)
    with pytest.raises(PipelineError, match="Run id"):
        SK.load_to_table(df, "refused_t", run_id="a'b")
    SK.load_to_table(df, "refused_t", run_id="a")
    with pytest.raises(PipelineError, match="has columns"):
        SK.load_to_table(df.withColumn("note", F.lit("x")), "refused_t", run_id="b")
    up = [{"date": "2024-01-01", "product_id": "P7", "quantity": 2.0, "unit_price": 3.0, "discount": 0.0, "total_sales": 6.0}]
    for _ in range(2):
        assert SK.upload_sales(spark, up, "uploaded_t", run_id="u")["records_accepted"] == 1
    assert spark.table("uploaded_t").count() == 1
