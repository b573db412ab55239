import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from salesforge.errors import PipelineError
from salesforge.functions.schema import ValidationConfig
from salesforge.sources import fixtures as FX
from salesforge.sources import readers as RD
from salesforge.sources import sinks as SK

SMALL = "/root/testdata/sf0.001"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_csv_round_trip(spark, tmp_dir):
    src = FX.sales(spark, SMALL)
    path = SK.write_csv(src, os.path.join(tmp_dir, "sales_csv"))
    back = RD.parse_sales(RD.read_csv(spark, path))
    a = src.agg(F.count(F.lit(1)), F.round(F.sum("total_sales"), 4)).first()
    b = back.agg(F.count(F.lit(1)), F.round(F.sum("total_sales"), 4)).first()
    assert tuple(a) == tuple(b)
    with pytest.raises(FileNotFoundError):
        RD.read_csv(spark, os.path.join(tmp_dir, "nope.csv"))


def test_json_landing_and_dispatch(spark, tmp_dir):
    recs = [{"date": "2024-01-15", "product_id": "P001", "quantity": "10", "unit_price": "25.5",
             "discount": "0.1", "total_sales": "229.5"},
            {"date": "2024-01-16", "product_id": "P002", "quantity": "ten", "unit_price": "5",
             "discount": "0", "total_sales": "5"}]
    p = os.path.join(tmp_dir, "api.json")
    with open(p, "w") as f:
        json.dump(recs, f)
    df = RD.read_sales(spark, "API", p)
    assert df.count() == 2
    with pytest.raises(ValueError, match="Invalid type for column quantity"):
        RD.read_sales(spark, "api", p, validation=ValidationConfig())
    with pytest.raises(PipelineError) as e:
        RD.read_sales(spark, "ftp", p)
    assert e.value.error_code == "EXTRACT_001"


def _file(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_columns_by_name(spark, tmp_dir):
    p = _file(tmp_dir, "r.csv", "product_id,date,unit_price,quantity,total_sales,discount,note\n"
                                "P001,2024-01-15,25.5,10,229.5,0.1,x\nP002,2024-01-16\nP003,2024-01-17,1,2,2,0,y,z,w\n")
    rows = {r["product_id"]: r for r in RD.read_csv(spark, p).collect()}
    assert (rows["P001"]["date"], rows["P001"]["quantity"], rows["P001"]["unit_price"]) == ("2024-01-15", "10", "25.5")
    assert rows["P001"]["note"] == "x" and rows["P001"][RD.CORRUPT] is None
    assert rows["P002"][RD.CORRUPT] == "P002,2024-01-16" and rows["P003"][RD.CORRUPT].endswith("z,w")
    _file(tmp_dir, "bad.csv", "date,product_id,quantity\n2024-01-15,P1,3\n")
    with pytest.raises(ValueError, match="Missing required columns: .*unit_price"):
        RD.read_sales(spark, "csv", os.path.join(tmp_dir, "bad.csv"))
    folder = os.path.join(tmp_dir, "two")
    os.makedirs(folder)
    _file(folder, "a.csv", "date,product_id,quantity,unit_price\n2024-01-15,P1,3,4\n")
    _file(folder, "b.csv", "date,product_id,unit_price,quantity\n2024-01-15,P1,4,3\n")
    _file(folder, "c.csv", "product_id,date,note\nP2,2024-01-16,hello\nP3\n")
    _file(folder, "d.csv", "date,product_id,unit_price,quantity\n2024-01-17,P4,6,5\n")
    _file(folder, "empty.csv", "")
    df = RD.read_csv(spark, folder)
    assert set(df.columns) == {"date", "product_id", "quantity", "unit_price", "note", RD.CORRUPT}
    rows = [r for r in df.cache().collect()]
    whole = {(r["date"], r["product_id"], r["quantity"], r["unit_price"], r["note"]) for r in rows if r[RD.CORRUPT] is None}
    assert whole == {("2024-01-15", "P1", "3", "4", None), ("2024-01-16", "P2", None, None, "hello"), ("2024-01-17", "P4", "5", "6", None)}
    assert sorted(r["product_id"] for r in rows if r["date"] == "2024-01-15") == ["P1", "P1"]  # one row each of a and b
    assert [r[RD.CORRUPT] for r in rows if r[RD.CORRUPT]] == ["P3"]
    assert {len(f) for f in RD.csv_headers(spark, folder).values()} == {1, 2}
    import gzip
    with gzip.open(os.path.join(folder, "e.csv.gz"), "wt") as f:
        f.write("quantity,product_id,date\n9,P9,2024-02-01\n")
    assert RD.read_csv(spark, folder).where("product_id = 'P9' and quantity = '9'").count() == 1


def test_json_fields_by_name(spark, tmp_dir):
    p = _file(tmp_dir, "a.json", '{"date": "2024-01-15", "product_id": "P1", "extra": 1}\nnot json\n{"product_id": "P2", "quantity": 2}\n')
    df = RD.read_json(spark, p)
    assert {"date", "product_id", "extra", "quantity"} <= set(df.columns) and "unit_price" not in df.columns
    assert sorted(r[RD.CORRUPT] or "" for r in df.cache().collect()) == ["", "", "not json"]
    with pytest.raises(ValueError, match="Missing required columns"):
        RD.read_sales(spark, "api", p, validation=ValidationConfig())


def test_jdbc_round_trip_with_quarantine(spark, tmp_dir):
    url = "jdbc:derby:memory:salesforge_test;create=true"
    df = FX.sales_dirty(spark, SMALL)
    res = SK.load_to_jdbc(df, url, "SALES_RECORDS", DERBY, batch_size=500,
                          quarantine_path=os.path.join(tmp_dir, "quarantine"))
    total = df.count()
    assert res.accepted + res.rejected == total and res.rejected > 0
    back = RD.read_jdbc(spark, url, query='SELECT COUNT(*) AS N FROM SALES_RECORDS', properties=DERBY)
    assert back.first()[0] == res.accepted
    part = RD.read_jdbc(spark, url, table="SALES_RECORDS", properties=DERBY, partition_column='"product_id"',
                        lower_bound=0, upper_bound=200, num_partitions=4)
    assert part.rdd.getNumPartitions() == 4 and part.count() == res.accepted
    assert spark.read.parquet(os.path.join(tmp_dir, "quarantine")).count() == res.rejected


def test_table_load_upload_archive(spark, tmp_dir):
    df = FX.sales_dirty(spark, SMALL)
    res = SK.load_to_table(df, "sales_records_t", "sales_quarantine_t")
    assert res.accepted == spark.table("sales_records_t").count()
    assert res.accepted + res.rejected == df.count()
    assert spark.table("sales_records_t").schema["product_id"].dataType.simpleString() == "int"
    with pytest.raises(PipelineError):
        SK.upload_sales(spark, [], "sales_records_t")
    with pytest.raises(PipelineError, match="Missing required columns"):
        SK.upload_sales(spark, [{"date": "2024-01-01", "product_id": "P1"}], "sales_records_t")
    up = SK.upload_sales(spark, [{"date": "2024-01-01", "product_id": "P7", "quantity": 2.0, "unit_price": 3.0,
                                  "discount": 0.0, "total_sales": 6.0}], "sales_records_t")
    assert up["records_accepted"] == 1 and up["records_rejected"] == 0
    ts = datetime(2024, 1, 2, 3, 4, 5)
    p = SK.archive(df, os.path.join(tmp_dir, "archive"), ts)
    assert p.endswith("run_ts=20240102_030405") and spark.read.parquet(p).count() == df.count()
    with pytest.raises(Exception):
        SK.archive(df, os.path.join(tmp_dir, "archive"), ts)
    SK.load_to_warehouse(FX.sales(spark, SMALL), "sales_wh_t")
    assert set(spark.table("sales_wh_t").columns) >= {"year", "month"}


def test_sample_generator(spark):
    s = RD.sample_sales(spark, 100, 42, datetime(2024, 1, 1))
    r = s.agg(F.count(F.lit(1)).alias("n"), F.min("quantity").alias("qlo"), F.max("quantity").alias("qhi"),
              F.max("discount").alias("dhi"), F.countDistinct("product_id").alias("p")).first()
    assert r["n"] == 100 and 1 <= r["qlo"] and r["qhi"] <= 99 and r["dhi"] <= 0.3 and r["p"] == 100


def test_memoize_by_input_fingerprint(spark, tmp_dir):
    from salesforge.operators import fingerprint as FP
    from salesforge.operators import transform as T
    calls = []

    def fn(df):
        calls.append(1)
        return T.calculate_metrics(df)

    src = FX.sales(spark, SMALL)
    a = FP.memoize(src, fn, tmp_dir, "metrics")
    b = FP.memoize(src.repartition(3), fn, tmp_dir, "metrics")  # same content, other layout
    assert len(calls) == 1 and a.count() == b.count() == src.count()
    FP.memoize(src.limit(10), fn, tmp_dir, "metrics")
    assert len(calls) == 2
    FP.memoize(src, fn, tmp_dir, "metrics", {"other": 1})
    assert len(calls) == 3


def test_fingerprint_sees_nulls_names_and_read_errors(spark, tmp_dir):
    from salesforge.operators import fingerprint as FP
    def key(rows, ddl="a double, b double"):
        return FP.fingerprint(spark.createDataFrame(rows, ddl)).first()["fingerprint"]
    assert key([(1.0, None)]) != key([(None, 1.0)])
    assert key([(1.0, 2.0)]) != key([(1.0, 2.0)], "a double, c double") and key([(1.0, 2.0)]) == key([(1.0, 2.0)])
    assert key([(1.0, 2.0), (3.0, 4.0)]) == key([(3.0, 4.0), (1.0, 2.0)]) != key([(1.0, 4.0), (3.0, 2.0)])
    df = spark.range(3)
    store = os.path.join(tmp_dir, "n", FP.fingerprint_key(df))
    os.makedirs(store)
    _file(store, "part-0.parquet", "broken")
    with pytest.raises(Exception):
        FP.memoize(df, lambda d: d, tmp_dir, "n")
    assert open(os.path.join(store, "part-0.parquet")).read() == "broken"


def test_analysis_report_and_json_report(spark, tmp_dir):
    from salesforge.operators import analytics as A
    from salesforge.operators import quality as DQ
    df = FX.sales(spark, SMALL).cache()
    frames = A.analysis_report(df)
    paths = SK.write_frames_json(frames, os.path.join(tmp_dir, "analysis"))
    assert set(paths) == {"basic_metrics", "insights", "product_performance", "seasonal_patterns", "correlations"}
    assert spark.read.json(paths["correlations"]).count() == 16
    rep = DQ.run_all_checks(df, FX.AS_OF)
    row = rep.to_json_df().first()
    assert json.loads(row["report"])["summary"]["total_records"] == df.count()
    p = SK.write_report(spark, rep.to_dict(), os.path.join(tmp_dir, "q.json"))
    assert json.loads(spark.read.text(p, wholetext=True).first()[0])["summary"]["total_metrics"] == len(rep.metrics)
    df.unpersist()


def test_fingerprint_of_an_append_reads_only_new_files(spark, tmp_dir):
    from salesforge.operators import fingerprint as FP
    folder, store = os.path.join(tmp_dir, "data"), os.path.join(tmp_dir, "sums")
    src = FX.sales(spark, SMALL)
    src.where("quantity < 20").repartition(3).write.parquet(folder)
    first = FP.fingerprint_files(spark, folder, store).first()
    assert (first["files"], first["files_hashed"]) == (3, 3)
    assert FP.fingerprint_files(spark, folder, store).first()["files_hashed"] == 0
    src.where("quantity >= 20").coalesce(1).write.mode("append").parquet(folder)
    old = [f for f in os.listdir(folder) if f.startswith("part")]
    both = FP.fingerprint_files(spark, folder, store).first()
    assert (both["files"], both["files_hashed"]) == (4, 1)
    whole = FP.fingerprint(spark.read.parquet(folder)).first()
    assert tuple(both)[:2] == tuple(whole) and whole["rows"] == src.count()
    assert FP.fingerprint_files(spark, folder, os.path.join(tmp_dir, "other"), max_paths=0).first()[:2] == tuple(whole)
    assert FP.fingerprint_files(spark, folder, store, places=2).first()["files_hashed"] == 4  # other numbers, other sums
    os.remove(os.path.join(folder, old[0]))  # a file that goes takes its sum with it
    rest = FP.fingerprint_files(spark, folder, store).first()
    assert rest["files_hashed"] == 0 and tuple(rest)[:2] == tuple(FP.fingerprint(spark.read.parquet(folder)).first())


def test_dataset_fingerprint_counts_the_whole_values(spark, tmp_dir):
    """Prices that differ after the fourth decimal place are other data, as the twin has it."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    ddl = "l_orderkey long, l_partkey long, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double, l_discount double"
    day, found = datetime(1998, 1, 15), []
    for n, price in enumerate((100.0, 100.00001, 100.00000000000001, None)):
        folder = os.path.join(tmp_dir, str(n))
        rows = [(1, 1, day, 1.0, price, 0.0), (97, 2, None, 3.0, 1e9 / 7, 0.07), (101, 3, day, 0.0, -5.25, 0.1), (89, 4, day, 3.0, 1e-8 / 3, None),
                (2, 5, day, -0.0, -1e12 / 3, 0.3)]
        spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/lineitem.parquet")
        found.append(tuple(queries()["dataset_fingerprint"](spark, folder).first()))
        con = duckdb.connect()
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{folder}/lineitem.parquet/*.parquet')")
        assert con.execute(oracle_sql()["dataset_fingerprint"]).fetchall() == [found[-1]]
    assert len(set(found)) == 4 and {r for r, _ in found} == {6}
