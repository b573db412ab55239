import json
import os

from salesforge.streaming import ingest as ST


def _land(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(recs, f)


def _rec(pid, q, p="10.0", total=None):
    return {"date": "2024-01-15", "product_id": pid, "quantity": q, "unit_price": p, "discount": "0.0",
            "total_sales": total or "10.0"}


def test_ingest_is_idempotent_per_batch(spark, tmp_dir):
    landing, table, quar, ckpt, met = (os.path.join(tmp_dir, x)
                                       for x in ("landing", "table", "quarantine", "ckpt", "metrics"))
    _land(landing, "a.json", [_rec("P1", "1"), _rec("P2", "ten"), _rec("P3", "-2")])
    q = ST.start_ingest(spark, landing, table, quar, ckpt, metrics_dir=met)
    q.awaitTermination(120)
    assert sorted(r["product_id"] for r in spark.read.parquet(table).collect()) == [1, 3]
    assert [(r["quantity"], r["reason"]) for r in spark.read.parquet(quar).collect()] == [("ten", "quantity_invalid")]
    m = ST.batch_metrics(spark, met).first()
    assert (m["rows"], m["rejected"], m["quantity_missing"], m["quantity_non_positive"]) == (3, 1, 1, 1)

    # restart on the same checkpoint: nothing is re-ingested; a new file is a new batch
    _land(landing, "b.json", [_rec("P4", "3"), _rec("P5", "4")])
    q2 = ST.start_ingest(spark, landing, table, quar, ckpt, metrics_dir=met)
    q2.awaitTermination(120)
    assert sorted(r["product_id"] for r in spark.read.parquet(table).collect()) == [1, 3, 4, 5]
    assert ST.batch_metrics(spark, met).count() == 2


def test_bad_values_are_kept_and_batches_do_not_matter(spark, tmp_dir):
    good = _rec("P1", "1")
    bad = {"unit_price": "abc", "discount": "zz", "total_sales": "q", "date": "bad", "quantity": "12d", "product_id": "X1"}
    files = [[good | {k: v}] for k, v in bad.items()] + [[good, _rec("P9", "2") | {"discount": None}]]
    results = []
    for per_trigger in (1, 100):
        base = os.path.join(tmp_dir, str(per_trigger))
        for i, recs in enumerate(files):
            _land(os.path.join(base, "landing"), f"{i}.json", recs)
        paths = [os.path.join(base, x) for x in ("landing", "table", "quarantine", "ckpt")]
        ST.start_ingest(spark, *paths, max_files_per_trigger=per_trigger).awaitTermination(180)
        rejects = spark.read.parquet(paths[2])
        assert {r["reason"]: r[r["reason"].removesuffix("_invalid")] for r in rejects.collect()} == {f"{k}_invalid": v for k, v in bad.items()}
        results.append(sorted(map(str, spark.read.parquet(paths[1]).drop("created_at", "batch_id").collect())))
    assert results[0] == results[1] and len(results[0]) == 2


def test_csv_stream_goes_by_the_header(spark, tmp_dir):
    landing, table, quar, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "table", "quarantine", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("product_id,date,unit_price,quantity,total_sales,discount\nP7,2024-01-15,25.5,10,229.5,0.1\n")
    ST.start_ingest(spark, landing, table, quar, ckpt, fmt="csv").awaitTermination(120)
    r = spark.read.parquet(table).first()
    assert (r["product_id"], r["quantity"], r["unit_price"], r["discount"]) == (7, 10, 25.5, 0.1)
