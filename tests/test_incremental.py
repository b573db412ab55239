"""Quality by parts, pages by index, prefix scans, stored logs."""

import os
import shutil
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesforge.errors import PipelineError
from salesforge.functions.ordered import range_totals, with_places
from salesforge.operators import history as H
from salesforge.operators import incremental as IN
from salesforge.operators import quality as DQ
from salesforge.operators import queries as Q
from salesforge.operators import rules as RU
from salesforge.scratch import Scratch
from salesforge.sources import fixtures as FX

SMALL = "/root/testdata/sf0.001"


def _all_rules():
    rules = RU.DataQualityRules()
    rules.add_rule(RU.QualityRule("big_orders", "quantity above 40", "warning", lambda df, ctx: RU.RuleCheck(
        {"n": F.count(F.lit(1)), "big": F.count_if(F.col("quantity") > 40)},
        lambda v: {"passed": v["big"] < v["n"], "score": float(v["big"]), "issues": []}), 50.0))
    return rules


def test_merged_states_equal_the_whole_report(spark, tmp_dir):
    df = FX.sales_dirty(spark, SMALL)
    month = F.date_format("date", "yyyy-MM")
    rules = _all_rules()
    store = IN.QualityStore(os.path.join(tmp_dir, "q"), df, rules, FX.AS_OF)
    assert store.report().total_records == 0
    store.add(df.where("date < '1995-01-01'"), month)
    store.add(df.where("date >= '1995-01-01' or date is null"), month)
    store.add(df.where("date >= '1996-03-01' and date < '1996-05-01'"), month)  # two parts once more
    whole = DQ.run_all_checks(df, FX.AS_OF, samples=False)
    got = store.report()
    assert got.metrics == whole.metrics and got.issues == whole.issues and got.overall_score == whole.overall_score
    assert sorted(map(repr, store.rule_results().collect())) == sorted(map(repr, rules.run_all(df, FX.AS_OF).collect()))
    one = store.report(parts=["1996-03", "none"])
    alone = DQ.run_all_checks(df.where("date is null or date_format(date, 'yyyy-MM') = '1996-03'"), FX.AS_OF, samples=False)
    assert one.metrics == alone.metrics
    early = datetime(1996, 3, 10)  # other days in the future and out of date
    assert store.report(early).metrics == DQ.run_all_checks(df, early, samples=False).metrics
    with pytest.raises(ValueError, match="midnight"):
        store.report(datetime(1996, 3, 10, 5))
    with pytest.raises(PipelineError):
        store.add(df.drop("discount"), month)


def test_text_states_and_interrupted_add(spark, tmp_dir, monkeypatch):
    df = FX.sales_text(spark, SMALL)
    store = IN.QualityStore(os.path.join(tmp_dir, "q"), df)
    half = F.col("product_id") < "P5"
    store.add(df.where(half), F.lit("a"))
    real = IN.QualityStore._replace
    with monkeypatch.context() as m:
        m.setattr(IN.QualityStore, "_replace", lambda self, rows, what: (_ for _ in ()).throw(KeyError) if what == "counts" else real(self, rows, what))
        with pytest.raises(KeyError):
            store.add(df.where(~half), F.lit("b"))
    assert store.report(FX.AS_OF).metrics == DQ.run_all_checks(df.where(half), FX.AS_OF, samples=False).metrics
    store.add(df.where(~half), F.lit("b"))
    whole = DQ.run_all_checks(df, FX.AS_OF, samples=False)
    assert store.report(FX.AS_OF).metrics == whole.metrics and store.report(FX.AS_OF).issues == whole.issues


def test_deep_pages_read_one_range(spark, tmp_dir):
    src = FX.sales(spark, SMALL)
    df = src.unionByName(src.limit(500)).unionByName(src.limit(1).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(700)))).drop("x"))
    index = Q.PageIndex.build(df, os.path.join(tmp_dir, "index"), ranges=6)
    want = Q.sales_page(df, limit=100_000).toPandas()
    for offset, limit in ((0, 10), (1234, 100), (3000, 2000), (len(want) - 5, 50), (len(want), 5)):
        got = index.page(limit, offset).toPandas()
        pd.testing.assert_frame_equal(got, want[offset:offset + limit].reset_index(drop=True), check_dtype=False)
    page = index.page(5, 1234)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan and "PartitionFilters: [" in plan and "_range#" in plan
    reads = spark.read.parquet(os.path.join(tmp_dir, "index", "ranges")).toPandas()
    assert len(reads) > 3 and reads.n.max() < len(want) / 2  # copies of one row are spread over ranges
    last = reads.sort_values("before")._range.iloc[-1]
    shutil.rmtree(os.path.join(tmp_dir, "index", "rows", f"_range={last}"))  # other ranges are not touched
    assert Q.PageIndex(spark, os.path.join(tmp_dir, "index")).page(5, 10).count() == 5


def test_keyset_pages_continue(spark):
    df = FX.sales(spark, SMALL).limit(900).unionByName(spark.createDataFrame([(None, None, None, None, None, None), (None, "P1", 1.0, None, 0.0, 2.0)], FX.sales(spark, SMALL).schema)).distinct().cache()
    want = [tuple(r) for r in Q.sales_page(df, limit=10_000).collect()]
    got, last = [], None
    while page := Q.sales_page(df, limit=170, after=last).collect():
        got += [tuple(r) for r in page]
        last = page[-1]
    assert got == want and want[-1][0] is None


def _brute_periods(scores, threshold):
    out, start = [], 0
    for i in range(1, len(scores) + 1):
        gap = i == len(scores) or (not (np.isnan(scores[i]) or np.isnan(scores[i - 1])) and abs(scores[i] - scores[i - 1]) > threshold)
        if gap:
            if i - start > 1:
                out.append((start, i - 1, i - start))
            start = i
    return out


def test_stable_periods_of_a_million_runs(spark):
    n = 1_000_000
    h = spark.range(n, numPartitions=8).select(
        (F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz")).alias("timestamp"),
        F.when(F.col("id") % 1009 == 0, F.lit(None)).otherwise((F.col("id") * 7919 % 1000 / 100).cast("double") + F.floor(F.col("id") / 5000) % 2 * 0.5).alias("overall_score"))
    pdf = h.toPandas()
    got = H.stable_periods(h.orderBy(F.rand(3)), 5.0)
    want = _brute_periods(pdf.overall_score.to_numpy(float), 5.0)
    assert sorted((r["start_index"], r["end_index"], r["duration"]) for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("range#" in x or "edge" in x or "_before" in x or "lag(last" in x for x in windows)


def test_places_of_ties_are_spread(spark):
    scratch = Scratch(spark)
    df = spark.range(40_000).select(F.lit(1).alias("k"), "id")
    placed = with_places(df, [F.col("k")], scratch, ranges=8)
    assert placed.select("place").distinct().count() == 40_000 and placed.agg(F.max("place")).first()[0] == 39_999
    sizes = spark.read.parquet(scratch.paths[0]).groupBy("_range").count().toPandas()
    assert sizes["count"].max() < 20_000
    none = with_places(df.limit(0), [F.col("k")], scratch)
    assert none.count() == 0 and range_totals(spark.read.parquet(scratch.paths[0]), "_range").count() == len(sizes)
    scratch.release()


def test_newest_lines_leave_older_days_unread(spark, tmp_dir):
    logs = FX.log_lines(spark, SMALL)
    path = os.path.join(tmp_dir, "logs")
    H.store_logs(logs.where("timestamp < '2024-01-20'"), path)
    H.store_logs(logs.where("timestamp >= '2024-01-20'"), path)
    names = ["timestamp", "level", "logger", "message", "user_id", "event_id"]
    for limit, level in ((100, "error"), (30, None), (100_000, "warning")):
        got = H.tail_stored(spark, path, limit, level).select(*names).collect()
        assert got == H.tail_logs(logs, limit, level).select(*names).collect()
    days = sorted(d for d in os.listdir(path) if d.startswith("day="))
    assert len(days) > 10
    for d in days[:-8]:
        for f in os.listdir(os.path.join(path, d)):
            if f.endswith(".parquet"):
                with open(os.path.join(path, d, f), "wb") as out:
                    out.write(b"not read")
    newest = H.tail_stored(spark, path, 20)
    assert newest.count() == 20 and len({os.path.dirname(f) for f in newest.inputFiles()}) <= 3
    with pytest.raises(Exception):
        spark.read.parquet(path).select("message").distinct().count()
