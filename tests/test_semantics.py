import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesforge.functions.quantiles import exact_quantiles
from salesforge.functions.semantics import (
    fmt_fixed, fmt_thousands, pairwise_corr, round_half_even, round_significant, safe_div,
)


def test_round_half_even_matches_numpy(spark):
    vals = [0.285, 0.125, 2.675, 1.005, -2.5, 1234.565, 0.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    exp = [None if v is None else float(np.around(v, 2)) for v in vals]
    assert got == exp


def test_round_significant(spark):
    df = spark.createDataFrame([(0.0499185,), (3024008727.8907,), (-1.23456789012345e-7,), (0.0,), (None,)], "x double")
    got = [r[0] for r in df.select(round_significant("x", 10)).collect()]
    assert got[0] == 0.0499185
    assert got[1] == 3024008728.0
    assert math.isclose(got[2], -1.234567890e-7)
    assert got[3] == 0.0 and got[4] is None


def test_safe_div_and_corr_constant(spark):
    df = spark.createDataFrame([(1.0, 0.0, 5.0), (2.0, 0.0, 5.0), (3.0, 0.0, 5.0)], "a double, b double, c double")
    r = df.agg(pairwise_corr("a", "c").alias("r"), F.max(safe_div("a", "b")).alias("d")).first()
    assert r["r"] is None and r["d"] is None


def test_pairwise_corr_is_pairwise(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 7.0), (4.0, 8.5), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = df.agg(pairwise_corr("a", "b")).first()[0]
    a = np.array([1.0, 3.0, 4.0]); b = np.array([2.0, 7.0, 8.5])
    assert math.isclose(got, np.corrcoef(a, b)[0, 1], rel_tol=1e-12)


def test_python_formatting(spark):
    df = spark.createDataFrame([(0.25, 1234567.125), (2.675, 0.375)], "a double, b double")
    got = df.select(fmt_fixed("a", 1), fmt_thousands("b", 2)).collect()
    assert [tuple(r) for r in got] == [(f"{0.25:.1f}", f"{1234567.125:,.2f}"), (f"{2.675:.1f}", f"{0.375:,.2f}")]


@pytest.mark.parametrize("max_candidates,direct_max", [(250_000, 50_000), (250_000, 0), (40, 0)])
def test_exact_quantiles_match_numpy(spark, max_candidates, direct_max):
    rng = np.random.default_rng(7)
    hot = np.full(700, 42.0)  # one value holding a third of the rows
    vals = np.concatenate([rng.lognormal(3, 1.5, 1300), hot, rng.integers(0, 50, 100).astype(float)])
    rng.shuffle(vals)
    rows = [(float(v),) for v in vals] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs, max_candidates=max_candidates, accuracy=200,
                          direct_max=direct_max)["x"]
    exp = np.quantile(vals, probs)
    assert got == [float(e) for e in exp]


def test_exact_quantiles_empty_and_single(spark):
    df = spark.createDataFrame([(None, 3.0)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.25, 0.75])
    assert got == {"a": [None, None], "b": [3.0, 3.0]}


@pytest.mark.parametrize("wrong", [[(900.0, 950.0)], [(10.0, 20.0), (480.0, 490.0)], [(2000.0, 3000.0)]])
def test_quantile_bracket_miss_recovers(spark, monkeypatch, wrong):
    """Brackets that do not contain the target ranks (a sketch failing its bound): the zone
    that the counts name becomes the bracket; the result stays exact."""
    from salesforge.functions import quantiles as QT
    vals = np.arange(1000, dtype=float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    monkeypatch.setattr(QT, "_sketched", lambda *a: ([1000], {0: wrong}))
    probs = [0.001, 0.25, 0.5, 0.999]
    assert QT.exact_quantiles(df, ["x"], probs, max_candidates=100)["x"] == np.quantile(vals, probs).tolist()


def test_quantiles_with_a_rough_sketch_over_many_splits(spark):
    from salesforge.functions import quantiles as QT
    rng = np.random.default_rng(3)
    vals = rng.normal(size=(4000, 2)).round(3)
    df = spark.createDataFrame(vals.tolist(), "x double, y double").repartition(90)
    got = QT.exact_quantiles(df, ["x", "y"], [0.1, 0.5, 0.9], direct_max=0, sketch_k=8, max_candidates=50)
    for at, c in enumerate("xy"):
        assert got[c] == np.quantile(vals[:, at], [0.1, 0.5, 0.9]).tolist()


def test_quantiles_read_the_source_twice(spark):
    """Two scans of the source, whatever the number of columns and probabilities; the
    scratch tables are gone afterwards."""
    from salesforge.functions import quantiles as QT
    from salesforge.scratch import shared_folder
    import glob
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_011).cast("double").alias("x"), F.sqrt("id").alias("y"))
    counted = df.repartition(12).mapInArrow(count, df.schema)
    before = set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/*"))
    got = QT.exact_quantiles(counted, ["x", "y"], [0.25, 0.5, 0.75], direct_max=1000, max_candidates=100)
    pdf = df.toPandas()
    assert got == {c: np.quantile(pdf[c], [0.25, 0.5, 0.75]).tolist() for c in "xy"}
    assert seen.value == 2 * 30_000
    assert set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/*")) == before


def test_approx_quantiles_within_rank_error(spark):
    rng = np.random.default_rng(5)
    vals = rng.normal(size=5000)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], approx=True, accuracy=1000)["x"]
    s = np.sort(vals)
    for p, g in zip([0.25, 0.5, 0.75], got):
        rank = np.searchsorted(s, g)
        assert abs(rank - p * len(s)) <= len(s) / 1000 + 1
