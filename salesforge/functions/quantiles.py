"""Exact quantiles (linear interpolation, as pandas ``quantile`` / SQL ``quantile_cont``)
that stay distributed at any row count.

Spark's exact ``percentile`` aggregate merges a value->count map of the whole column in a
single final task, which does not survive billions of distinct doubles (and its
interpolation weights the two neighbours, which can differ from ``quantile_cont`` in the
last bit).  Instead a selection in two scans of the source:

1. counts and KLL sketches of all columns, merged in two levels (``MERGE_TASKS`` tasks
   merge those of the input splits, the last one merges theirs), give a bracket of values
   around every target rank;
2. one aggregate counts the rows of every zone that the brackets cut a column into, and
   the values inside brackets one by one.  Rows outside collapse to one row per task on the
   map side, equal values to one entry, so a value holding a third of the table costs
   one row.  The result, the candidates, is written; the source is not read again.

A running count over zones and candidates finds the order statistics exactly, however good
the sketch was: a rank that lies outside every bracket (the sketch's bound holds with high
probability only) takes the zone it lies in as its bracket and the second scan again.
Up to ``max_candidates`` candidates (a few MB) are counted through on the driver; more are
put in order over ranges (``functions.ordered``), the ranges' totals name the one range that
holds a rank, and only that is counted through.  The two
order statistics around ``(n - 1) * p`` are interpolated as numpy does (``quantile_cont``
in SQL engines may differ from it in the last bit).

Every driver round trip carries a bounded result (one row, or a few rows per target).
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesforge.functions.ordered import in_order
from salesforge.functions.semantics import field_type, finite, num
from salesforge.scratch import Scratch

MAX_CANDIDATES = 250_000
ACCURACY = 10_000
DIRECT_MAX = 50_000
SKETCH_K = 8192
MERGE_TASKS = 64


def _position(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    k0 = int(math.floor(h))
    k1 = min(k0 + 1, n - 1) if h > k0 else k0
    return k0, k1, h - k0


def _interp(lo: float, hi: float, frac: float) -> float:
    """numpy's ``lerp`` (what pandas ``quantile`` returns): from the nearer neighbour."""
    if not frac:
        return lo
    diff = hi - lo
    return hi - diff * (1 - frac) if frac >= 0.5 else lo + diff * frac


def approx_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                     accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """One GK pass (``percentile_approx``): rank error at most n / accuracy, and the
    value returned is a data value (no interpolation)."""
    if not columns:
        return {}
    row = df.agg(*[F.percentile_approx(finite(num(df, c)), F.array(*[F.lit(float(p)) for p in probs]), accuracy)
                   .alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return {c: ([float(x) for x in row[f"q{i}"]] if row[f"q{i}"] is not None else [None] * len(probs))
            for i, c in enumerate(columns)}


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    max_candidates: int = MAX_CANDIDATES, accuracy: int = ACCURACY,
                    direct_max: int = DIRECT_MAX, approx: bool = False,
                    sketch_k: int = SKETCH_K) -> dict[str, list[float | None]]:
    """Return ``{column: [q(p) for p in probs]}``; NULL and non-finite values are skipped on
    every path, and a column without values yields ``None``s.  ``approx=True`` trades exactness for a
    single pass (``approx_quantiles``)."""
    if not columns:
        return {}
    if approx:
        return approx_quantiles(df, columns, probs, accuracy)
    scratch = Scratch(df.sparkSession)
    try:
        vals = df.select(*[finite(num(df, c)).alias(f"v{i}") for i, c in enumerate(columns)])
        if any(isinstance(field_type(df, c), T.StringType) for c in columns):
            vals = scratch.table(vals, "values")  # the text is read and parsed once
        ns, brackets = _sketched(vals, len(columns), probs, direct_max, sketch_k)
        ranks = {(i, k) for i, n in enumerate(ns) if n for p in probs for k in _position(n, p)[:2]}
        found: dict[tuple[int, int], float] = {}
        for _ in range(len(ranks) + 1):  # once, unless a sketch was worse than its bound
            if not ranks:
                break
            got, missed = _select(vals, brackets, ranks, max_candidates, scratch)
            found |= got
            ranks = {(i, k) for i, k, _ in missed}
            brackets = {i: _disjoint([z for j, _, z in missed if j == i]) for i, _, _ in missed}
    finally:
        scratch.release()
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for i, c in enumerate(columns):
        for j, p in enumerate(probs if ns[i] else []):
            k0, k1, frac = _position(ns[i], p)
            out[c][j] = _interp(found[i, k0], found[i, k1], frac)
    return out


def _sketched(vals: DataFrame, n_cols: int, probs: list[float], direct_max: int,
              k: int) -> tuple[list[int], dict[int, list[tuple[float, float]]]]:
    """How many values each column has, and its brackets: everything for a small column,
    else three error bounds of the sketch to each side of every probability."""
    cols = range(n_cols)
    part = vals.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS)).alias("g")).agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in cols], *[F.kll_sketch_agg_double(f"v{i}", k).alias(f"s{i}") for i in cols])
    whole = part.agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in cols], *[F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}") for i in cols])
    eps = 3 * 2.296 / k ** 0.9021  # the public bound of KLL's rank error
    at = [min(max(x, 0.0), 1.0) for p in probs for x in (p - eps, p + eps)]
    row = whole.select(*[F.coalesce(f"n{i}", F.lit(0)).alias(f"n{i}") for i in cols],
                       *[F.when(F.col(f"n{i}") > direct_max, F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, at)))).alias(f"b{i}")
                         for i in cols]).first()
    brackets = {}
    for i in cols:
        b = row[f"b{i}"]
        if b is None:
            brackets[i] = [(-math.inf, math.inf)]
        else:
            brackets[i] = _disjoint([(-math.inf if p <= eps else b[2 * j], math.inf if p >= 1 - eps else b[2 * j + 1]) for j, p in enumerate(probs)])
    return [row[f"n{i}"] for i in cols], brackets


def _disjoint(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The closed spans, those that overlap united."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _zone(v: Column, spans: list[tuple[float, float]]) -> Column:
    """0, 1, 2, ... in the order of the values: odd inside a span, even between them."""
    out = None
    for j, (lo, hi) in enumerate(spans):
        for zone, cond in ((2 * j, v < F.lit(lo)), (2 * j + 1, v <= F.lit(hi))):
            out = F.when(cond, F.lit(zone)) if out is None else out.when(cond, F.lit(zone))
    return out.otherwise(F.lit(2 * len(spans)))


def _select(vals: DataFrame, brackets: dict[int, list[tuple[float, float]]], ranks: set[tuple[int, int]],
            max_candidates: int, scratch: Scratch) -> tuple[dict, list]:
    """The values at (column, rank), and (column, rank, zone) of ranks outside brackets."""
    zones = []
    for i, spans in brackets.items():
        v = F.col(f"v{i}")
        zones.append(F.when(v.isNotNull(), F.struct(F.lit(i).alias("c"), _zone(v, spans).alias("z"), v.alias("x"))))
    each = vals.select(F.explode(F.array(*zones)).alias("r")).where(F.col("r").isNotNull()).select("r.*")
    each = each.withColumn("x", F.when(F.col("z") % 2 == 1, F.col("x")))
    cand = scratch.table(each.groupBy("c", "z", "x").agg(F.count(F.lit(1)).alias("n")), "candidates")
    if cand.count() <= max_candidates:  # of the written files' own row counts
        got = _found(cand.toArrow().to_pandas(), ranks)
    else:
        placed = in_order(cand, [F.col("c"), F.col("z"), F.col("x")], scratch)
        # At most a row for each column in each range of the shuffle, whose number is a setting.
        totals = sorted(tuple(r) for r in placed.groupBy("c", "range").agg(F.sum("n").alias("n")).collect())
        wants = []
        for i, k in ranks:
            local = k
            for c, at, n in totals:
                if c == i and local < n:
                    wants.append(((i, at), k, local))
                    break
                local -= n if c == i else 0
        got = _counted(placed.where(F.col("range").isin(sorted({key[1] for key, _, _ in wants}))), ["c", "range"], wants)
    missed = []
    for (i, k), (z, x) in got.items():
        if x is None:
            edges = [-math.inf, *(e for s in brackets[i] for e in s), math.inf]
            missed.append((i, k, (edges[z], edges[z + 1])))
    return {at: x for at, (_, x) in got.items() if x is not None}, missed


def _found(cand: pd.DataFrame, ranks: set[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, float | None]]:
    """(zone, value) at each (column, rank), of few candidates."""
    cand = cand.sort_values(["c", "z", "x"])
    own = {i: (rows, rows["n"].cumsum().to_numpy()) for i, rows in cand.groupby("c")}
    out = {}
    for i, k in ranks:
        rows, upto = own[i]
        hit = rows.iloc[int(np.searchsorted(upto, k, "right"))]
        out[i, k] = int(hit["z"]), None if np.isnan(hit["x"]) else float(hit["x"])
    return out


def _counted(rows: DataFrame, keys: list[str], wants: list[tuple]) -> dict[tuple[int, int], tuple[int, float | None]]:
    """(zone, value) at the local ranks of (group, rank, local rank)."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("z", "x"))
    hit = reduce(Column.__or__, [reduce(Column.__and__, [F.col(c) == v for c, v in zip(keys, key)])
                                 & (F.col("upto") > local) & (F.col("upto") - F.col("n") <= local) for key, _, local in wants])
    got = [(tuple(r[c] for c in keys), r["upto"] - r["n"], r["upto"], (r["z"], r["x"]))
           for r in rows.withColumn("upto", upto).where(hit).collect()]
    return {(key[0], k): next(v for g, a, b, v in got if g == key and a <= local < b) for key, k, local in wants}
