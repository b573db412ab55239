"""Shards by sampled splitters.

Records are ordered by (hash of the text, doc_id), so equal texts stand side by side.
A sample whose odds grow with a record's size is drawn, its weighted quantiles become
the splitters, the records of each range are counted, and ranges that hold too much are
subdivided by splitters sampled inside them.  Then the records are range-partitioned
once, numbered within their range, and the ranges' exact totals turn these numbers into
places in the whole order.  A shard is an equal share of that order by bytes, except that
equal texts stay together: a group goes where its middle lies, so shard sizes differ by
the size of one group at most.  A group that is larger than a range (about a
``per_shard``-th of a shard) is cut by bytes like anything else; otherwise a text that
makes up a third of the table would fill a third of all shards' room in one.

Scale: only (hash, id, salt, size) is read for sampling and counting; the records are
shuffled once, into ranges of about a ``per_shard``-th of a shard and at most about ``range_bytes``;
the salt splits a range of identical rows.  The sample and the totals have a few rows
per range: the driver holds some ``oversample`` keys for every ``range_bytes`` of text.

Edge cases: null text has no bytes; a null id comes first; repeated rows are records of
their own; an empty table gives no rows; with fewer records than shards some shards are
empty.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesforge.llm.common import Scratch, pieces_of, settled, text_of

OVERHEAD = 16  # bytes a record takes besides its text


def range_number(splitters: list[tuple[int, int]], first: Column, second: Column) -> Column:
    """How many splitters are not above the record's key (first, second)."""
    ordered = sorted(splitters)
    a, b = (np.array([s[i] for s in ordered], np.int64) for i in (0, 1))

    @F.pandas_udf("int")
    def search(x: pd.Series, y: pd.Series) -> pd.Series:
        x, y = x.to_numpy(np.int64), y.to_numpy(np.int64)
        lo, hi = np.searchsorted(a, x, "left"), np.searchsorted(a, x, "right")
        out, shared = lo.copy(), np.flatnonzero(hi > lo)
        # splitters inside one text's copies: the second key decides
        for at in np.unique(lo[shared]).tolist():
            own = shared[lo[shared] == at]
            out[own] = at + np.searchsorted(b[at:hi[own[0]]], y[own], "right")
        return pd.Series(out.astype(np.int32))

    return search(first, second)


def _quantiles(sample: list, upto: int) -> list[tuple[int, int]]:
    """Splitters that cut the sample (k1, k2, weight) into ``upto`` equal weights."""
    if not sample or upto < 2:
        return []
    rows = sorted((r["k1"], r["k2"], r["weight"]) for r in sample)
    above = np.cumsum([r[2] for r in rows])
    cuts = np.searchsorted(above, above[-1] * np.arange(1, upto) / upto)
    return sorted({rows[min(c, len(rows) - 1)][:2] for c in cuts.tolist()})


def _sample(keys: DataFrame, rate: Column, seed: int) -> DataFrame:
    """Every record with odds of its size times ``rate``, at most 1, and the bytes it
    stands for."""
    odds = F.least(F.col("size") * rate, F.lit(1.0))
    return keys.withColumn("odds", odds).where(F.rand(seed) < F.col("odds")).select(
        "*", (F.col("size") / F.col("odds")).alias("weight"))


def splitters(keys: DataFrame, ranges: int, oversample: int, rounds: int) -> list[tuple[int, int]]:
    """Range boundaries for keys (k1, k2, size).  The driver sees about ``ranges *
    oversample`` sampled keys and one total per range."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    found = _quantiles(_sample(keys, F.lit(ranges * oversample / total), 1).collect(), ranges)
    target = total / ranges
    for step in range(rounds):
        ranged = keys.withColumn("range", range_number(found, F.col("k1"), F.col("k2")))
        held = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        over = {r["range"]: r["bytes"] for r in held.where((F.col("bytes") > 2 * target) & (F.col("n") > 1)).collect()}
        if not over:
            break
        # as many samples from each overfull range as it will get splitters, times oversample
        inside = ranged.where(F.col("range").isin(list(over)))
        by: dict[int, list] = {}
        for r in _sample(inside, F.lit(oversample / target), 2 + step).collect():
            by.setdefault(r["range"], []).append(r)
        more = [s for k, rows in by.items() for s in _quantiles(rows, int(over[k] / target) + 1)]
        if not set(more) - set(found):
            break
        found = sorted({*found, *more})
    # A single boundary inside a text's copies moves before them; several mean that the
    # copies fill ranges of their own.
    inside = Counter(k1 for k1, _ in found)
    return sorted({(k1, k2 if inside[k1] > 1 else -1 << 63) for k1, k2 in found})


def shard(docs: DataFrame, scratch: Scratch, *, shards: int, text_col: str = "text", id_col: str = "doc_id",
          per_shard: int = 8, range_bytes: int = 256 << 20, oversample: int = 8, rounds: int = 4) -> DataFrame:
    """All columns of ``docs`` and ``size``, ``shard`` (0 to shards - 1), ``slot`` (0, 1,
    ... within the shard); columns of these three names that ``docs`` has are replaced.
    Release ``scratch`` once the result has been written."""
    text = text_of(text_col)
    keep = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.col(f"`{id_col}`"), F.rand(7)).alias("k2"))
    keys = settled(keyed.select("k1", "k2", "size"))
    ranges = pieces_of(keys.agg(F.sum("size")).first()[0], range_bytes, shards * per_shard)
    found = splitters(keys, ranges, oversample, rounds)
    inside = Window.partitionBy("range").orderBy("k1", "k2")
    placed = (keyed.withColumn("range", range_number(found, F.col("k1"), F.col("k2")))
              .repartitionById(len(found) + 1, F.col("range"))
              .withColumn("row", F.row_number().over(inside).cast("long"))
              .withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    copies = Window.partitionBy("range", "k1")
    placed = (placed.withColumn("from", F.min(F.col("upto") - F.col("size")).over(copies))
              .withColumn("copies_bytes", F.sum("size").over(copies)))
    placed = scratch.table(placed.drop("k2"), "ranges")
    # One row per range, that is one for every range_bytes of the table.
    held = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("k1").alias("low"), F.max("k1").alias("high"))
    order = Window.orderBy("range")
    held = held.select("range", (F.sum("bytes").over(order) - F.col("bytes")).alias("bytes_before"),
                       (F.sum("n").over(order) - F.col("n")).alias("rows_before"),
                       F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
                       F.when(F.col("low") == F.lag("high").over(order), F.col("low")).alias("from_before"),
                       F.when(F.col("high") == F.lead("low").over(order), F.col("high")).alias("into_next"))
    held = settled(held)
    # Copies that go on in another range are cut by bytes, others go as one.
    cut = F.coalesce(F.col("k1") == F.col("from_before"), F.lit(False)) | F.coalesce(F.col("k1") == F.col("into_next"), F.lit(False))
    own = F.when(cut, F.col("upto") - F.col("size") / 2).otherwise(F.col("from") + F.col("copies_bytes") / 2)
    middle = F.col("bytes_before") + own
    spread = placed.join(F.broadcast(held), "range").withColumn(
        "shard", F.least(F.floor(middle * shards / F.col("all_bytes")), F.lit(shards - 1)).cast("int")) \
        .withColumn("place", F.col("rows_before") + F.col("row"))
    first = settled(spread.groupBy("shard").agg(F.min("place").alias("first")))  # one row per shard
    return spread.join(F.broadcast(first), "shard").select(
        *[F.col(f"record.`{c}`") for c in keep], "size", "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its files in the order of the slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
