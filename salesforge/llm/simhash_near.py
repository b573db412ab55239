"""Near duplicates by SimHash and multi-index hashing.

A text is lower-cased (A-Z), split at white space and cut into shingles of ``shingle``
words, repeats included.  A bit of the 64-bit fingerprint is 1 if more than half of the
shingles' XXH64 values have it.  Documents whose fingerprints differ in at most
``radius`` bits are linked; a group is a connected component.

Index: the fingerprint is cut into ``segments`` parts with thresholds that add up to
``radius - segments + 1``.  Two fingerprints within the radius are within the threshold
in at least one part (else they would differ in more bits than the radius allows).
So every fingerprint looks up the small Hamming ball around each of its parts in the
table of the parts, and the complete distance of every match is checked.

``segments`` follows from the number of fingerprints: three parts of 21 or 22 bits, each
with a ball of 23 points or one, until an entry would hold half a ``crowd`` by chance
alone; from 2^26 fingerprints on two parts of 32 bits with balls of 529 and 33.

Crowded table entries (more than ``crowd`` fingerprints, as a large group of near copies
makes them) are not expanded into pairs.  The fingerprints that meet there are linked
through the points of the Hamming balls of radius ``radius / 2`` around them: two balls
share a point exactly when the fingerprints are within the radius, and all that share a
point are linked to the smallest of them.  That finds the same links in space
proportional to the number of fingerprints.

Equal fingerprints are one node from the start, so copies cost nothing.

Edge cases: null or blank text has fingerprint zero and is linked like any other; fewer
words than a shingle are one shingle; a null ``doc_id`` is a row like others and is
never chosen as the smallest while the group has another; repeated rows share their
fate.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesforge.llm.common import Scratch, join_groups, settled, slices, utf8
from salesforge.llm.graph import components

BITS = 64
SMALL = 200_000  # rows that may be broadcast


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a UTF-8 text as an unsigned integer."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, 42)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *(stops[:len(words) - shingle]).tolist()]
    ends = (stops[shingle - 1:] - 1).tolist()
    ones, n = np.zeros(BITS, np.int64), len(ends)
    for at in range(0, n, 1 << 16):
        h = np.fromiter((xxh64_intdigest(line[s:e], 42) for s, e in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])),
                        np.uint64, min(1 << 16, n - at))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.fromiter((fingerprint(t, shingle) for t in utf8(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _parts(radius: int, segments: int) -> list[tuple[int, int, int]]:
    """(first bit, width, threshold) of each part."""
    segments = min(segments, radius + 1)
    spare = radius - segments + 1
    out, at = [], 0
    for i in range(segments):
        width = (BITS - at) // (segments - i) + ((BITS - at) % (segments - i) > 0)
        out.append((at, width, spare // segments + (i < spare % segments)))
        at += width
    return out


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` set."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def segments_for(prints: int, crowd: int) -> int:
    """The number of parts, three or two, whose tables stay sparse under ``prints``."""
    return 3 if prints <= crowd // 2 << BITS // 3 else 2


def _value(first: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))


def _entry(part: int, value: Column) -> Column:
    return F.struct(F.lit(part).alias("part"), value.alias("value"))


def _around(part: int, first: int, width: int, threshold: int) -> Column:
    """The entries within the threshold of the part's value."""
    return F.transform(F.lit(ball(width, threshold)), lambda mask: _entry(part, _value(first, width).bitwiseXOR(mask)))


def links(fps: DataFrame, *, radius: int, segments: int | None = None, crowd: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those
    of all pairs within ``radius`` bits."""
    if radius == 0:  # nodes are distinct already
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    parts = _parts(radius, segments or segments_for(fps.count(), crowd))
    own = F.array(*[_entry(i, _value(f, w)) for i, (f, w, _) in enumerate(parts)])
    around = F.concat(*[_around(i, *part) for i, part in enumerate(parts)])
    entries = settled(fps.select("fp", F.explode(own).alias("k")).select("fp", "k.part", "k.value"))
    probes = fps.select("fp", F.explode(around).alias("k")).select("fp", "k.part", "k.value")
    crowded = settled(entries.groupBy("part", "value").count().where(F.col("count") > crowd).select("part", "value"))
    at = ["part", "value"]
    some = crowded.count()
    if some and some <= SMALL:  # a few entries, by a check of their number: the probes stay where they are
        crowded = F.broadcast(crowded)
    roomy = entries.join(crowded, at, "left_anti") if some else entries
    found = (probes.withColumnRenamed("fp", "a").join(roomy.withColumnRenamed("fp", "b"), at).where("a <> b")
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b"))
    if not some:
        return found
    dense = settled(probes.join(crowded, at, "left_semi").select("fp").distinct())
    return found.unionByName(_ball_links(dense, radius))


def _ball_links(dense: DataFrame, radius: int) -> DataFrame:
    """The links of ``dense`` by shared points of the balls around the fingerprints."""
    half, odd = divmod(radius, 2)
    sides = []
    # An odd radius needs one bit more on one side: the pair then meets in a point that is
    # half away from the one and half + 1 from the other.
    for more in (0, 1) if odd else (0,):
        masks = F.lit(np.array(ball(BITS, half + more), dtype=np.int64).tolist())
        sides.append(dense.select("fp", F.explode(masks).alias("mask"), F.lit(more).alias("more")))
    points = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    points = points.select("fp", "more", F.col("fp").bitwiseXOR(F.col("mask")).alias("z"))
    if odd:
        # Only a wide and a narrow ball may meet; the smallest narrow one is the hub.
        hubs = points.where("more = 0").groupBy("z").agg(F.min("fp").alias("hub"))
    else:
        hubs = points.groupBy("z").agg(F.min("fp").alias("hub"), F.max("fp").alias("last")).where("hub < last").drop("last")
    met = points.join(hubs, "z").where("fp <> hub")
    return met.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def near_groups(docs: DataFrame, *, shingle: int, radius: int, id_col: str = "doc_id", text_col: str = "text",
                segments: int | None = None, crowd: int = 64) -> DataFrame:
    """(doc_id, fp, component_id, group_size), one row per row of ``docs``; component_id
    is the smallest doc_id of the group."""
    prints = settled(fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col))
    nodes = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = components(links(nodes.select("fp"), radius=radius, segments=segments, crowd=crowd))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("prints"))
    placed = join_groups(placed.select("fp", "root", "n"), groups, ["root"], "prints").select("fp", "n", "component_id", "group_size")
    return join_groups(prints, placed, ["fp"], "n").select("doc_id", "fp", "component_id", "group_size")


def drop_near(docs: DataFrame, scratch: Scratch, *, shingle: int, radius: int, text_col: str = "text",
              id_col: str = "doc_id", **options) -> DataFrame:
    """One row of each group: the one with the smallest id, then the first row.  All
    columns of ``docs``.  Release ``scratch`` once the result has been written."""
    stored, rid = scratch.numbered(docs)
    found = near_groups(stored, shingle=shingle, radius=radius, id_col=rid, text_col=text_col, **options)
    named = stored.select(F.col(rid), F.col(f"`{id_col}`").alias("id"))
    best = (found.withColumnRenamed("doc_id", rid).join(named, rid).groupBy("component_id")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col(rid))).alias("best"))
            .select(F.col(f"best.{rid}").alias(rid)))
    return stored.join(best, rid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
