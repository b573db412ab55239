"""Benchmark decontamination by SimHash of item-sized windows.

Words are runs of letters and digits, lower-cased; shingles are ``shingle`` consecutive
words.  A window has the size of an item.  The places of a document whose shingle stands
in any item of that size are counted over the window's length: where fewer are hit than
the similarity needs, no item of the size can reach it, and every other start gets a
window and a SimHash, wherever in the item the hits stand.  The items' fingerprints are
indexed by four 16-bit blocks, each with all values at most ``radius // 4`` bits away: a
window within ``radius`` bits of an item has at least one block within that many bits of
the item's (otherwise the distance would be larger), so no such window is missed.  Of
the candidates the whole distance is checked and then the exact similarity: common over
all shingles, each weighted by how often it occurs.

No window is written as text.  A document's shingles are hashed once and the 64 bit
counters run along them; a window's counts are the difference of two running sums.  The
exact similarity slides too: each occurrence of an item's shingle adds one range of
window starts.  So the work grows with documents and windows, not with windows times the
item's length.

Scale: documents are numbered in a written table and read twice.  A map-side join with
the items' shingles, broadcast in blocks of at most ``block_rows`` rows (one pass over
the documents a block), leaves the hit places, which meet per document and size.  The
part of each document that its windows cover is cut out in a second read: its bounds are
broadcast if they are at most ``block_rows``, else joined by the document's number.
Everything after that works on these parts and the items.  A passage that many documents
share is looked up once, by its fingerprint, and fingerprints and items that many windows
meet are joined as hot groups; nothing is grouped by passage.

Edge cases: null text is empty; items or documents with fewer words than a shingle are
one shingle of all their words, and such an item matches wherever its words stand in a
document one after the other; an item without words matches nothing; items with the
same text are all reported; rows that share a doc_id or item_id (repeated rows, null)
are told apart while matching and reported under that id.  Only the named columns are
read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesforge.llm.common import Scratch, join_groups, settled, text_of

BLOCKS, WIDTH = 4, 16
LOW32 = (1 << 32) | 1  # the lowest bit of each half of a long


def words_of(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " ", -1))


def _places(n: Column, shingle: int) -> Column:
    """The places where a shingle starts among ``n`` words."""
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))))


def _shingle_at(words: str, at: Column, shingle: int) -> list[Column]:
    return [F.get(F.col(words), at + j) for j in range(shingle)]


def _shingles(rows: DataFrame, shingle: int) -> DataFrame:
    """One row per shingle (column s) of rows with the column words, which is dropped."""
    keep = [c for c in rows.columns if c != "words"]
    at = rows.select(*rows.columns, F.explode(_places(F.size("words"), shingle)).alias("at"))
    return at.select(*keep, "at", F.concat_ws(" ", *_shingle_at("words", F.col("at"), shingle)).alias("s"))


def _counters() -> list[Column]:
    """The bits of the hash h as 32 longs of two counters each: bit b, and bit b + 32 in
    the upper half."""
    return [F.shiftrightunsigned("h", b).bitwiseAND(F.lit(LOW32)) for b in range(32)]


def _majority(held: Column) -> Column:
    """The fingerprint (long) from the counters' sums c0 to c31 over ``held`` shingles:
    bit b is 1 if more than half of their hashes have it."""
    fp = F.lit(0).cast("long")
    for b in range(32):
        low = F.col(f"c{b}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"c{b}", 32)
        for count, bit in ((low, b), (high, b + 32)):
            fp = fp.bitwiseOR(F.when(2 * count > held, F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return fp


def simhash(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp``: the fingerprint of each group of shingles (column s)."""
    hashed = shingles.withColumn("h", F.xxhash64("s"))
    counted = hashed.groupBy(*keys).agg(F.count("*").alias("held"), *[F.sum(c).alias(f"c{b}") for b, c in enumerate(_counters())])
    return counted.select(*keys, _majority(F.col("held")).alias("fp"))


def window_prints(shingles: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """``windows`` (keys, start, size and more) with ``fp``, the fingerprint of the ``size``
    shingles from place ``start`` on among ``shingles`` (keys, at, s).

    A window's sums are the difference of the running sums before its end and before its
    start, so the work grows with shingles and windows and not with their product."""
    carried = [c for c in windows.columns if c not in keys]
    edges = windows.select(*windows.columns, F.explode(F.array(
        F.struct(F.col("start").alias("pos"), F.lit(-1).alias("sign")),
        F.struct((F.col("start") + F.col("size")).alias("pos"), F.lit(1).alias("sign")))).alias("e"))
    edges = edges.select(*windows.columns, "e.pos", "e.sign")
    rows = shingles.select(*keys, F.col("at").alias("pos"), F.xxhash64("s").alias("h")).unionByName(edges, allowMissingColumns=True)
    before = (Window.partitionBy(*keys).orderBy("pos", F.col("h").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"c{b}") for b, c in enumerate(_counters())]
    summed = rows.select(*windows.columns, "sign", *sums).where(F.col("sign").isNotNull())
    counted = summed.groupBy(*keys, *carried).agg(*[F.sum(F.col("sign") * F.col(f"c{b}")).alias(f"c{b}") for b in range(32)])
    return counted.select(*windows.columns, _majority(F.col("size")).alias("fp"))


def shared_weight(places: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """``windows`` (keys, start and more) with ``both``, the weight that a window has in
    common with its item.  ``places`` (keys, size, places, item_w) has a row per shingle of
    the item that the document has: its sorted places there and its weight in the item.

    Of a shingle's occurrences in a window the last ``item_w`` count.  An occurrence is
    among them in the windows that hold it and not the ``item_w``-th one after it: one
    range of starts, so that running sums over the ends of these ranges give all windows."""
    def ends(at: Column, i: Column) -> Column:
        after = F.get("places", i + F.col("item_w"))
        lo, hi = at - F.col("size") + 1, F.least(at, F.coalesce(after - F.col("size"), at))
        return F.when(lo <= hi, F.array(F.struct(lo.alias("pos"), F.lit(1).alias("step")), F.struct((hi + 1).alias("pos"), F.lit(-1).alias("step"))))

    steps = places.select(*keys, F.explode(F.flatten(F.filter(F.transform("places", ends), lambda x: x.isNotNull()))).alias("e"))
    steps = steps.groupBy(*keys, F.col("e.pos").alias("pos")).agg(F.sum("e.step").alias("step"))
    rows = steps.unionByName(windows.withColumn("pos", F.col("start")), allowMissingColumns=True)
    so_far = (Window.partitionBy(*keys).orderBy("pos", F.col("start").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("both", F.coalesce(F.sum("step").over(so_far), F.lit(0))).where(F.col("start").isNotNull())
            .select(*windows.columns, "both"))


def _block(i: int, mask: Column | None = None) -> Column:
    value = F.shiftrightunsigned("fp", i * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))
    return value if mask is None else value.bitwiseXOR(mask)


def _weight(n: Column, shingle: int) -> Column:
    """How many shingles ``n`` words have."""
    return F.greatest(n - shingle + 1, F.lit(1))


def _starts(hits: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(rid, doc_id, item_n, size, starts): all starts of windows of item_n words (size
    shingles) with enough hits, for hit places (rid, doc_id, n, item_n, at) of documents of
    n words.

    If c hits are needed, a window has them if it begins at or before some hit and ends
    with or after the (c - 1)th hit after that; the starts each hit adds to those before
    it are one range."""
    size = _weight(F.least("n", "item_n"), shingle)  # shingles of a window
    need = (size + _weight(F.col("item_n"), shingle)) * (similarity / (1 + similarity))
    spots = (hits.groupBy("rid", "doc_id", "n", "item_n").agg(F.sort_array(F.collect_list("at")).alias("places"))
             .select("rid", "doc_id", "item_n", "places", size.alias("size"), F.greatest(F.col("n") - F.col("item_n"), F.lit(0)).alias("last"),
                     F.greatest(F.ceil(need - 1e-6).cast("int"), F.lit(1)).alias("need"))
             .where(F.size("places") >= F.col("need")))

    def added(i: Column) -> Column:
        before = F.when(i > 0, F.least(F.get("places", i - 1), F.col("last"))).otherwise(F.lit(-1))
        lo = F.greatest(F.get("places", i + F.col("need") - 1) - F.col("size") + 1, before + 1)
        hi = F.least(F.get("places", i), F.col("last"))
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    spots = spots.select("rid", "doc_id", "item_n", "size", F.flatten(F.transform(F.sequence(F.lit(0), F.size("places") - F.col("need")), added)).alias("starts"))
    return spots.where(F.size("starts") > 0)


def matches(docs: DataFrame, items: DataFrame, *, shingle: int = 5, similarity: float = 0.8, radius: int = 15,
            rid: Column | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", block_rows: int = 500_000) -> DataFrame:
    """(rid, doc_id, item_id, start, bits, similarity): the best window (first word
    ``start``) of each document row and item."""
    bench = items.select(F.col(f"`{item_col}`").alias("item_id"), words_of(text_of(item_text_col)).alias("words"))
    bench = settled(bench.withColumn("n", F.size("words")).where("n > 0")
                    .withColumn("item", F.monotonically_increasing_id()))
    anchors = bench.select("words", "n", F.explode(_places(F.col("n"), shingle)).alias("at"))
    anchors = settled(anchors.select(
        F.xxhash64(*_shingle_at("words", F.col("at"), shingle)).alias("h"), F.col("n").alias("item_n")).distinct())

    scratch = Scratch(docs.sparkSession)
    if rid is None:
        docs, number = scratch.numbered(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
        rid = F.col(number)
    text = docs.select(rid.alias("rid"), F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    own = text.select("rid", "doc_id", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    # An item of fewer words than a shingle is one run of all its words: runs of that length count for it.
    short = sorted(r["n"] for r in bench.where(F.col("n") < shingle).select("n").distinct().collect())
    at = own.select("rid", "doc_id", "words", "n", F.explode(_places(F.col("n"), min([shingle, *short]))).alias("at"))
    runs = F.array(*[F.when(F.col("at") + length <= F.col("n"), F.xxhash64(*_shingle_at("words", F.col("at"), length)))
                     for length in [shingle, *short]])
    runs = at.select("rid", "doc_id", "n", "at", (F.explode(runs) if short else F.get(runs, F.lit(0))).alias("h"))

    # The benchmark's shingles in blocks: each is broadcast and is bounded by block_rows.
    blocks = max(1, -(-anchors.count() // block_rows))
    hits = None
    for i in range(blocks):
        part = F.broadcast(anchors.where(F.pmod("h", F.lit(blocks)) == i))
        hit = runs.join(part, "h").select("rid", "doc_id", "n", "item_n", "at")
        hits = hit if hits is None else hits.unionByName(hit)
    length = F.least(F.col("item_n"), F.lit(shingle)).alias("length")  # words of a shingle
    spots = settled(_starts(hits, shingle, similarity).select("*", length))

    # The part of each document that its windows cover, and its shingles.
    areas = settled(spots.groupBy("rid", "length").agg(F.min(F.array_min("starts")).alias("lo"),
                                                       F.max(F.array_max("starts") + F.col("size")).alias("hi")))
    if areas.count() <= block_rows:
        areas = F.broadcast(areas)
    covered = F.slice(words_of(F.col("text")), F.col("lo") + 1, F.col("hi") - F.col("lo") + F.col("length") - 1)
    covered = settled(text.join(areas, "rid").select("rid", "length", "lo", F.concat_ws(" ", covered).alias("covered")))
    scratch.release()

    def shingles_of(parts: DataFrame) -> DataFrame:
        at = parts.select("rid", "length", "lo", F.split("covered", " ", -1).alias("words"))
        at = at.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("i"))
        return at.select("rid", "length", (F.col("lo") + F.col("i")).alias("at"),
                         F.concat_ws(" ", F.slice("words", F.col("i") + 1, F.col("length"))).alias("s"))

    # Fingerprints of windows and items; the index of the items with their Hamming balls.
    windows = spots.select("rid", "length", "doc_id", "item_n", "size", F.explode("starts").alias("start"))
    windows = settled(window_prints(shingles_of(covered), windows, ["rid", "length"]))
    item_fp = simhash(_shingles(bench.select("item", "n", "words"), shingle), ["item", "n"])
    reach = radius // BLOCKS
    ball = [sum(1 << b for b in bits) for r in range(reach + 1) for bits in combinations(range(WIDTH), r)]
    index = item_fp.select("item", "n", "fp", F.explode(F.lit(ball)).alias("mask"))
    index = index.select("item", F.col("n").alias("item_n"), F.col("fp").alias("item_fp"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _block(i, F.col("mask")).alias("value")) for i in range(BLOCKS)])).alias("k"))
    index = index.select("item", "item_n", "item_fp", "k.block", "k.value")
    # A passage of many documents has one fingerprint, which is looked up once.
    probes = windows.groupBy("item_n", "fp").agg(F.count("*").alias("holders"))
    probes = probes.select("item_n", "fp", "holders", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _block(i).alias("value")) for i in range(BLOCKS)])).alias("k"))
    probes = probes.select("item_n", "fp", "holders", "k.block", "k.value")
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # The index grows with the benchmark and its size is not checked: no broadcast.
    near = probes.join(index.hint("merge"), ["block", "value", "item_n"]).withColumn("bits", bits).where(F.col("bits") <= radius)
    near = near.select("item_n", "fp", "holders", "item", "bits").distinct()
    near = settled(join_groups(windows, near, ["item_n", "fp"], "holders")
                   .select("rid", "item", "doc_id", "length", "size", "start", "bits"))

    # Exact weighted similarity of the candidates: words themselves, counted.
    pairs = settled(near.select("rid", "item", "size").distinct())
    found_in = settled(pairs.groupBy("item").agg(F.count("*").alias("holders")))
    item_s = _shingles(bench.select("item", "words"), shingle).groupBy("item", "s").agg(F.count("*").alias("item_w"))
    wanted = join_groups(pairs, item_s.join(found_in, "item"), ["item"], "holders").select("rid", "item", "size", "s", "item_w")
    # Few of the parts have candidates.
    parts = covered.join(near.select("rid", "length").distinct(), ["rid", "length"], "left_semi")
    places = shingles_of(parts).groupBy("rid", "s").agg(F.sort_array(F.collect_list("at")).alias("places"))
    places = wanted.join(places, ["rid", "s"]).select("rid", "item", "size", "item_w", "places")
    # The windows of a pair have one size, so the most common weight is the best similarity.
    best = (shared_weight(places, near.drop("length"), ["rid", "item"]).groupBy("rid", "item", "size")
            .agg(F.min(F.struct((-F.col("both")).alias("order"), "bits", "start", "doc_id")).alias("b"))
            .select("rid", "item", "size", (-F.col("b.order")).alias("both"), "b.bits", "b.start", "b.doc_id"))
    named = bench.select("item", "item_id", _weight(F.col("n"), shingle).alias("item_size")).join(found_in, "item")
    value = F.col("both") / (F.col("size") + F.col("item_size") - F.col("both"))
    return (join_groups(best, named, ["item"], "holders").withColumn("similarity", value).where(F.col("similarity") >= similarity)
            .select("rid", "doc_id", "item_id", "start", "bits", "similarity"))


def drop_contaminated(docs: DataFrame, items: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of ``docs`` without any match, with all their columns.  Release
    ``scratch`` once the result has been written."""
    stored, rid = scratch.numbered(docs)
    hit = matches(stored, items, rid=F.col(rid), **options).select(F.col("rid").alias(rid)).distinct()
    return stored.join(hit, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
