"""Exact duplicates by deterministic block naming.

A text loses its white space and is cut into blocks of ``block`` code points.  Equal
blocks get one integer name, different blocks different ones: the blocks are sorted and
numbered.  Then adjacent names are paired and the pairs are named in the same way, until
one name is left of each text.  A name stands for one content only, so two texts have the
same (levels, name) exactly when they are equal; no hash decides.

Scale: the blocks are shuffled once, by content.  A block that more than
``max(least_hot, blocks / max_hot)`` rows hold would fill one task; there are at most
``max_hot`` of those, so they are found by a map-side combined count, named in a table
whose size that bound proves, and joined by broadcast.  Pairs are two integers; their
distinct values are combined before the shuffle, and AQE splits a skewed join of narrow
rows.

Edge cases: null text is empty; empty texts have no block and are equal to each other;
of rows that tie in length and ``doc_id`` (repeated rows) exactly one stays; a null
``doc_id`` comes after all others.  Columns besides the two named ones are not read,
whatever their names, unless ``carry`` asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesforge.llm.common import SPACE_CLASS, Scratch, join_groups, settled, text_of

NO_PARTNER = -(1 << 62)  # stands for the missing right half of an odd pair; never a name


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_CLASS + "+", "")


def _sorted_names(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """A name for every row of ``distinct``: its place in the sorted partition."""
    return settled(distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()))


def _name_blocks(docs: DataFrame, n_blocks: int, least_hot: int, max_hot: int) -> DataFrame:
    """(rid, pos, name, n_blocks) for every block of every text."""
    blocks = docs.select("rid", "n_blocks", F.posexplode("blocks").alias("pos", "block"))
    bound = max(least_hot, n_blocks // max_hot)
    hot_hashes = settled(docs.select(F.explode("blocks").alias("block")).groupBy(F.xxhash64("block").alias("h"))
                         .count().where(F.col("count") > bound).select("h"))
    cold, parts = blocks, []
    if not hot_hashes.isEmpty():
        # At most max_hot blocks (times hash collisions) of at most `block` code points.
        hot = (blocks.select("block", F.xxhash64("block").alias("h")).join(F.broadcast(hot_hashes), "h", "left_semi")
               .groupBy("block").agg(F.count("*").alias("n")))
        hot = settled(hot.select("block", (-F.row_number().over(Window.orderBy("block"))).cast("long").alias("name")))
        tagged = blocks.join(F.broadcast(hot), "block", "left")
        cold = tagged.where(F.col("name").isNull()).drop("name")
        parts.append(tagged.where(F.col("name").isNotNull()).select("rid", "pos", "name", "n_blocks"))
    numbered = (cold.repartition("block").sortWithinPartitions("block")
                .withColumn("at", F.monotonically_increasing_id())
                .withColumn("name", F.min("at").over(Window.partitionBy("block"))))
    parts.append(numbered.select("rid", "pos", "name", "n_blocks"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return settled(out)


def _name_pairs(names: DataFrame, longest: int) -> DataFrame:
    """(rid, level, name): one name for every text that has a block."""
    done = [names.where("n_blocks = 1").select("rid", F.lit(0).alias("level"), "name")]
    now, level = names.where("n_blocks > 1").select("rid", "pos", "name", "n_blocks"), 0
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        right = F.col("pos") % 2 == 1
        pairs = (now.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(~right, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(right, F.col("name"))), F.lit(NO_PARTNER)).alias("b"),
                      F.first("n_blocks").alias("n_blocks")))
        pairs = settled(pairs)
        named = _sorted_names(pairs.select("a", "b").distinct(), ["a", "b"])
        now = settled(pairs.join(named, ["a", "b"]).select(
            "rid", "pos", "name", F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks")))
        done.append(now.where("n_blocks = 1").select("rid", F.lit(level).alias("level"), "name"))
        now = now.where("n_blocks > 1")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def identities(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rid: Column | None = None,
               block: int = 2048, least_hot: int = 2000, max_hot: int = 8000,
               carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, n_chars (code points of the original),
    the ``carry`` columns (expressions over the columns ``text`` and ``norm``), level,
    name, keep_id, group_size, kept.

    Of each group the row with the most code points stays, then the smallest id.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"),
                       (F.monotonically_increasing_id() if rid is None else rid).alias("rid"))
    base = base.withColumn("norm", without_space(F.col("text")))
    cut = F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block), F.lit(0))
    wide = base.select("rid", "doc_id", F.char_length("text").cast("long").alias("n_chars"),
                       *[c.alias(n) for n, c in (carry or {}).items()], cut.alias("blocks"))
    wide = wide.withColumn("n_blocks", F.size("blocks"))
    scratch = Scratch(docs.sparkSession)
    stored = scratch.table(wide, "blocks")
    seen = stored.agg(F.sum("n_blocks").alias("n"), F.max("n_blocks").alias("longest")).first()
    names = _name_blocks(stored, seen["n"] or 0, least_hot, max_hot)
    idents = _name_pairs(names, seen["longest"] or 0)
    rows = (stored.drop("blocks", "n_blocks").join(idents, "rid", "left")
            .withColumn("level", F.coalesce("level", F.lit(-1)))
            .withColumn("name", F.coalesce("name", F.lit(0))))
    rows = settled(rows)
    scratch.release()
    best = rows.groupBy("level", "name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("n_chars")).alias("len"), F.col("doc_id").isNull().alias("none"),
                       "doc_id", "rid")).alias("best"))
    return join_groups(rows, best, ["level", "name"], "group_size", least=least_hot, most=max_hot).select(
        *rows.columns, F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.rid") == F.col("rid")).alias("kept"))


def drop_exact(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Release ``scratch`` once
    the result has been written."""
    stored, rid = scratch.numbered(docs)
    found = identities(stored, rid=F.col(rid), **options)
    kept = found.where("kept").select(F.col("rid").alias(rid))
    return stored.join(kept, rid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
