"""Sharding, decontamination, chat examples, URL rules."""

from __future__ import annotations

import zlib
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pytest
from llm_frames import SF, same
from pyspark.sql import functions as F

from salesforge.llm import chat, decontaminate, registry, shards, url_rules
from salesforge.llm.common import Scratch


def check_shards(found: pd.DataFrame, shards: int) -> None:
    """Gapless slots; sizes equal but for a record, or a group of equal texts that is kept
    together; a group of less than a sixteenth of a shard always is."""
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    share = found["size"].sum() / shards
    groups = found.assign(text=found.text.fillna("")).groupby("text").agg(size=("size", "sum"), rows=("size", "size"), shards=("shard", "nunique"))
    assert (groups[groups["size"] < share / 16].shards == 1).all()
    whole = groups[(groups.shards == 1) & (groups.rows > 1)]["size"].max()
    largest = max(found["size"].max(), 0 if pd.isna(whole) else whole)
    sizes = found.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert (sizes - share).abs().max() <= 2 * largest


def test_shard_query(spark, docs):
    found = registry.op2_sampled_splitters(spark, SF).toPandas()
    both = docs.merge(found, on="doc_id")
    assert len(both) == len(found) == len(docs) and both.grown_shard.isna().all() and (both.law == "bytes").all()
    assert [len(t.encode()) + 16 for t in both.text] == both["size"].tolist()
    assert [zlib.crc32(t.encode()) for t in both.text] == both.text_crc32.tolist()
    check_shards(both, 40)


def test_equal_texts_share_a_shard(spark):
    found = registry.op2_sampled_splitters(spark, "/root/testdata/sf0.01").toPandas()
    share = found["size"].sum() / 40
    groups = found.groupby("text_crc32").agg(shards=("shard", "nunique"), rows=("shard", "size"), size=("size", "sum"))
    print(groups[groups.shards > 1])
    assert (groups[groups["size"] < share / 4].shards == 1).all() and (groups.rows > 1).sum() > 50
    assert found["shard"].nunique() > 30 and found.groupby("shard")["size"].sum().max() < share + found["size"].max()


@pytest.mark.parametrize("copies", ["same row", "same text", "none"])
def test_shard_hot_rows(spark, copies):
    rows = [(1 if copies == "same row" and i % 2 else i, "hot" if copies != "none" and i % 2 else f"text {i} " * (i % 7)) for i in range(3000)]
    scratch = Scratch(spark)
    found = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), scratch, shards=8, per_shard=4).toPandas()
    assert sorted(found.text) == sorted(t for _, t in rows)
    check_shards(found, 8)
    ranges = spark.read.parquet(scratch.paths[0]).groupBy("range").agg(F.sum("size").alias("s")).toPandas()
    assert ranges.s.max() < found["size"].sum() / 8
    scratch.release()


def test_shard_edges(spark, edge, empty, tmp_dir):
    scratch = Scratch(spark)
    found = shards.shard(edge.withColumn("slot", F.lit("x")), scratch, shards=5)
    check_shards(found.toPandas(), 5)
    assert found.count() == edge.count() and found.columns == [*edge.columns, "size", "shard", "slot"]
    assert found.where("k1 = 'x' and range = 'x'").count() == edge.count()
    shards.write_shards(found, f"{tmp_dir}/out")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == found.count()
    assert shards.shard(empty, scratch, shards=5).count() == 0
    scratch.release()


def test_leak_query(spark, docs):
    found = registry.op3_simhash_windows(spark, SF).toPandas()
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    assert set(zip(found.doc_id, found.item_id)) == brute.leaks(docs, items)


@pytest.mark.parametrize("block_rows", [1_000_000, 40])
def test_leaks_of_altered_passages(spark, block_rows):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.integers(30, 90)))) for i in range(12)]
    docs = []
    for n in range(120):
        body = [word() for _ in range(rng.integers(0, 60))]
        passage = items[n % 12][1].split()
        for _ in range(n // 24):  # more and more changes
            at = int(rng.integers(len(passage)))
            passage[at:at + 1] = [[], [word()], [word(), passage[at]]][int(rng.integers(3))]
        at = int(rng.integers(len(body) + 1))
        docs.append((n, " ".join([*body[:at], *passage, *body[at:]]).upper() + " !! ," ))
    docs = pd.DataFrame(docs, columns=["doc_id", "text"])
    items = pd.DataFrame(items, columns=["item_id", "text"])
    found = decontaminate.matches(spark.createDataFrame(docs), spark.createDataFrame(items), block_rows=block_rows).toPandas()
    pairs, want = set(zip(found.doc_id, found.item_id)), brute.leaks(docs, items)
    assert pairs <= want and len(pairs) >= 0.97 * len(want) and {(n, n % 12) for n in range(24)} <= pairs


@pytest.mark.parametrize("block_rows", [1_000_000, 50])
def test_leaks_of_swapped_passages(spark, block_rows):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(4, 9)))
    items = [[word() for _ in range(n)] for n in (60, 60, 100, 100, 200, 200, 15)]
    items[6][5:] = ["again"] * 10  # one shingle many times over
    docs = []
    for item in items:
        n = len(item)
        for cuts in ([n // 2], [n // 3, 2 * n // 3], [n // 4]):  # halves, three sentences, unequal parts
            parts = [item[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
            for before, after in ((300, 300), (0, 7), (7, 0)):
                docs.append(" ".join([*(word() for _ in range(before)), *(w for p in parts[::-1] for w in p), *(word() for _ in range(after))]))
    docs.append(" ".join(["again"] * 400 + items[6] + ["again"] * 400))
    docs = pd.DataFrame({"doc_id": range(len(docs)), "text": docs})
    items = pd.DataFrame({"item_id": range(len(items)), "text": [" ".join(w) for w in items]})
    found = decontaminate.matches(spark.createDataFrame(docs), spark.createDataFrame(items), block_rows=block_rows).toPandas()
    pairs, want = set(zip(found.doc_id, found.item_id)), brute.leaks(docs, items)
    assert len(want) > 40 and pairs == want
    whole = found[found.doc_id == len(docs) - 1].iloc[0]
    assert (whole.start, whole.bits, whole.similarity) == (400, 0, 1.0)


@pytest.mark.parametrize("letters", ["ab", "abcdef"])
def test_sliding_prints_and_weights(spark, letters):
    """Every window's fingerprint and common weight against counting it by itself, with
    shingles that occur many times."""
    rng = np.random.default_rng(len(letters))
    doc, item = ["".join(rng.choice(list(letters), n)) for n in (70, 25)]
    places = [(7, at, s) for at, s in enumerate(doc)]
    starts = [(7, start, len(item)) for start in range(len(doc) - len(item) + 1)]
    windows = spark.createDataFrame(starts, "rid long, start int, size int")
    prints = decontaminate.window_prints(spark.createDataFrame(places, "rid long, at int, s string"), windows, ["rid"])
    hashed = spark.createDataFrame([(a, c) for _, a, n in starts for c in doc[a:a + n]], "win int, s string")
    alone = {r["win"]: r["fp"] for r in decontaminate.simhash(hashed, ["win"]).collect()}
    assert {r["start"]: r["fp"] for r in prints.collect()} == alone

    weights = Counter(item)
    held = [(7, len(item), [i for i, c in enumerate(doc) if c == s], n) for s, n in weights.items()]
    held = spark.createDataFrame([x for x in held if x[2]], "rid long, size int, places array<int>, item_w long")
    found = {r["start"]: r["both"] for r in decontaminate.shared_weight(held, windows, ["rid"]).collect()}
    assert found == {a: (Counter(doc[a:a + n]) & weights).total() for _, a, n in starts}


def test_leaks_of_short_items(spark):
    items = spark.createDataFrame([(1, "Net"), (2, "red fox"), (3, "one two three"), (4, "a b c d"), (5, "a b c d e")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the red, FOX ran into a net and the red fox slept"), (2, "fox red netto zero one two four three"), (3, "red fox"),
                                  (4, "zero one two three four five"), (5, "x a b c d e f"), (6, "red"), (7, "a b c d"), (8, "one two")], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["start"], r["bits"], r["similarity"]) for r in decontaminate.matches(docs, items).collect()}
    assert found == {(1, 1): (6, 0, 1.0), (1, 2): (1, 0, 1.0), (3, 2): (0, 0, 1.0), (4, 3): (1, 0, 1.0), (5, 4): (1, 0, 1.0), (5, 5): (1, 0, 1.0), (7, 4): (0, 0, 1.0)}


def test_leak_edges(spark, edge, empty):
    items = spark.createDataFrame([(1, "one, two three FOUR five six"), (2, None), (3, "  "), (4, "a b c"), (4, "a b c"), (None, "other words here")],
                                  "item_id long, text string")
    found = decontaminate.matches(edge, items).toPandas()
    got = set(zip(found.doc_id.fillna(-1), found.item_id.fillna(-1)))
    assert {(11, 1), (4, 4), (6, 4), (8, -1)} <= got and not {d for d, _ in got} & {1, 2, 3, 5, 7, 9, 10}
    scratch = Scratch(spark)
    kept = decontaminate.drop_contaminated(edge, items, scratch)
    assert kept.columns == edge.columns and 11 not in {r["doc_id"] for r in kept.collect()}
    assert decontaminate.drop_contaminated(empty, items, scratch).count() == 0
    assert decontaminate.drop_contaminated(edge, items.limit(0), scratch).count() == edge.count()
    scratch.release()


def test_chat_query(spark):
    rows = pd.read_parquet(f"{SF}/conversations.parquet")
    extra = pd.DataFrame([(-1, 0, "user", registry.EXTRA_TURN), (-1, 1, "assistant", registry.EXTRA_TURN)], columns=rows.columns)
    same(registry.op6_prefix_targets(spark, SF).toPandas(), brute.chat(pd.concat([rows, extra])), "conv_id")


def test_chat_examples_read_back(spark):
    nasty = ["", "\\", "\\n", "<|im_end|>\n", "<\\|x", "\\\\<|im_start|>user\n", "<", "|>\n<|", "a\nb", None, "🙂 é\\|", "\\<|"]
    rows = [(c, t, ["user", "assistant", "sys<|\n\\n"][(c + t) % 3] if t else None, nasty[(c * 5 + t) % len(nasty)])
            for c in range(12) for t in range(7)]
    rows += [(None, None, "assistant", "last"), (None, 1, "user", "first"), (50, 1, "b", "tie"), (50, 1, "a", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.examples(turns.withColumn("t", F.lit(1)).withColumn("last", F.lit(2))).select(
        "*", chat.turns_of(F.col("text")).alias("turns"), chat.loss_of(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"))
    by = {}
    for r in sorted(made.collect(), key=lambda r: r["example"]):
        by.setdefault(r["conv_id"], []).append(r)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        want = [(r[2] or "", r[3] or "") for r in own]
        got = by[conv]
        assert [tuple(t) for t in got[-1]["turns"]] == want
        targets = [i for i, r in enumerate(want) if r[0] == "assistant"]
        assert [g["target"] for g in got if g["target"] is not None] == targets
        assert [g["loss"] for g in got if g["target"] is not None] == [want[i][1] for i in targets]
        for g in got:
            assert [tuple(t) for t in g["turns"]] == want[:(g["target"] if g["target"] is not None else len(want) - 1) + 1]
    none = turns.limit(0)
    assert chat.examples(none).count() == 0


def test_url_query(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet", columns=["page_id", "url"])
    want = pd.DataFrame([(p, *brute.url(u), *brute.judged(u, registry.RULES)) for p, u in zip(pages.page_id, pages.url)],
                        columns=["page_id", "host", "path", "rule", "verdict"])
    same(registry.op7_rare_tokens(spark, SF).toPandas(), want, "page_id")


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://NET/", "http://xnet/", "http://a.NET/x?y", "http://a.net", "http://a.net?/", "x://é.net/#",
            "http://example.net/en", "http://example.net/en/", "http://b.example.net/english", "http://example.net/EN/", "a://b c.net/\n", "http://example.com/de/x",
            "http://example.com/de", "http://example.com/deu/", "http://fr.org/fr/", "http://org/fr/x#y", "a://b://net/", "http://net:80/", "http://ex.ample/", "http://q/p1"]
    rules = [*registry.RULES, url_rules.Rule("block", "ample", ""), url_rules.Rule("block", "q", "/p"), url_rules.Rule("block", "-", "/-")]
    rows = [(i, u, "x") for i, u in enumerate([*urls, *urls])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_rules.judge(pages, rules).toPandas()
    want = pd.DataFrame([(i, *brute.url(u), *brute.judged(u, rules)) for i, u, _ in rows], columns=["page_id", "host", "path", "rule", "verdict"])
    same(found.fillna("-"), want.fillna("-"), "page_id")
    assert url_rules.judge(pages.limit(0), rules).count() == 0 and url_rules.judge(pages, []).where("verdict = 'allow'").count() == len(rows)
