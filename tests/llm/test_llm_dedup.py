"""Exact dedup, near dedup and repeated passages against brute force."""

from __future__ import annotations

import brute
import numpy as np
import pandas as pd
import pytest
from llm_frames import SF, same
from pyspark.sql import functions as F

from salesforge.llm import exact_names, graph, registry, simhash_near, substring
from salesforge.llm.common import Scratch


def test_exact_query(spark, docs):
    same(registry.op4_block_naming(spark, SF).toPandas(), brute.exact(docs), "doc_id")


@pytest.mark.parametrize("options", [{"block": 3}, {"block": 7, "least_hot": 1, "max_hot": 10_000}, {"block": 50_000}])
def test_exact_small_blocks_and_hot_blocks(spark, docs, options):
    few = docs.assign(text=docs.text.str[:400])
    few = pd.concat([few, few.head(40).assign(doc_id=few.doc_id.head(40) + 10_000)])
    found = exact_names.identities(spark.createDataFrame(few[["doc_id", "text"]]), carry={"text_sha256": F.sha2("norm", 256)}, **options)
    same(found.toPandas(), brute.exact(few), "doc_id")


def test_exact_edges(spark, edge, empty):
    found = exact_names.identities(edge).toPandas()
    assert len(found) == edge.count() and found.kept.sum() == found[["level", "name"]].drop_duplicates().shape[0]
    blank = found[found.level == -1]
    assert blank.group_size.unique().tolist() == [4] and blank[blank.kept].doc_id.tolist() == [3]
    abc = found[found.doc_id.isin([4, 5, 6])]
    assert abc.group_size.unique().tolist() == [5] and abc[abc.kept].doc_id.tolist() == [6]
    assert found[found.doc_id.isin([7, 10])].keep_id.tolist() == [7, 7]
    assert exact_names.identities(empty).count() == 0
    scratch = Scratch(spark)
    kept = exact_names.drop_exact(edge, scratch)
    assert kept.columns == edge.columns and kept.count() == found.kept.sum()
    assert exact_names.drop_exact(empty, scratch).count() == 0
    scratch.release()


def test_near_query(spark, docs):
    same(registry.op5_multi_index(spark, SF).toPandas(), brute.near(docs), "doc_id")


def _edges(spark, values, radius, **options):
    fps = spark.createDataFrame([(int(v),) for v in np.unique(values.view(np.int64))], "fp long")
    comps = {r["node"]: r["root"] for r in graph.components(simhash_near.links(fps, radius=radius, **options)).collect()}
    return [comps.get(int(v), int(v)) for v in values.view(np.int64)]


@pytest.mark.parametrize("radius,segments,crowd", [(4, 3, 64), (4, 3, 1), (3, 2, 1), (2, 1, 2), (5, 4, 1), (0, 3, 1), (4, 2, 64), (4, None, 64)])
def test_links_are_complete(spark, radius, segments, crowd):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 12, dtype=np.uint64)
    values = [b for b in base]
    for b in base:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            values.append(b ^ np.uint64(sum(1 << int(f) for f in flips)))
    values = np.array([*values, 0, 0xF, 2**64 - 1], np.uint64)
    want = brute.linked(values, radius)
    found = _edges(spark, values, radius, segments=segments, crowd=crowd)
    pairs = lambda x: len(set(zip(x, want.tolist()))) == len(set(x)) == len(set(want.tolist()))
    assert pairs(found)


def test_fingerprint_words():
    for text in [None, "", " \n", "One", "One TWO three", "a b c d", "a b c d e é É " * 300, "x " * 70_000]:
        assert simhash_near.fingerprint((text or "").encode(), 4) == brute.simhash(text)


def test_near_edges(spark, edge, empty):
    found = simhash_near.near_groups(edge, shingle=4, radius=4).toPandas()
    assert len(found) == edge.count()
    assert found[found.fp == 0].component_id.unique().tolist() == [1]
    assert found[found.doc_id.isin([7, 8, 10]) & (found.component_id == 7)].shape[0] >= 3
    assert simhash_near.near_groups(empty, shingle=4, radius=4).count() == 0
    scratch = Scratch(spark)
    kept = simhash_near.drop_near(edge, scratch, shingle=4, radius=4)
    assert kept.columns == edge.columns and kept.count() == found.component_id.nunique(dropna=False)
    assert simhash_near.drop_near(empty, scratch, shingle=4, radius=4).count() == 0
    scratch.release()


def test_components_long_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {i: 1000 for i in range(1001, 1300)}


def test_substring_query(spark, docs):
    same(registry.op8_super_kmers(spark, SF).toPandas(), brute.substring(docs), "doc_id")


@pytest.mark.parametrize("k,m,chunk", [(5, 2, 3000), (3, 3, 500), (20, 3, 1 << 20), (4, 1, 1)])
def test_substring_small_chunks(spark, docs, k, m, chunk):
    few = docs.head(60).assign(text=docs.text.str[:900])
    found = substring.drop_repeats(spark.createDataFrame(few[["doc_id", "text"]]), k=k, m=m, chunk_bytes=chunk, bucket_bytes=2000)
    found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    same(found.toPandas(), brute.substring(few, k), "doc_id")


def test_substring_of_a_shuffled_input(spark, docs):
    """Rows that come out of a shuffle are numbered once."""
    few = docs.head(60).assign(text=docs.text.str[:900])
    few = pd.concat([few, few.head(20).assign(doc_id=few.doc_id.head(20) + 10_000)])
    frame = spark.createDataFrame(few[["doc_id", "text"]]).repartition(7, F.rand())
    found = substring.drop_repeats(frame, k=5, bucket_bytes=2000, chunk_bytes=3000)
    found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    same(found.toPandas(), brute.substring(few, 5), "doc_id")


def test_segments_follow_the_number_of_fingerprints():
    assert [simhash_near.segments_for(n, 64) for n in (0, 1 << 26, (1 << 26) + 1, 1 << 40)] == [3, 3, 2, 2]
    for segments in (2, 3):
        parts = simhash_near._parts(4, segments)
        assert sum(w for _, w, _ in parts) == 64 and sum(t for _, _, t in parts) == 4 - segments + 1


def test_substring_crowded_runs(spark):
    """Ten shared words in differing surroundings: results stay, and no bucket is hot."""
    rng = np.random.default_rng(8)
    shared = [f"shared{i}" for i in range(10)]
    texts = []
    for i in range(240):
        own = [f"{i}x{j}" for j in range(60)]
        own[30:30] = shared if i % 3 else []
        texts.append(" ".join(own))
    texts += [texts[4], " ".join(texts[7].split()[20:50]), " ".join(shared * 4), " ".join(shared * 3)]
    order = rng.permutation(len(texts))
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": [texts[i] for i in order]})
    frame = spark.createDataFrame(docs)
    size = int(docs.text.str.len().sum())
    crowded = substring.crowded_runs(frame, size, m=3, crowd=100, chunk_bytes=1500)
    assert len(crowded) == 8  # the runs inside the ten words; those over their edges are rare
    for crowd in (2, 100):
        found = substring.drop_repeats(frame, bucket_bytes=500, chunk_bytes=1500, crowd=crowd)
        found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
        same(found.toPandas(), brute.substring(docs), "doc_id")
    rows = [(d, d, t.encode()) for d, t in docs.itertuples(index=False)]

    def largest(crowded):
        sent = {}
        for bucket, _, _, _, blob in substring._split(list(rows), 20, 3, 1 << 40, lambda b: b, crowded):
            sent[bucket] = sent.get(bucket, 0) + len(blob or b"")
        return max(sent.values())
    assert largest(np.empty(0, np.uint64)) > 10 * largest(crowded)


def test_substring_hash_collisions():
    """Windows whose hashes are all equal are still told apart by their words."""
    for tail in (b"", b"-of-more-than-fifteen-bytes"):
        lines = substring.Lines(b" ".join(w + tail for w in [b"a", b"b", b"a", b"b", b"a", b"c", b"a", b"b", b"a"]))
        starts, sums = np.arange(7), substring._window_hash(lines.hash, 3)
        assert substring._repeats(lines, sums, starts, 3).tolist() == [False, False, True, False, False, False, True]
        if tail:
            lines.a[:] = lines.b[:] = 0
            assert substring._repeats(lines, sums * np.uint64(0), starts, 3).tolist() == [False, False, True, False, False, False, True]


def test_one_blank():
    for text in [b"", b" ", b"a", b" a", b"a \n", b"a\tb", b"a  b\r\nc", b"a\x00b\x1c c"]:
        assert substring.one_blank(text) == b" ".join(text.split())


def test_substring_edges(spark, edge, empty):
    found = substring.drop_repeats(edge.coalesce(1)).toPandas()
    assert len(found) == edge.count()
    again = found[found.doc_id == 10].iloc[0]
    assert again.n_removed == again.n_words and again.kept == ""
    tail = found[(found.doc_id == 8) & (found.n_words > 100)].iloc[0]
    assert tail.kept == "tail"
    assert found[found.n_words < 20].n_removed.sum() == 0
    assert substring.drop_repeats(empty).count() == 0
