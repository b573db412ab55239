"""The network: gradients, windows, held-out accuracy; and the whole pipeline."""

from __future__ import annotations

from zlib import crc32

import brute
import numpy as np
import pandas as pd
import public_tokenizers
from llm_frames import SF
from pyspark.sql import functions as F

import corpus_pipeline
from salesforge.llm import registry, toxicity
from salesforge.llm.common import Scratch

MID = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network({b"a": 1})
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.standard_normal((3, 5, 6 * toxicity.HIDDEN))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    x[~mask] = net.pad_row()
    d = np.array([0.3, -1.0, 0.7])
    keep: dict = {}
    net.logits(x, mask, keep)
    g, dx = net.gradients(d, keep)

    def loss():
        return float(net.logits(x, mask) @ d)
    for name in g:
        flat, grad = net.p[name].reshape(-1), np.asarray(g[name]).reshape(-1)
        for i in rng.choice(len(flat), min(5, len(flat)), replace=False).tolist():
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - grad[i]) < 2e-3, name
    for i, t, k in [(0, 2, 3), (0, 4, 30), (1, 1, 20), (2, 0, 47)]:
        old = x[i, t, k]
        x[i, t, k] = old + 1e-2
        up = loss()
        x[i, t, k] = old - 1e-2
        down = loss()
        x[i, t, k] = old
        assert abs((up - down) / 2e-2 - dx[i, t, k]) < 2e-3


def test_windows_cover_every_word():
    for n in [0, 1, 31, 32, 33, 47, 48, 49, 64, 500, 1001]:
        places, doc = toxicity.windows(np.array([3, n]), 32)
        own = places[doc == 1]
        assert {p - 3 for p in own[own >= 0].tolist()} == set(range(n))
        if len(own) > 1:
            assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(own, own[1:])) and (own[-1] >= 0).any()


def test_scores_do_not_depend_on_batches(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").toxic.to_dict()
    own = docs[docs.doc_id.isin(labels)]
    net = toxicity.train([t.encode() for t in own.text], [labels[d] for d in own.doc_id])
    texts = [t.encode() for t in [*docs.text.head(40), "", "worthless " * 5000, "x" * 100_000, "née\x00É"]]
    whole = toxicity.Scorer(net).scores(texts)
    small = toxicity.Scorer(net, max_words=10)
    assert np.allclose(whole, [small.scores([t])[0] for t in texts], atol=1e-5)


def test_held_out_accuracy(spark):
    found = registry.op1_gated_windows(spark, MID).toPandas()
    docs = pd.read_parquet(f"{MID}/documents.parquet")
    assert len(found) == len(docs) and found.score.between(0, 1).all() and ((found.score >= 0.5) == (found.predicted == 1)).all()
    import zlib
    assert found.held_out.tolist() == [zlib.crc32(str(d).encode()) % 5 == 0 for d in found.doc_id]
    held = found.merge(pd.read_parquet(f"{MID}/labels.parquet"), on="doc_id")
    held = held[held.held_out]
    pos, neg = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    auc = ((pos[:, None] > neg).mean() + (pos[:, None] >= neg).mean()) / 2
    assert auc > 0.7 and (held.predicted == held.toxic).mean() > 0.88  # 8 toxic documents


def test_toxicity_edges(spark, edge, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert toxicity.score(edge, labels).count() == edge.count()
    assert toxicity.score(empty, labels).count() == 0
    none = toxicity.score(edge, labels.limit(0)).toPandas()
    assert (none.score == 0).all()
    marked = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 1), (5, 0), (7, 1), (4, 0), (6, 0)], "doc_id long, toxic int")
    found = toxicity.score(edge, marked).toPandas()
    assert len(found) == edge.count() and found.score.between(0, 1).all()
    kept = toxicity.drop_toxic(edge.withColumn("score", F.lit("x")), marked, threshold=2.0)
    assert kept.columns == [*edge.columns, "score"] and kept.count() == edge.count()


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, now = Scratch(spark), docs
    for name, stage in corpus_pipeline.STAGES:
        before = now.toPandas()
        now = scratch.table(stage(spark, now, SF), "stage")
        after = now.toPandas()
        if name != "packing":
            assert now.columns == docs.columns and set(after.doc_id) <= set(before.doc_id)
        if name == "exact dedup":
            want = brute.exact(before)
            assert sorted(after.doc_id) == sorted(want[want.kept].doc_id)
        if name == "near dedup":
            assert sorted(after.doc_id) == sorted(set(brute.near(before).component_id))
        if name == "decontamination":
            leaks = brute.leaks(before, pd.read_parquet(f"{SF}/benchmark.parquet"))
            assert sorted(after.doc_id) == sorted(set(before.doc_id) - {d for d, _ in leaks})
        if name == "packing":
            from test_llm_tokens import check_packed
            check_packed(after, brute.token_rows(before, public_tokenizers.path("word_bpe_49k.json")), 4096)
    whole = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, now.select(key).collect()))
    scratch.release()


def test_pipeline_stages_on_edges(spark, edge, empty):
    for rows in (edge, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF)
            out.count()
            assert name == "packing" or out.columns == rows.columns


def test_long_labelled_documents_are_learned_from(spark):
    """Where every labelled document is longer than the training bound, the network still
    learns, from excerpts."""
    rng = np.random.default_rng(2)
    good = ["".join(rng.choice(list("abcdefg"), rng.integers(3, 8))) for _ in range(300)]
    bad = ["".join(rng.choice(list("xyzwq"), rng.integers(4, 8))) for _ in range(12)]
    rows, marks = [], []
    for i in range(80):
        words = rng.choice(good, 1800).tolist()
        if i % 2:
            words = [rng.choice(bad) if rng.random() < 0.1 else w for w in words]
        rows.append((i, " ".join(words)))
        marks.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    assert min(len(t) for _, t in rows) > 8192
    texts, drawn, _ = toxicity.sample(docs, labels, toxic_docs=1500, clean_docs=3000, train_bytes=8192)
    held = [i for i, _ in rows if crc32(str(i).encode()) % 5 == 0]
    assert len(texts) == len(rows) - len(held) and max(map(len, texts)) <= 8192 + 3 and set(drawn) == {0, 1}
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels).collect()}
    right = sum((found[i] >= 0.5) == bool(i % 2) for i in held)
    assert len({round(s, 6) for s in found.values()}) > 1 and right >= 0.8 * len(held)


def test_a_scoring_task_lets_go_of_other_operators_stores(spark):
    """A worker that has packed keeps its encoder for the next packing task only."""
    from salesforge.llm import packing
    docs = spark.createDataFrame([(i, f"plain word{i % 7} " + ("vile" if i % 2 else "kind")) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")

    def holding(batches):
        import gc

        from salesforge.llm.tokens import Encoder
        for b in batches:
            yield pd.DataFrame({"n": [sum(isinstance(x, Encoder) for x in gc.get_objects())] * len(b)})

    packing.pack(docs.coalesce(1), tokenizer=public_tokenizers.path("word_bpe_49k.json")).coalesce(1).collect()
    toxicity.score(docs.coalesce(1), labels).collect()
    assert [r["n"] for r in spark.range(1).coalesce(1).mapInPandas(holding, "n long").collect()] == [0]
