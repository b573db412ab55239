"""Target-distribution importance resampling."""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import brute
import numpy as np
import pandas as pd
import pytest
from llm_frames import SF, same
from pyspark.sql import functions as F

from salesforge.llm import importance, registry
from salesforge.llm.common import Scratch


def words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs: pd.DataFrame, target: list, lowest=1, most=1, buckets=10_000, percent=10, min_words=20, seed=2024) -> pd.DataFrame:
    def bag(text):
        w = words(text)
        return Counter(crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(lowest, most + 1) for i in range(len(w) - n + 1))
    own = [bag(t) for t in docs.text]
    s, t = sum(own, Counter()), sum(map(bag, target), Counter())
    S, T = s.total(), t.total()
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (S + buckets) / ((s[k] + 1) * (T + buckets)))) for k in s}
    rows = []
    for d, text, b in zip(docs.doc_id, docs.text, own):
        weight = sum(gain[k] * n for k, n in b.items())
        h = int(brute.sha(f"{seed}:{d}")[:8], 16)
        rows.append((d, b.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), len(words(text)) >= min_words))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(fit[:percent * len(fit) // 100])}
    return pd.DataFrame([(*r[:4], rank.get(r[0], -1)) for r in rows], columns=["doc_id", "n_features", "weight", "score", "rank"])


def test_importance_query(spark, docs):
    found = registry.op11_overlapped_ngrams(spark, SF).toPandas()
    assert found["rank"].notna().sum() > 0
    found["rank"] = found["rank"].fillna(-1)
    same(found, plain(docs, pd.read_parquet(f"{SF}/benchmark.parquet").text), "doc_id")


@pytest.mark.parametrize("ngrams", [(1, 2), (2, 3)])
def test_importance_of_longer_grams(spark, docs, ngrams):
    target = docs.text[:20]
    scratch = Scratch(spark)
    made = importance.importance(spark.createDataFrame(docs[["doc_id", "text"]]), spark.createDataFrame(target.to_frame()), scratch,
                                 ngrams=ngrams, buckets=70_000, percent=30, min_words=5, seed=7)
    found = made.toPandas()
    found["rank"] = found["rank"].fillna(-1)
    same(found, plain(docs, target, *ngrams, 70_000, 30, 5, 7), "doc_id")
    # The target's own documents are likelier than the rest.
    inside = found.doc_id.isin(docs.doc_id[:20]) & (found.n_features >= 20)
    per_feature = found.weight / found.n_features.clip(1)
    assert per_feature[inside].mean() > per_feature[~inside].mean()
    scratch.release()


def test_spans_are_overlapped_and_whole_words():
    line = importance.words_line("  The cat,sat--on é2\x00THE\nmat! ".encode())
    assert line.decode() == "the cat sat on é2 the mat"
    for n in (1, 2, 3):
        w = line.decode().split()
        assert [m[0].decode() for m in importance.spans(n).finditer(line, overlapped=True)] == [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
    assert importance.words_line(b"") == b"" and not len(importance.grams(b"", [importance.spans(1)], 10))


def test_importance_edges(spark, edge, empty):
    scratch = Scratch(spark)
    target = spark.createDataFrame([("other words here",), (None,), ("",)], "text string")
    made = importance.importance(edge, target, scratch, percent=100, min_words=1)
    rows = made.toPandas()
    assert len(rows) == edge.count()
    none = rows[rows.n_words == 0]
    assert (none.weight == 0).all() and none["rank"].isna().all() and len(none) == 4
    ranks = sorted(rows["rank"].dropna().astype(int))
    assert ranks == list(range(1, len(rows) - len(none) + 1))
    by = rows.dropna(subset="rank").sort_values("rank").score.to_numpy()
    assert (np.diff(by) <= 0).all()
    drawn = importance.resample(edge, target, scratch, percent=50, min_words=1)
    assert drawn.columns == edge.columns and drawn.count() == (len(rows) - len(none)) // 2 and drawn.where("rid = 'x'").count() == drawn.count()
    assert importance.importance(empty, target, scratch).count() == 0 and importance.resample(empty, target, scratch).count() == 0
    assert importance.importance(edge, target.limit(0), scratch, min_words=1).where("rank is not null").count() == len(ranks) // 10
    scratch.release()


def test_hot_rows_are_ranked_over_ranges(spark):
    hot = spark.range(3000).select((F.col("id") % 3 * 0).alias("doc_id"), F.lit("same words over and over again").alias("text"))
    scratch = Scratch(spark)
    rows = importance.importance(hot, hot.limit(1), scratch, percent=50, min_words=2).toPandas()
    assert sorted(rows["rank"].dropna().astype(int)) == list(range(1, 1501)) and rows.score.nunique() == 1
    scratch.release()
