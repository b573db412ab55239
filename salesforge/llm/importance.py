"""Target-distribution importance resampling over hashed word n-grams.

The n-grams of a text are found by an overlapped regular expression: letters A-Z are
lowered, every run of separators becomes one blank, and ``finditer(overlapped=True)`` with
boundary lookarounds gives the span of each run of ``n`` words, one for every word it can
begin with.  The bytes of a span, words joined by one blank, go straight to CRC-32, whose
remainder is the feature's bucket.  Buckets are counted over all documents and over the
target; the log ratio of the two smoothed distributions is a bucket's gain, the sum of
gains is a document's weight, and weight plus Gumbel noise drawn from the document's id is
its score.  The highest scores are the sample: a draw without replacement with odds that
follow the weights.

Scale: texts are scanned once, into a written table of bucket numbers (two bytes a
feature); counting sends at most ``buckets`` rows per task, and the driver holds the two
counts, bounded by ``buckets`` whatever the corpus.  The ranking range-partitions narrow
rows; the share that is drawn grows with the table, so no task or driver sees it whole.
No rows are grouped by text or source, so hot groups cost nothing; tied ids are salted.

Edge cases: null text has no words; a document with fewer than ``min_words`` words is
weighed but never drawn; a null id draws its noise from the empty text and loses ties;
repeated rows are weighed and drawn on their own; an empty target leaves the corpus'
own counts to decide; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesforge.functions.ordered import with_places
from salesforge.llm.common import slices, text_of, utf8
from salesforge.scratch import Scratch

#: Bytes to what they are read as: A-Z lowered, ASCII letters and digits and every byte of
#: a longer character as they are, all other characters a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
RUN = regex.compile(rb" {2,}")
FEATURES = "doc_id long, rid long, n_words long, n_features long, grams binary"
WEIGHED = "doc_id long, rid long, n_words long, n_features long, weight long, score long"


def spans(n: int) -> regex.Pattern:
    """``n`` whole words, to be searched overlapped: the lookbehind lets a match begin at
    the start of a word only, the lookahead ends it with one."""
    return regex.compile(rb"(?:^|(?<= ))[^ ]++(?: [^ ]++){%d}(?=(?: |$))" % (n - 1))


def words_line(text: bytes) -> bytes:
    """The words of a text with one blank between them."""
    return RUN.sub(b" ", text.translate(FOLD)).strip(b" ")


def grams(line: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The buckets of the n-grams of a line, repeats included."""
    found = [np.fromiter((crc32(m[0]) for m in p.finditer(line, overlapped=True)), np.uint32) for p in patterns]
    return np.concatenate(found) % np.uint32(buckets)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, scratch: Scratch, *, ngrams: tuple[int, int], buckets: int, id_col: str | None,
             text_col: str, rid_col: str | None = None) -> DataFrame:
    """One written row per row of ``docs`` (schema ``FEATURES``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, kind = [spans(n) for n in range(ngrams[0], ngrams[1] + 1)], _kind(buckets)

        def put(b, done, rows):
            n = len(rows)
            kept = [b.column(0).slice(done, n), b.column(1).slice(done, n)]
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            return pa.RecordBatch.from_arrays([*kept, *made], names=["doc_id", "rid", "n_words", "n_features", "grams"])

        for b in slices(batches):
            done, rows, held = 0, [], 0
            for text in utf8(b.column(2)):
                line = words_line(text)
                found = grams(line, patterns, buckets)
                rows.append((line.count(b" ") + 1 if line else 0, len(found), found.astype(kind).tobytes()))
                held += len(found)
                if held > 4_000_000:
                    yield put(b, done, rows)
                    done, rows, held = done + len(rows), [], 0
            yield put(b, done, rows)

    key = F.col(f"`{id_col}`") if id_col else F.lit(None)
    rid = F.col(f"`{rid_col}`") if rid_col else F.lit(None)
    rows = docs.select(key.cast("long").alias("doc_id"), rid.cast("long").alias("rid"), text_of(text_col).alias("text"))
    return scratch.table(rows.mapInArrow(run, FEATURES), "grams")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has; each task sends one row per bucket it has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for b in slices(batches):
            for x in b.column(0):
                seen += np.bincount(np.frombuffer(x.as_buffer(), _kind(buckets)), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    held = found.select("grams").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in held.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the two smoothed distributions, per bucket."""
    n = len(corpus)
    s_all, t_all = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(seed: int | str, doc_id: int | None) -> int:
    """Thousandths of a Gumbel value that the id alone decides."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(found: DataFrame, gain: np.ndarray, seed: int | str) -> DataFrame:
    """Weight and score of every row of ``features``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(len(gain))
        for b in slices(batches):
            weight = [int(gain[np.frombuffer(x.as_buffer(), kind)].sum()) for x in b.column(4)]
            score = [w + noise(seed, d) for w, d in zip(weight, b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                                             names=["doc_id", "rid", "n_words", "n_features", "weight", "score"])

    return found.mapInArrow(run, WEIGHED)


def importance(docs: DataFrame, target: DataFrame, scratch: Scratch, *, ngrams: tuple[int, int] = (1, 1), buckets: int = 10_000,
               percent: int = 10, min_words: int = 20, seed: int | str = 2024, id_col: str = "doc_id", text_col: str = "text",
               target_col: str = "text", rid_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, rid (of ``rid_col``), n_words, n_features,
    weight, score, and rank (from 1 by score; null: not drawn).  ``floor(percent / 100 *
    N)`` rows are drawn of the N with at least ``min_words`` words.  Release ``scratch``
    once the result has been written."""
    shape = dict(ngrams=ngrams, buckets=buckets)
    own = features(docs, scratch, id_col=id_col, text_col=text_col, rid_col=rid_col, **shape)
    wanted = features(target, scratch, id_col=None, text_col=target_col, **shape)
    gain = gains(bucket_counts(own, buckets), bucket_counts(wanted, buckets))
    fit = F.col("n_words") >= min_words
    drawn = own.where(fit).count() * percent // 100
    order = [F.desc(F.coalesce(fit, F.lit(False))), F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = with_places(weighed(own, gain, seed), order, scratch)
    return placed.select("doc_id", "rid", "n_words", "n_features", "weight", "score",
                         F.when(F.col("place") < drawn, F.col("place") + 1).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    numbered, rid = scratch.numbered(docs)
    picked = importance(numbered, target, scratch, rid_col=rid, **options).where("rank is not null")
    return numbered.join(picked.select(F.col("rid").alias(rid)), rid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
