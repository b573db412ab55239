"""Repeated passages by super-k-mer partitioning.

A window is ``k`` consecutive words.  Every window has a minimiser: the smallest hash of
its runs of ``m`` words, without runs that are crowded, or the hash of the whole window
if all its runs are.  Equal windows have equal minimisers.  Consecutive windows of a
document with the same minimiser travel as one packed string of their words to the
bucket of that minimiser, so equal windows meet in one bucket and a word is sent about
three times instead of ``k`` times.
In its bucket the windows are sorted, which puts equal ones side by side; the words
themselves are compared, so no hash decides.  Of equal windows the first one (smallest
doc_id, then earliest start) stays; the words of all others are removed.

Scale: the map side first sorts the windows of a few megabytes of text on its own and
sends each different window once; what repeats there is removed already.  A passage that
a third of all documents share therefore reaches its bucket once per few megabytes.
Buckets are as many as the text has ``bucket_bytes``.  A run of words is crowded if it
stands in the text about ``crowd`` times or more (``crowded_runs``): a short boilerplate
in ever differing surroundings draws no windows to one bucket, they are dealt by their
surroundings.  So a minimiser has at most ``crowd`` places, each with up to 2k - m words
(some 30 MB), besides equal windows, of which there is one per few megabytes.  The driver
holds the crowded runs' hashes, at most two for each ``crowd`` words.  Only doc ids,
starts and packed strings are shuffled, and the texts once to meet their removed ranges.

Edge cases: null text has no words; texts under ``k`` words keep all; documents that
share a doc_id (repeated rows) are told apart and ordered by their place in the table; a
null doc_id comes after all others.  Rows are numbered in a written table, since rows of a
shuffle may come in another order the second time; a caller whose rows have a lasting
number names it (``rid``).  Only the two named columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesforge.llm.common import SHORT, Scratch, packed, pieces_of, slices, utf8

SENT = "bucket long, rid long, lo array<int>, hi array<int>, blob binary"
RANGES = "rid long, lo array<int>, hi array<int>"
KEPT = "doc_id long, n_words long, n_removed long, kept string"
LAST = (1 << 63) - 1  # the order of a null doc_id
_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
NONE = np.uint64((1 << 64) - 1)  # after all hashes
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd; mixes word hashes by place


class Lines:
    """The words of lines of text, one blank between two words: their places in the
    bytes, the line of each, two longs per word and a hash.  The longs are the word
    itself up to 15 bytes and two hashes of a longer one."""

    def __init__(self, text: bytes):
        from xxhash import xxh64_intdigest

        self.text = text
        data = np.frombuffer(text + bytes(16), np.uint8)
        end = data == 10
        solid = ~(end | (data == 32))
        solid[len(text):] = False
        edge = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
        self.start, self.stop = edge[::2], edge[1::2]
        self.line = np.cumsum(end, dtype=np.int32)[self.start]
        lens = self.stop - self.start
        self.long = lens > SHORT
        self.a, self.b = packed(data, self.start, np.minimum(lens, SHORT))
        for i in np.flatnonzero(self.long).tolist():
            word = text[self.start[i]:self.stop[i]]
            self.a[i], self.b[i] = xxh64_intdigest(word), xxh64_intdigest(word, 1)
        self.hash = _mixed(self.a ^ (self.b * MULTIPLIER))

    def window(self, at: int, k: int) -> bytes:
        return self.text[self.start[at]:self.stop[at + k - 1]]

    def equal(self, x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        """Whether the windows at x and y have the same words."""
        out = np.ones(len(x), bool)
        for j in range(k):
            out &= (self.a[x + j] == self.a[y + j]) & (self.b[x + j] == self.b[y + j])
        longs = np.concatenate([[0], np.cumsum(self.long)])
        for i in np.flatnonzero(out & (longs[x + k] > longs[x])).tolist():
            out[i] = self.window(int(x[i]), k) == self.window(int(y[i]), k)
        return out


def one_blank(text: bytes) -> bytes:
    """The words of a text with one blank between them."""
    plain = text.translate(_BLANKS)
    return b" ".join(plain.split()) if b"  " in plain or plain[:1] == b" " or plain[-1:] == b" " else plain


def _rolled(h: np.ndarray, k: int, join) -> np.ndarray:
    """Over every run of k values, by doubling; ``join(a, b, n)`` puts a run before one of
    n values after it.  The last k - 1 places are cut off."""
    out, done, power, n, bits = None, 0, h, 1, k
    while bits:
        if bits & 1:
            out = power if out is None else join(out[:len(power) - done], power[done:], done)
            done += n
        bits >>= 1
        if bits:
            power = join(power[:-n], power[n:], n)
            n *= 2
    return out[:max(len(h) - k + 1, 0)]


def _window_hash(h: np.ndarray, k: int) -> np.ndarray:
    def join(a, b, n):
        m = min(len(a), len(b))
        return a[:m] + b[:m] * np.uint64(pow(int(MULTIPLIER), n, 1 << 64))
    return _rolled(h, k, join)


def _sliding_min(h: np.ndarray, k: int) -> np.ndarray:
    def join(a, b, n):
        m = min(len(a), len(b))
        return np.minimum(a[:m], b[:m])
    return _rolled(h, k, join)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _repeats(lines: Lines, sums: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Whether an equal window stands earlier in ``starts``, for each of these windows;
    ``sums``: the hashes of all windows."""
    again = np.zeros(len(starts), bool)
    if not len(starts):
        return again
    sums = sums[starts]
    order = np.argsort(sums, kind="stable")
    same = np.concatenate([[False], sums[order][1:] == sums[order][:-1]])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))  # first of the run of equal sums
    later = np.flatnonzero(same)
    equal = lines.equal(starts[order[later]], starts[order[head[later]]], k)
    again[order[later[equal]]] = True
    # Different words with one hash: compare the words of those runs.
    for run in np.unique(head[later[~equal]]).tolist():
        stop = run + 1
        while stop < len(order) and same[stop]:
            stop += 1
        seen: set[bytes] = set()
        for at in order[run:stop].tolist():
            words = lines.window(int(starts[at]), k)
            again[at] = words in seen
            seen.add(words)
    return again


def _runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop) of the runs that begin where ``breaks`` is true."""
    first = np.flatnonzero(breaks)
    return first, np.append(first[1:], len(breaks))


def _starts_of(counts: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts in a line of strings: ``counts`` windows in each of strings of
    ``words`` words; and the string of each window."""
    base = np.cumsum(words) - words
    of = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return base[of] + np.arange(len(of)) - begin[of], of


def _frequent(text: bytes, m: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of m words that stand ``least`` times or more, and how often."""
    runs, times = np.unique(_mixed(_window_hash(Lines(text).hash, m)), return_counts=True)
    often = times >= least
    return runs[often], times[often]


def _split(docs: list[tuple], k: int, m: int, buckets: int, squeeze, crowded: np.ndarray) -> Iterator[tuple]:
    """Rows (SENT) for documents (doc_id, rid, text); ``crowded``: sorted hashes of runs
    that are no minimisers."""
    docs.sort(key=lambda d: (LAST if d[0] is None else d[0], d[1]))
    lines = Lines(b"\n".join([one_blank(text) for _, _, text in docs]))
    sizes = np.bincount(lines.line, minlength=len(docs))
    counts = np.maximum(sizes - k + 1, 0)
    if not counts.any():
        return
    starts, doc = _starts_of(counts, sizes, k)
    base = np.cumsum(sizes) - sizes
    sums = _window_hash(lines.hash, k)
    again = _repeats(lines, sums, starts, k)
    # ranges that repeat within these documents
    at = np.flatnonzero(again)
    if len(at):
        breaks = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(doc[at]) != 0)])
        first, stop = _runs(breaks)
        lo, hi = starts[at[first]] - base[doc[at[first]]], starts[at[stop - 1]] - base[doc[at[first]]] + k
        owner = doc[at[first]]
        cut_first, cut_stop = _runs(np.concatenate([[True], np.diff(owner) != 0]))
        for a, b in zip(cut_first.tolist(), cut_stop.tolist()):
            rid = docs[int(owner[a])][1]
            yield rid % buckets, rid, lo[a:b].tolist(), hi[a:b].tolist(), None
    # super-k-mers of the others
    at = np.flatnonzero(~again)
    runs = _mixed(_window_hash(lines.hash, m))
    if len(crowded):
        place = np.minimum(np.searchsorted(crowded, runs), len(crowded) - 1)
        runs[crowded[place] == runs] = NONE
    least = _sliding_min(runs, k - m + 1)[starts[at]]
    if len(crowded):
        least = np.where(least == NONE, _mixed(sums[starts[at]]), least)
    breaks = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(doc[at]) != 0) | (least[1:] != least[:-1])])
    first, stop = _runs(breaks)
    owner, count = doc[at[first]], stop - first
    begin = starts[at[first]]
    from_byte, to_byte = lines.start[begin], lines.stop[begin + count + k - 2]
    doc_order = np.array([LAST if d[0] is None else d[0] for d in docs], np.int64)
    rids = np.array([d[1] for d in docs], np.int64)
    bucket = (least[first] % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    cut_first, cut_stop = _runs(np.concatenate([[True], np.diff(bucket[by_bucket]) != 0]))
    for a, b in zip(cut_first.tolist(), cut_stop.tolist()):
        runs = by_bucket[a:b]
        text = b"\n".join([lines.text[s:e] for s, e in zip(from_byte[runs].tolist(), to_byte[runs].tolist())])
        head = np.stack([doc_order[owner[runs]], rids[owner[runs]], begin[runs] - base[owner[runs]], count[runs]])
        blob = struct.pack("<q", b - a) + head.astype("<i8").tobytes() + text
        yield int(bucket[runs[0]]), None, None, None, squeeze(blob)


def _settle(blobs: list[bytes], k: int) -> Iterator[tuple]:
    """(rid, lo, hi) of what repeats among the windows of one bucket."""
    heads, texts = [], []
    for blob in blobs:
        n, = struct.unpack_from("<q", blob)
        heads.append(np.frombuffer(blob, "<i8", 4 * n, 8).reshape(4, n))
        texts.append(blob[8 + 32 * n:])
    lines = Lines(b"\n".join(texts))
    head = np.concatenate(heads, axis=1)
    sizes = np.bincount(lines.line, minlength=head.shape[1])
    order = np.lexsort((head[2], head[1], head[0]))  # by doc_id, row, start: the first of equals stays
    base = (np.cumsum(sizes) - sizes)[order]
    head = head[:, order]
    run = np.repeat(np.arange(len(order)), head[3])
    nth = np.arange(len(run)) - np.repeat(np.cumsum(head[3]) - head[3], head[3])
    again = np.flatnonzero(_repeats(lines, _window_hash(lines.hash, k), base[run] + nth, k))
    if not len(again):
        return
    place = head[2][run] + nth  # start in the document
    rid = head[1][run]
    breaks = np.concatenate([[True], (np.diff(rid[again]) != 0) | (np.diff(place[again]) != 1)])
    first, stop = _runs(breaks)
    for a, b in zip(again[first].tolist(), again[stop - 1].tolist()):
        yield int(rid[a]), [int(place[a])], [int(place[b]) + k]


def crowded_runs(docs: DataFrame, size: int, *, m: int, crowd: int, chunk_bytes: int) -> np.ndarray:
    """Sorted hashes of runs of ``m`` words in ``docs`` (text) of ``size`` bytes: all that
    stand there ``crowd`` times, and none that stands there less than half as often (runs
    over the edge of two texts count too).

    Each few megabytes report what stands there at least as often as their share of
    ``crowd / 2``.  What they leave out adds up to less than ``crowd / 2`` for any run, so
    one that stands there ``crowd`` times is reported over ``crowd / 2`` times."""
    if size < crowd:  # fewer words than that
        return np.empty(0, np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        room = chunk_bytes

        def put():
            share = sum(map(len, held)) / size
            runs, times = _frequent(b"\n".join([one_blank(text) for text in held]), m, share * crowd / 2)
            return pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(times.astype(np.int64))], names=["run", "times"])

        for b in slices(batches):
            for text in utf8(b.column(0)):
                held.append(text)
                room -= len(text)
                if room < 0:
                    yield put()
                    held, room = [], chunk_bytes
        if held:
            yield put()

    found = docs.select("text").mapInArrow(count, "run long, times long").groupBy("run").agg(F.sum("times").alias("times"))
    rows = found.where(F.col("times") >= crowd / 2).select("run").toArrow()
    return np.sort(rows.column("run").to_numpy().view(np.uint64))


def repeated_ranges(docs: DataFrame, *, k: int, m: int, bucket_bytes: int, chunk_bytes: int, crowd: int) -> DataFrame:
    """(rid, lo, hi): word ranges to remove, for documents (rid, doc_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = pieces_of(size, bucket_bytes)
    crowded = crowded_runs(docs, size, m=m, crowd=crowd, chunk_bytes=chunk_bytes)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        held: list[tuple] = []
        room = chunk_bytes

        def put():
            rows = list(_split(held, k, m, buckets, squeeze, crowded))
            for at in range(0, len(rows), 512):
                columns = list(zip(*rows[at:at + 512]))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                                 names=["bucket", "rid", "lo", "hi", "blob"])

        for b in slices(batches):
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                held.append(row)
                room -= len(row[2])
                if room < 0:
                    yield from put()
                    held, room = [], chunk_bytes
        if held:
            yield from put()

    def meet(table: pa.Table) -> pa.Table:
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        local = table.filter(pa.compute.is_valid(table.column("rid"))).select(["rid", "lo", "hi"])
        blobs = [open_(x) for x in table.column("blob").to_pylist() if x is not None]
        rows = list(_settle(blobs, k)) if blobs else []
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        found = pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["rid", "lo", "hi"])
        return pa.concat_tables([local.cast(found.schema), found])

    sent = docs.select("doc_id", "rid", "text").mapInArrow(send, SENT)
    return sent.groupBy("bucket").applyInArrow(meet, RANGES)


def drop_repeats(docs: DataFrame, *, rid: Column | None = None, k: int = 20, m: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 bucket_bytes: int = 4 << 20, chunk_bytes: int = 8 << 20, crowd: int = 1 << 17) -> DataFrame:
    """One row per document (schema ``KEPT``): the words that stay, joined by a space.
    ``rid`` numbers the rows in their order, alike whenever they are read."""
    named = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    if rid is None:
        docs, number = Scratch(docs.sparkSession).numbered(docs.select(*named))
        named, rid = ["doc_id", "text"], F.col(number)
    rows = docs.select(*named, rid.alias("rid"))
    found = repeated_ranges(rows, k=k, m=m, bucket_bytes=bucket_bytes, chunk_bytes=chunk_bytes, crowd=crowd)
    found = found.groupBy("rid").agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for text, lo, hi in zip(utf8(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                words = text.split()
                if not lo:
                    out.append((len(words), 0, b" ".join(words)))
                    continue
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, np.array(lo), 1)
                np.add.at(change, np.array(hi), -1)
                stay = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                out.append((len(words), len(words) - len(stay), b" ".join([words[i] for i in stay.tolist()])))
            n, gone, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.join(found, "rid", "left").select("doc_id", "text", "lo", "hi").mapInArrow(run, KEPT)
