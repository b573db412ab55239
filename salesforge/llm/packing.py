"""Packing into fixed-length sequences by first-fit decreasing.

Documents are tokenised, an end id follows each, and what is longer than a sequence is
cut into full pieces and a rest.  The pieces are dealt at random into groups of about
``group_bytes`` of text; each group is packed on its own, longest piece first, into the
first sequence that still has room, which a tournament tree over the sequences' free
room finds in logarithmic time.

Scale: the number of groups follows the size of the input, so a group (some thousand
documents) fits a task whatever the total; the random dealing keeps groups even when a
source or an id is hot.  Only the rest of each group's last sequences is padding.

Edge cases: null text is empty; an empty document is its end id alone; repeated rows and
null ids are packed like any other.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesforge.llm.common import lean, pieces_of, slices, text_of, utf8
from salesforge.llm.tokens import WORD_PIECES, encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
PACKED = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; ``lengths`` must fall.  ``room[1]`` is the root of the
    tournament: each node holds the larger room of its two children."""
    n = len(lengths)
    leaves = 1 << max(n - 1, 0).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, need in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger
    return bins, offsets


def pieces(docs: DataFrame, *, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id",
           text_col: str = "text", cuts=WORD_PIECES) -> DataFrame:
    """The documents' ids cut into pieces of at most ``capacity`` (schema ``PIECES``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, cuts)
        for b in slices(batches):
            rows: list[tuple] = []
            held = 0
            for doc, ids in zip(b.column(0).to_pylist(), enc.documents(utf8(b.column(1)), end_id)):
                ids = ids.astype("<u4")
                for at in range(0, len(ids), capacity):
                    part = ids[at:at + capacity]
                    rows.append((doc, at, len(part), len(ids), part.tobytes()))
                held += len(ids)
                if held > 4_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)
        lean()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["doc_id", "start", "length", "doc_tokens", "ids"])


def pack(docs: DataFrame, *, tokenizer: str, capacity: int = 4096, end_id: int = 2, group_bytes: int = 16 << 20,
         seed: int = 9, id_col: str = "doc_id", text_col: str = "text", cuts=WORD_PIECES) -> DataFrame:
    """One row per piece (schema ``PACKED``): its ids, its sequence and its place there."""
    size = docs.agg(F.sum(F.octet_length(text_of(text_col)) + 1)).first()[0]
    groups = pieces_of(size, group_bytes)

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        first = pa.compute.fill_null(table.column("doc_id"), -1).to_numpy()
        order = np.lexsort((table.column("start").to_numpy(), first, -lengths))
        bins, offsets = first_fit_decreasing(lengths[order], capacity)
        put = np.empty(len(order), np.int64)
        put[order] = np.arange(len(order))
        base = key[0].as_py() << 32
        table = table.select(["doc_id", "start", "length", "doc_tokens", "ids"])
        table = table.append_column("sequence_id", pa.array(bins[put] + base))
        return table.append_column("offset", pa.array(offsets[put]))

    cut = pieces(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col, cuts=cuts)
    dealt = cut.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(place, PACKED)
