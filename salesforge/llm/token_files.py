"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank of frequency in the corpus, so that most take one byte.
Four values share a control byte of four two-bit lengths; control bytes and data bytes
are two separate streams (the public Stream VByte layout, values little-endian).
Reading looks the four lengths of a control byte up in a table of 256 rows, gathers all
values at once and looks their ids up by rank, in numpy.

Layout of a folder: ``vocabulary`` (rank, token, count) and ``blocks``, Parquet files in
ascending order of document id; a row is a block of whole documents: ``part`` and
``block`` (its place), ``doc_ids``, ``lengths`` (tokens of each), ``before`` (tokens in
earlier blocks of the part), ``tokens``, ``control``, ``data``.

Scale: the texts are tokenised once into a written table; ranks need one count per
token, bounded by the vocabulary; documents are range-partitioned by id (ties and null
ids by a hash of the ids, then at random, so a hot id is split), and every part is
written and read on its own.  The offset of a part is a running sum over one number per
part.

Edge cases: null text is empty; every document has at least its end id; null ids come
first; an empty table gives an empty folder that reads back as no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesforge.llm.common import Scratch, pieces_of, slices, text_of, utf8
from salesforge.llm.tokens import BYTE_PIECES, encoder

IDS = "doc_id long, ids binary"
BLOCKS = ("part int, block long, doc_ids array<long>, lengths array<long>, before long, tokens long, "
          "control binary, data binary")
READ = "part int, before long, doc_id long, ids binary"

#: Lengths in bytes of the four values of each control byte.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.int64)


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    v = values.astype("<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    quads = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    quads[:len(v)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    lens = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lens) - lens
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = raw[at]
    for k in range(1, 4):
        longer = np.flatnonzero(lens > k)
        out[longer] |= raw[at[longer] + k] << np.uint32(8 * k)
    return out


@cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def squeezed(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids for a written table: two bytes each where that is enough."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return bytes([wide]) + _zstd()[0](ids.astype("<u4" if wide else "<u2").tobytes())


def opened(blob: bytes) -> np.ndarray:
    return np.frombuffer(_zstd()[1](blob[1:]), "<u4" if blob[0] else "<u2").astype("<u4")


def token_ids(docs: DataFrame, *, tokenizer: str, end_id: int, id_col: str, text_col: str, cuts) -> DataFrame:
    """(doc_id, ids): the ids of each document, ``squeezed``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, cuts)
        for b in slices(batches):
            done, out, held = 0, [], 0
            for ids in enc.documents(utf8(b.column(1)), end_id):
                out.append(squeezed(ids))
                held += len(ids)
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(done, len(out)), pa.array(out, pa.binary())], names=["doc_id", "ids"])
                    done, out, held = done + len(out), [], 0
            yield pa.RecordBatch.from_arrays([b.column(0).slice(done), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, IDS)


def token_counts(ids: DataFrame) -> DataFrame:
    """(token, count); each task sends one row per token it has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                ids = np.concatenate([opened(x) for x in b.column(0).slice(at, 500).to_pylist()])
                new = np.bincount(ids, minlength=len(seen))
                new[:len(seen)] += seen
                seen = new
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["token", "count"])

    return ids.select("ids").mapInArrow(run, "token long, count long").groupBy("token").agg(F.sum("count").alias("count"))


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", cuts=BYTE_PIECES, part_bytes: int = 32 << 20,
                      block_tokens: int = 1 << 16) -> None:
    """Write the folder described above to ``path``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    stored = scratch.table(token_ids(docs, tokenizer=tokenizer, end_id=end_id, id_col=id_col, text_col=text_col, cuts=cuts), "ids")
    # One row per token of the vocabulary, whatever the size of the corpus.
    counts = [(r["token"], r["count"]) for r in token_counts(stored).orderBy(F.desc("count"), "token").collect()]
    spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(counts)], "rank long, token long, count long") \
        .write.parquet(f"{path}/vocabulary")
    rank = np.zeros(max((t for t, _ in counts), default=0) + 1, np.uint32)
    rank[[t for t, _ in counts]] = np.arange(len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        tokens = 0

        def put() -> pa.RecordBatch:
            values = rank[np.concatenate([x for _, x in held])]
            control, data = pack_values(values)
            row = [part, block, [d for d, _ in held], [len(x) for _, x in held], before, tokens, control, data]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              names=["part", "block", "doc_ids", "lengths", "before", "tokens", "control", "data"])

        for b in slices(batches):
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1)):
                x = opened(ids.as_py())
                held.append((doc, x))
                tokens += len(x)
                if tokens >= block_tokens:
                    yield put()
                    held, block, before, tokens = [], block + 1, before + tokens, 0
        if held:
            yield put()

    size = stored.agg(F.sum(F.octet_length("ids"))).first()[0]
    ordered = (stored.withColumn("tie", F.xxhash64("ids")).withColumn("salt", F.rand(10))
               .repartitionByRange(pieces_of(size, part_bytes), "doc_id", "tie", "salt")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "ids"))
    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")
    scratch.release()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids little-endian unsigned 32-bit; start counts the
    ids of all documents before."""
    # Bounded by the vocabulary.
    table = np.array([r["token"] for r in spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            for part, docs, lengths, before, n, control, data in zip(*(c.to_pylist() for c in b.columns)):
                ids = table[unpack_values(control, data, n)]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array(starts + before, pa.int64()), pa.array(docs, pa.int64()),
                     pa.array([ids[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary())], names=["part", "before", "doc_id", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    docs = blocks.select("part", "doc_ids", "lengths", "before", "tokens", "control", "data").mapInArrow(run, READ)
    # One row per part; the number of parts is a parameter of the writer.
    sums = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    upto = sums.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("earlier"))
    return docs.join(F.broadcast(upto), "part").select(
        "doc_id", (F.col("before") + F.col("earlier")).alias("start"),
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"), "ids")
