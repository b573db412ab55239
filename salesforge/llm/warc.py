"""WARC archives by a deterministic sharded writer, and their reader.

Records are sorted by page id (ties in the order of the input) and range-partitioned by
splitters from a sample that hashes choose, not chance: the same rows in the same files
give the same archives.  A task writes its ranges in order; a file is rolled when its
compressed size reaches ``roll_bytes``, every record is a gzip member of its own, and all
headers, lengths and digests are made anew from the payload.  Of equal payloads of at least
``revisit_bytes`` bytes the one with the smallest page id is written as a response, the
others as revisits of it, with HTTP header and digest but no payload.

Commit: tasks write under ``_temporary`` with a name of their own for each attempt and
report what they wrote; the reports of the attempts that Spark accepted become a written
table, its files are renamed by tasks, and only then ``manifest`` (Parquet, one row per
file) is written.  A reader takes the files that the manifest names and nothing else, so
what a lost executor left behind is never read; every step can be repeated.

Layout: ``part-<range>-<number>.warc.gz``, WARC/1.1, each with a ``warcinfo`` record first;
``X-Page-Id`` and ``X-Refers-To-Page-Id`` are extension fields.

Scale: the payload is written once with row numbers and shuffled once.  Which rows are
revisits is found on (digest, id, number) alone; these narrow decision rows are sorted into
the same ranges just before their records, so no join carries payloads, and a digest that
many rows share is joined by broadcast, never gathered.  There are at most ``max_ranges``
ranges (the sample and the splitters on the driver are bounded by that); a larger table
makes longer ranges, which a task streams into more files.

Edge cases: a null payload is empty; a null id sorts last, is the smallest only where all
are null, and has no ``X-Page-Id``; a null url has no target field, control characters in
one are percent-encoded; repeated rows are records of their own, one of them the response;
an empty table gives a manifest with no rows.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from hashlib import sha256
from uuid import UUID, uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.llm.common import join_groups, pieces_of, slices
from salesforge.llm.shards import range_number
from salesforge.scratch import Scratch, file_system

# The public WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = (1 << 63) - 1  # where a null id sorts
MANIFEST = "range int, number int, temporary string, name string, records long, revisits long, bytes long, sha256 string"
RECORDS = ("page_id long, url string, record_type string, record_id string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


def record_id(page_id: int | None, digest: str, copy: int | None) -> str:
    """A UUID that the record's content decides; ``copy`` tells apart what is no unique
    response."""
    made = bytearray(sha256(f"{page_id}:{digest}:{'' if copy is None else copy}".encode()).digest()[:16])
    made[6], made[8] = made[6] & 0x0F | 0x80, made[8] & 0x3F | 0x80  # UUID version 8
    return f"<urn:uuid:{UUID(bytes=bytes(made))}>"


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record with its length and block digest; fields without a value are left out."""
    fields = [*fields, ("WARC-Block-Digest", f"sha256:{sha256(block).hexdigest()}"), ("Content-Length", len(block))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _target(url: str | None) -> str | None:
    return None if url is None else "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, *, date: str, copy: int | None,
                refers_to: tuple[int | None] | None) -> bytes:
    """A response, or a revisit of the response of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest, copy)),
              ("WARC-Date", date), ("WARC-Target-URI", _target(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("X-Page-Id", page_id), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to[0], digest, None)), ("X-Refers-To-Page-Id", refers_to[0])]
    return record(fields, http if refers_to is not None else http + payload)


class Roll:
    """The files of one range, each closed when its compressed size is reached."""

    def __init__(self, path: str, number: int, date: str, roll_bytes: int, level: int):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(path)
        self.range, self.date, self.roll_bytes, self.level = number, date, roll_bytes, level
        self.number, self.out, self.done = 0, None, []

    def put(self, data: bytes, revisit: bool) -> None:
        if self.out is None:
            name = f"part-{self.range:05d}-{self.number:05d}.warc.gz"
            self.names = [f"_temporary/{name}.{uuid4().hex}", name]
            self.out = self.fs.open_output_stream(f"{self.root}/{self.names[0]}", compression=None)
            self.size, self.records, self.revisits, self.sha = 0, 0, 0, sha256()
            info = f"software: salesforge\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
            self._write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name, None)), ("WARC-Date", self.date),
                                ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))
        self._write(data)
        self.records += 1
        self.revisits += revisit
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, data: bytes) -> None:
        member = zlib.compress(data, self.level, 31)  # gzip without a time
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.range, self.number, *self.names, self.records, self.revisits, self.size, self.sha.hexdigest()))
            self.out, self.number = None, self.number + 1


def _splitters(rows: DataFrame, ranges: int, total: int, oversample: int) -> list[tuple[int, int]]:
    """Boundaries (key, rid) of ``ranges`` ranges of near equal bytes.  A row's odds follow
    its size; the hash of its key is its lot."""
    odds = F.least(F.col("size") * F.lit(ranges * oversample / max(1, total)), F.lit(1.0))
    lot = F.pmod(F.xxhash64("key", "rid"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    drawn = rows.select("key", "rid", odds.alias("odds"), (F.col("size") / odds).alias("weight")).where(lot < F.col("odds"))
    sample = sorted((r["key"], r["rid"], r["weight"]) for r in drawn.collect())  # about ranges * oversample rows
    if not sample:
        return []
    above = np.cumsum([r[2] for r in sample])
    cuts = np.searchsorted(above, above[-1] * np.arange(1, ranges) / ranges)
    return sorted({sample[min(c, len(sample) - 1)][:2] for c in cuts.tolist()})


def revisits(rows: DataFrame, revisit_bytes: int) -> DataFrame:
    """(key, rid, refers_to) of the rows whose payload another row has as a response."""
    long = rows.where(F.col("size") >= revisit_bytes).select("key", "rid", "page_id", "digest")
    groups = long.groupBy("digest").agg(F.min(F.struct("key", "rid", "page_id")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = join_groups(long, groups, ["digest"], "n").where(F.col("rid") != F.col("first.rid"))
    return found.select("key", "rid", F.col("first.page_id").alias("refers_to"))


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               roll_bytes: int = 64 << 20, range_bytes: int = 32 << 20, max_ranges: int = 4096, oversample: int = 16,
               revisit_bytes: int = 100, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> None:
    """Write the archives of ``pages`` to the folder ``path``, which all executors share."""
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    page = F.col(f"`{id_col}`").cast("long")
    rows = pages.select(F.coalesce(page, F.lit(NO_ID)).alias("key"), page.alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), F.unhex(F.sha2(payload, 256)).alias("digest"))
    rows = scratch.table(rows.withColumn("rid", F.monotonically_increasing_id()), "pages", compression="zstd")
    total = rows.agg(F.sum(F.col("size") + 512)).first()[0] or 0
    ranges = min(max_ranges, pieces_of(total, range_bytes, 8))
    found = _splitters(rows.withColumn("size", F.col("size") + 512), ranges, total, oversample)
    decisions = scratch.table(revisits(rows, revisit_bytes), "revisits")

    both = rows.select("key", "rid", F.lit(1).alias("kind"), "page_id", "url", "payload", "digest", F.lit(None).cast("long").alias("refers_to")).unionByName(
        decisions.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = (both.withColumn("range", range_number(found, F.col("key"), F.col("rid")))
             .repartitionById(len(found) + 1, F.col("range")).sortWithinPartitions("range", "key", "rid", "kind"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, decided, done = None, None, []
        for b in slices(batches, 200):
            cols = [c.to_pylist() for c in b.columns]
            for _, rid, kind, page_id, url, body, digest, refers_to, number in zip(*cols):
                if not kind:
                    decided = (rid, refers_to)
                    continue
                if out is None or out.range != number:
                    if out is not None:
                        out.close()
                        done += out.done
                    out = Roll(path, number, date, roll_bytes, level)
                again = decided is not None and decided[0] == rid
                unique = not again and len(body) >= revisit_bytes
                out.put(page_record(page_id, url, body, digest.hex(), date=date, copy=None if unique else rid,
                                    refers_to=(decided[1],) if again else None), again)
        if out is not None:
            out.close()
            done += out.done
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)],
                                         names=["range", "number", "temporary", "name", "records", "revisits", "bytes", "sha256"])

    fs, where = file_system(spark, f"{path}/_temporary")
    fs.mkdirs(where)
    written = scratch.table(dealt.select("key", "rid", "kind", "page_id", "url", "payload", "digest", "refers_to", "range").mapInArrow(write, MANIFEST), "manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        for b in batches:
            for temporary, name, size in zip(*(b.column(i).to_pylist() for i in (2, 3, 6))):
                if store.get_file_info(f"{root}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").size != size:  # no earlier attempt has renamed it
                    raise FileNotFoundError(f"{path}/{temporary}")
            yield b

    written.mapInArrow(rename, MANIFEST).drop("temporary").write.parquet(f"{path}/manifest")
    fs.delete(where, True)
    scratch.release()


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line.rstrip() != VERSION:
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} does not end where it says")
        yield fields, block


def _sha(value: str) -> str:
    kind, _, digest = value.partition(":")
    if kind != "sha256":
        raise ValueError(f"digest of another kind: {kind}")
    return digest


def read_warc(spark: SparkSession, path: str, payloads: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """The page records of the archives that the manifest names (schema ``RECORDS``), in
    no order; every digest is checked against what was read.  A revisit has no payload,
    and without ``payloads`` no record has."""
    manifest = spark.read.parquet(f"{path}/manifest").select("name")
    files = manifest.repartition(max(1, manifest.count()))  # a file is a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in RECORDS.split(", ")]

        def put(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw)) as lines:
                    for fields, block in _records(lines):
                        if sha256(block).hexdigest() != _sha(fields["warc-block-digest"]):
                            raise ValueError(f"record {fields['warc-record-id']} of {name} is damaged")
                        if fields["warc-type"] == "warcinfo":
                            continue
                        head, _, body = block.partition(b"\r\n\r\n")
                        size = int(head.lower().split(b"content-length:", 1)[1].split(b"\r\n", 1)[0])
                        digest, kept = _sha(fields["warc-payload-digest"]), None
                        if fields["warc-type"] == "response":
                            if size != len(body) or sha256(body).hexdigest() != digest:
                                raise ValueError(f"payload of {fields['warc-record-id']} of {name} is damaged")
                            kept = body if payloads else None
                        page, refers = (int(fields[k]) if k in fields else None for k in ("x-page-id", "x-refers-to-page-id"))
                        rows.append((page, fields.get("warc-target-uri"), fields["warc-type"], fields["warc-record-id"], refers, size, digest, kept))
                        held += 200 + len(kept or b"")
                        if held >= batch_bytes:
                            yield put(rows)
                            rows, held = [], 0
                yield put(rows)

    return files.mapInArrow(run, RECORDS)
