"""WARC archives: written, read back, compared with plain rules; commit and determinism."""

from __future__ import annotations

import gzip
import hashlib
import os

import pandas as pd
import pytest
from llm_frames import SF, same
from pyspark.sql import functions as F

from salesforge.llm import registry, warc


def plain(pages: pd.DataFrame, least: int = 100) -> pd.DataFrame:
    first, rows = {}, []
    for p, html in pages.sort_values("page_id")[["page_id", "html"]].itertuples(index=False):
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        refers = first.get(body) if len(body) >= least else None
        first.setdefault(body, p)
        rows.append((p, len(body), digest, "response" if refers is None else "revisit", -1 if refers is None else refers))
    return pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def test_warc_query(spark):
    found = registry.op12_sharded_warc(spark, SF).toPandas()
    found["refers_to"] = found["refers_to"].fillna(-1)
    same(found, plain(pd.read_parquet(f"{SF}/pages.parquet")), "page_id")


def hot_pages() -> pd.DataFrame:
    html = [None, "", "x" * 99, "y" * 100, "é" * 50, "\r\n\r\nWARC/1.1\r\n" * 20, "z" * 3000]
    rows = [(i * 8 % 1001, f"http://h/{i}", "same payload " * 30 if i % 3 == 0 else html[i % 7] if i % 5 == 0 else f"page {i} " * (i % 60)) for i in range(1001)]
    return pd.DataFrame(rows, columns=["page_id", "url", "html"])


@pytest.mark.parametrize("ranges", [1, 5])
def test_warc_hot_payload_and_rolling(spark, tmp_dir, ranges):
    pages = hot_pages()
    table = spark.createDataFrame(pages).repartition(4)
    warc.write_warc(table, f"{tmp_dir}/w", roll_bytes=4000, range_bytes=1 << 14 if ranges > 1 else 1 << 30, max_ranges=ranges)
    out = warc.read_warc(spark, f"{tmp_dir}/w")
    found = out.toPandas()
    checked = found.assign(refers_to=found.refers_to.fillna(-1))
    same(checked[["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]], plain(pages), "page_id")
    kept = found[found.record_type == "response"].merge(pages.fillna({"html": ""}), on="page_id")
    assert all(bytes(p).decode() == h for p, h in zip(kept.payload, kept.html)) and (kept.url_x == kept.url_y).all()
    assert found.record_id.is_unique
    files = spark.read.parquet(f"{tmp_dir}/w/manifest").toPandas().sort_values(["range", "number"])
    names = sorted(n for n in os.listdir(f"{tmp_dir}/w") if n.endswith(".gz"))
    assert names == files.name.tolist() and len(names) > ranges and not os.path.exists(f"{tmp_dir}/w/_temporary")
    assert files.records.sum() == len(pages) and files.revisits.sum() == (found.record_type == "revisit").sum()
    order = []
    for name, size, sha in zip(files.name, files.bytes, files.sha256):
        data = open(f"{tmp_dir}/w/{name}", "rb").read()
        assert len(data) == size and hashlib.sha256(data).hexdigest() == sha
        order += [int(x.split(b"\r\n")[0]) for x in gzip.decompress(data).split(b"\r\nX-Page-Id: ")[1:]]
    assert order == sorted(order)


def test_warc_is_deterministic_and_reads_only_its_manifest(spark, tmp_dir):
    hot_pages().to_parquet(f"{tmp_dir}/pages.parquet")
    for name in "ab":
        spark.range(10).repartition(3).count()  # other work in between
        warc.write_warc(spark.read.parquet(f"{tmp_dir}/pages.parquet"), f"{tmp_dir}/{name}", roll_bytes=3000, range_bytes=1 << 14)
    a, b = ({n: open(f"{tmp_dir}/{x}/{n}", "rb").read() for n in os.listdir(f"{tmp_dir}/{x}") if n.endswith("gz")} for x in "ab")
    assert a == b and len(a) > 3
    before = warc.read_warc(spark, f"{tmp_dir}/a").count()
    with open(f"{tmp_dir}/a/part-00000-99999.warc.gz", "wb") as f:  # of an attempt that was lost
        f.write(b"half a file")
    assert warc.read_warc(spark, f"{tmp_dir}/a").count() == before


def test_warc_damage_is_noticed(spark, tmp_dir):
    warc.write_warc(spark.createDataFrame(hot_pages()[:20]), f"{tmp_dir}/w")
    names = [r["name"] for r in spark.read.parquet(f"{tmp_dir}/w/manifest").collect()]
    whole = {n: gzip.decompress(open(f"{tmp_dir}/w/{n}", "rb").read()) for n in names}
    name = next(n for n in names if b"same payload" in whole[n])
    with open(f"{tmp_dir}/w/{name}", "wb") as f:
        f.write(gzip.compress(whole[name].replace(b"same payload", b"lame payload", 1)))
    with pytest.raises(Exception, match="damaged"):
        warc.read_warc(spark, f"{tmp_dir}/w").collect()


def test_warc_edges(spark, tmp_dir):
    long = "long text " * 200_000
    rows = [(1, "http://a/\r\nX: y", "p" * 200), (1, "http://a", "p" * 200), (1, "http://a", "p" * 200), (None, None, "p" * 200), (None, "http://n", "q" * 200),
            (None, "http://n", "q" * 200), (0, None, None), (5, "é", ""), (5, "é", ""), (6, "u", long), (-3, "u", long)]
    table = spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, rid string, `range` string")
    warc.write_warc(table, f"{tmp_dir}/w")
    found = warc.read_warc(spark, f"{tmp_dir}/w").toPandas()
    assert len(found) == len(rows) and found.record_id.is_unique
    got = sorted(zip(found.page_id.fillna(-99).astype(int), found.payload_bytes, found.record_type, found.refers_to.fillna(-99).astype(int)))
    assert got == sorted([(1, 200, "response", -99), (1, 200, "revisit", 1), (1, 200, "revisit", 1), (-99, 200, "revisit", 1), (-99, 200, "response", -99),
                          (-99, 200, "revisit", -99), (0, 0, "response", -99), (5, 0, "response", -99), (5, 0, "response", -99),
                          (6, len(long), "revisit", -3), (-3, len(long), "response", -99)])
    assert "http://a/%0D%0AX: y" in set(found.url)
    warc.write_warc(table.limit(0), f"{tmp_dir}/none")
    assert warc.read_warc(spark, f"{tmp_dir}/none").count() == 0
    warc.write_warc(table.select("page_id", "url", F.lit(None).cast("string").alias("html")), f"{tmp_dir}/null")
    assert warc.read_warc(spark, f"{tmp_dir}/null").where("record_type = 'response' and payload_bytes = 0").count() == len(rows)
