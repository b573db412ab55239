"""Tokenising, packing, token files: exact round trips."""

from __future__ import annotations

import brute
import numpy as np
import public_tokenizers
import pytest
from llm_frames import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from salesforge.llm import packing, registry, token_files
from salesforge.llm.common import Scratch
from salesforge.llm.tokens import BYTE_PIECES, WORD_PIECES, Encoder, encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(st.one_of(st.sampled_from("abÀé'st.,!?|%*#&$ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　é́Σς1²漢🙂<|>"), st.characters(exclude_categories=["Cs"])), max_size=60)
PLAIN = st.lists(st.sampled_from(["a", "the", "Élan", "don't", "x.y", "end.", "what?!", "|", "\0", "\0a", "a1", "é", "×2", "日", "long" * 6, "née!!"]), max_size=12).flatmap(
    lambda w: st.sampled_from([" ", "\n", " \n"]).map(lambda gap: gap.join(w)))


@pytest.mark.parametrize("path,cuts", [(WORD, WORD_PIECES), (BYTE, BYTE_PIECES)])
def test_pieces_give_the_tokenizers_ids(path, cuts):
    enc = encoder(path, cuts)

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.one_of(TEXT, PLAIN), max_size=5))
    def check(texts):
        found = [x.tolist() for x in enc.documents([t.encode() for t in texts], 2)]
        assert found == [[*enc.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    check()


@pytest.mark.parametrize("path,cuts", [(WORD, WORD_PIECES), (BYTE, BYTE_PIECES)])
def test_the_tokenizers_own_tokens_in_texts(path, cuts):
    from tokenizers import Tokenizer

    library, enc = Tokenizer.from_file(path), encoder(path, cuts)
    own = sorted({t.content for t in library.get_added_tokens_decoder().values()} | {"<|endoftext|>", "<|startoftext|>", "<|ENDoftext|>"})
    texts = [f"a{gap}{t}{gap}b.{t}{t} \n {t}|end" for t in own for gap in ("", " ", "  ", "\n")] + own + ["plain words, as ever", "", "<|endoftext|"]
    found = [x.tolist() for x in enc.documents([t.encode() for t in texts], 2)]
    assert found == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert any(i in x for x in found for i in library.get_added_tokens_decoder())


@pytest.mark.parametrize("path,cuts", [(WORD, WORD_PIECES), (BYTE, BYTE_PIECES)])
def test_store_is_emptied_and_crowded(path, cuts, docs):
    small = Encoder(path, cuts, max_pieces=600)
    texts = [t[:2000].encode() for t in docs.text.head(60)]
    want = [small.tokenizer.encode(t.decode(errors="ignore"), add_special_tokens=False).ids for t in texts]
    texts = [t.decode(errors="ignore").encode() for t in texts]
    assert [small.encode([t])[0].tolist() for t in texts] == want and small.size < 2000
    assert [x.tolist() for x in Encoder(path, cuts).encode(texts)] == want
    grown = Encoder(path, cuts, max_pieces=10)
    assert [x.tolist() for x in grown.encode(texts)] == want and grown.slots.bits > 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(lengths):
    lengths = np.sort(np.array(lengths, np.int64))[::-1]
    bins, offsets = packing.first_fit_decreasing(lengths, 64)
    room: list[int] = []
    for length, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        want = next((i for i, r in enumerate(room) if r >= length), len(room))
        if want == len(room):
            room.append(64)
        assert (b, o) == (want, 64 - room[want])
        room[want] -= length


def check_packed(found, ids, capacity):
    pieces, places = {}, {}
    for r in found.itertuples():
        own = ids[r.doc_id]
        assert brute.crc(own[r.start:r.start + r.length]) == r.ids_crc32 and r.doc_tokens == len(own)
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for groups, whole in ((pieces, {d: len(x) for d, x in ids.items()}), (places, None)):
        for key, own in groups.items():
            at = 0
            for begin, length in sorted(own):
                assert begin == at
                at += length
            assert at == whole[key] if whole else at <= capacity
    assert pieces.keys() == ids.keys()


def test_packing_query(spark, docs):
    found = registry.op9_tournament_packing(spark, SF).toPandas()
    check_packed(found, brute.token_rows(docs, WORD), 4096)
    assert found.length.sum() / 4096 / found.sequence_id.nunique() > 0.9


def test_packing_groups_and_edges(spark, docs, edge, empty):
    from pyspark.sql import functions as F
    few = spark.createDataFrame(docs[["doc_id", "text"]])
    found = packing.pack(few, tokenizer=WORD, capacity=100, group_bytes=20_000).withColumn("ids_crc32", F.crc32("ids")).toPandas()
    check_packed(found, brute.token_rows(docs, WORD), 100)
    assert (found.sequence_id.to_numpy() >> 32).max() > 3
    found = packing.pack(edge, tokenizer=WORD, capacity=4096).toPandas()
    assert found[found.start == 0].shape[0] == edge.count() and found.length.max() <= 4096
    assert packing.pack(empty, tokenizer=WORD).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1), st.sampled_from([255, 256, 65535, 65536, 2**24 - 1, 2**24]))))
def test_values_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = token_files.pack_values(v)
    assert len(control) == -(-len(v) // 4)
    assert token_files.unpack_values(control, data, len(v)).tolist() == values


def check_files(found, ids):
    found = found.set_index("doc_id")
    at = 0
    for d in sorted(ids):
        assert (found.start[d], found.n_tokens[d], found.ids_crc32[d]) == (at, len(ids[d]), brute.crc(ids[d]))
        at += len(ids[d])
    assert len(found) == len(ids)


def test_token_files_query(spark, docs):
    check_files(registry.op10_ranked_bytes(spark, SF).toPandas(), brute.token_rows(docs, BYTE))


def test_token_files_parts_and_edges(spark, docs, edge, empty):
    from pyspark.sql import functions as F
    scratch = Scratch(spark)
    path = scratch.folder("t")
    token_files.write_token_files(spark.createDataFrame(docs[["doc_id", "text"]]), path, tokenizer=BYTE, part_bytes=50_000, block_tokens=500)
    found = token_files.read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids"))
    check_files(found.toPandas(), brute.token_rows(docs, BYTE))
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.select("part").distinct().count() > 3
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").toPandas()
    assert vocabulary["count"].is_monotonic_decreasing
    path = scratch.folder("t")
    token_files.write_token_files(edge, path, tokenizer=BYTE)
    rows = token_files.read_token_files(spark, path).orderBy("start").toPandas()
    assert len(rows) == edge.count() and (rows.start.diff().iloc[1:].to_numpy() == rows.n_tokens.iloc[:-1].to_numpy()).all()
    assert rows.doc_id.dropna().is_monotonic_increasing and rows.doc_id.iloc[:2].isna().all()
    path = scratch.folder("t")
    token_files.write_token_files(empty, path, tokenizer=BYTE)
    assert token_files.read_token_files(spark, path).count() == 0
    scratch.release()
