"""The queries that apply the operators to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.llm import chat, decontaminate, exact_names, importance, packing, repair, shards, simhash_near, substring, token_files, toxicity, url_rules, warc
from salesforge.llm.common import Scratch, text_of
from salesforge.llm.sql import ORACLE
from salesforge.llm.tokens import BYTE_PIECES, WORD_PIECES

END_ID = 2
#: The chat conversation that every run formats besides the table's own.
EXTRA_TURN = "<|im_end|><|im_start|>assistant ok"
RULES = [url_rules.Rule("block", "net", "/"), url_rules.Rule("allow", "example.net", "/en/"),
         url_rules.Rule("block", "example.com", "/de/"), url_rules.Rule("allow", "org", "/fr/")]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_gated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    out = toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards of near equal bytes."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = shards.shard(docs, Scratch(spark), shards=40)
    return out.select("doc_id", "size", F.crc32(text_of()).alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the best window."""
    found = decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.drop("rid")


def op4_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal without white space."""
    out = exact_names.identities(_read(spark, sf_dir, "documents"), carry={"text_sha256": F.sha2("norm", 256)})
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: four-word shingles, at most four bits."""
    out = simhash_near.near_groups(_read(spark, sf_dir, "documents"), shingle=4, radius=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read back from their prefix-target examples."""
    extra = spark.createDataFrame([(-1, 0, "user", EXTRA_TURN), (-1, 1, "assistant", EXTRA_TURN)],
                                  "conv_id long, turn long, role string, text string")
    table = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.examples(table.unionByName(extra))
    loss = chat.loss_of(F.col("text"), F.col("loss_start"), F.col("loss_length"))
    whole = (made.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"), F.sum(F.char_length("text")).alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", loss.alias("loss"))))).alias("loss")))
    said = F.array_join(F.transform("loss", lambda x: x["loss"]), "")
    turns = chat.turns_of(F.col("longest"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select("conv_id", "formatted_chars", said.alias("said"), turns.alias("turns")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"), "formatted_chars")


def op7_rare_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules."""
    return url_rules.judge(_read(spark, sf_dir, "pages"), RULES, default="allow")


def op8_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the windows of 20 words that stand earlier."""
    # The rows of a table read have the same number in every read.
    out = substring.drop_repeats(_read(spark, sf_dir, "documents"), rid=F.monotonically_increasing_id(), k=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 4096 tokens."""
    out = packing.pack(_read(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("word_bpe_49k.json"),
                       cuts=WORD_PIECES, capacity=4096, end_id=END_ID)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_ranked_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written in order of doc_id and read back."""
    scratch = Scratch(spark)
    path = scratch.folder("tokens")
    token_files.write_token_files(_read(spark, sf_dir, "documents"), path, tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
                                  cuts=BYTE_PIECES, end_id=END_ID)
    out = token_files.read_token_files(spark, path)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_overlapped_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by their likeness to the benchmark."""
    found = importance.importance(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), Scratch(spark),
                                  ngrams=(1, 1), buckets=10_000, percent=10, min_words=20, seed=2024)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    path = Scratch(spark).folder("warc")
    warc.write_warc(_read(spark, sf_dir, "pages"), path, revisit_bytes=100)
    return warc.read_warc(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_audit_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and the cheapest edits that repair them."""
    rows = repair.damaged(_read(spark, sf_dir, "conversations"))
    return repair.audits(rows, present=F.col("present"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
