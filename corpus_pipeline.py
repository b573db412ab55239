"""The corpus pipeline: toxicity, exact and near duplicates, benchmark leaks, packing.

Every stage gets all rows its predecessor kept, as a written table, and returns the rows
it keeps with all their columns; the last one returns packed pieces.  What a stage wrote
for itself is deleted once its result is written.

SQL cannot express the network, fingerprints or tokenizer, so ``ORACLE_SQL`` is None;
``tests/llm/test_llm_toxicity.py`` compares the stages with brute force.
"""

from __future__ import annotations

from contextvars import ContextVar

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.llm import decontaminate, exact_names, packing, simhash_near, toxicity
from salesforge.llm.common import Scratch

#: What ``run`` deletes after the stage it is calling; a stage called alone has its own,
#: which goes when the session ends.
_STAGE: ContextVar[Scratch | None] = ContextVar("stage", default=None)


def _scratch(spark: SparkSession) -> Scratch:
    return _STAGE.get() or Scratch(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_names.drop_exact(docs, _scratch(spark))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_near.drop_near(docs, _scratch(spark), shingle=4, radius=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _scratch(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = packing.pack(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact), ("near dedup", drop_near),
          ("decontamination", drop_leaks), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; every stage's result is written to
    the shared folder and read by the next one."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        before, own = list(written.paths), Scratch(spark)
        token = _STAGE.set(own)
        try:
            docs = written.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        finally:
            _STAGE.reset(token)
            own.release()
        written.release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
