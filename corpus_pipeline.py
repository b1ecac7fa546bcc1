"""From documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagegrid.llm import language
from pagegrid.llm.decontaminate import drop_contaminated
from pagegrid.llm.exact_dedup import drop_copies
from pagegrid.llm.near_copies import drop_near_copies
from pagegrid.llm.packing import pack
from pagegrid.runtime import attach_workers, release_scratch, scratch_mark, scratch_table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a letter, or of no clear language, go."""
    attach_workers(spark)
    return language.keep_known(docs, language.fit(docs))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the smallest id stays."""
    attach_workers(spark)
    return drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup: SimHash fingerprints, and bands for what these leave apart; of texts linked at 0.8 or more of their five-word shingles the smallest id stays."""
    attach_workers(spark)
    return drop_near_copies(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that contain a benchmark item go."""
    attach_workers(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of all documents, in sequences of 4096 tokens."""
    import public_tokenizers

    attach_workers(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("exact_dedup", remove_copies),
    ("simhash_near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

#: A trained network, XXH64 fingerprints and token ids are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = scratch_mark()
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
        release_scratch(mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
