"""Documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what the next one reads;
all but the last keep the columns of ``documents``. Between stages the rows are
written to the shared folder, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellsmith.llm import line_dedup, mixing, near_dup, packing, quality
from cellsmith.llm.common import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, or their host's verdict, reject go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs, chars_col="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("near_dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack)]

#: Min hashes and token ids have no SQL; tests/llm/test_pipeline.py holds every stage
#: against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
