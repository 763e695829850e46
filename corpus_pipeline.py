"""A corpus from documents to packed sequences: five stages, each an operator of etholake.llm on all that the stage
before it kept. Each stage's rows are written as Parquet and read again as the next one's input.

A stage only builds on what it is given and deletes nothing that its result still reads; stages may be composed without a
write between them. run() removes what served a stage, and that stage's input, once the stage's own rows are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from etholake.llm import mixing, packing, simhash, suffixes, toxicity
from etholake.llm._common import load, remove, scratch, temporary, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not find toxic."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, load(spark, sf_dir, "labels"), modulus=None))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more)."""
    return simhash.one_of_each(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that documents with smaller ids have."""
    return suffixes.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for each pass that takes them."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = load(spark, sf_dir, "documents"), ""
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        with temporary():
            docs = written(stage(spark, docs, sf_dir), path=path)
        remove(before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


#: Packing and the learned stages are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None
