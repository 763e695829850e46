"""The queries of this subpackage, one for each numbered operator, and the SQL that DuckDB checks them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, merkle, wand
from ._common import crc_mod, load


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licences

    docs = load(spark, sf_dir, "documents")
    return licences.scan(docs, licences.fit(docs))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixinglm

    return mixinglm.score(load(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.judged(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    return packing.pack_documents(load(spark, sf_dir, "documents"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffixes

    return suffixes.digests(load(spark, sf_dir, "documents"))


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edits(load(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(load(spark, sf_dir, "conversations"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.taken(load(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash

    found = simhash.classes(simhash.with_fingerprints(load(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe

    return bpe.digests(load(spark, sf_dir, "documents"))


def op12_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wand.rank(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import alignment

    return alignment.digests(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_suffixes": op2_suffixes,
    "op3_merkle": op3_merkle,
    "op4_chat": op4_chat,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_licences": op7_licences,
    "op8_lm": op8_lm,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_bpe": op11_bpe,
    "op12_wand": op12_wand,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {"op3_merkle": merkle.ORACLE_SQL, "op4_chat": chat.ORACLE_SQL, "op12_wand": wand.ORACLE_SQL}
