"""Descriptions of syllables: a small table (syllable, label, desc, crowd_movie_path), kept as a JSON or YAML document."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "syllable int, label string, desc string, crowd_movie_path string"
#: What a document holds for each syllable. group_info is derived, and is not written.
FIELDS = ("label", "desc", "crowd_movie_path")


def initial(spark: SparkSession, n: int) -> DataFrame:
    """Empty descriptions of the first n syllables."""
    return spark.range(n).select(F.col("id").cast("int").alias("syllable"), *[F.lit("").alias(f) for f in FIELDS])


def described(info: DataFrame, labels: DataFrame) -> DataFrame:
    """info with the labels (syllable, label) given; others keep theirs."""
    new = labels.select(F.col("syllable").alias("_syllable"), F.col("label").alias("_label"))
    d = info.join(new, F.col("syllable") == F.col("_syllable"), "left")
    return d.withColumn("label", F.coalesce("_label", "label")).select(*info.columns)


def parsed(spark: SparkSession, text: str) -> DataFrame:
    """The table of a document; YAML is a superset of JSON. Missing fields are empty, and derived ones are left out."""
    import yaml

    rows = [(int(k), *[str((v or {}).get(f) or "") for f in FIELDS]) for k, v in (yaml.safe_load(text) or {}).items()]
    return spark.createDataFrame(sorted(rows), SCHEMA)


def document(info: DataFrame) -> str:
    """The document of a table, one entry per syllable."""
    rows = info.select("syllable", *FIELDS).orderBy("syllable").collect()
    return json.dumps({str(r["syllable"]): {f: r[f] or "" for f in FIELDS} for r in rows}, indent=1, ensure_ascii=False)


def save_statistics(stats: DataFrame, folder: str, n_syllables: int) -> str:
    """Write statistics under a folder of their own for this number of syllables, so that a change of it makes older ones
    unseen; the path."""
    path = f"{folder.rstrip('/')}/n_syllables={n_syllables}"
    stats.write.mode("overwrite").option("compression", "gzip").parquet(path)
    return path


def saved_statistics(spark: SparkSession, folder: str, n_syllables: int) -> DataFrame | None:
    """Statistics written for this number of syllables, if there are any."""
    path = f"{folder.rstrip('/')}/n_syllables={n_syllables}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)
    return spark.read.parquet(path) if there else None
