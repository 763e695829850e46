"""Tables between jobs, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Unset, a temporary folder serves where executors are threads of this process; elsewhere it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
    return tempfile.mkdtemp(prefix="etholake-")


def cut(rows: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read again: what iterates over them does not compute them anew, and a lost executor
    costs a read."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
