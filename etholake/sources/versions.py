"""Data sets whose every write is a new version, published whole or not at all.

A version is a folder of Parquet files under the data set's own; it exists once a manifest with its number has been renamed
into place, which a file system does at once. Readers take the newest manifest, so a write that fails, or is still going,
changes nothing for them, and of two writers of one version the second fails."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_versions"


class VersionConflict(RuntimeError):
    """Another writer has published the version first."""


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), spark._jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    fs, at = _file_system(spark, path)
    folder = at(f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{path}/{MANIFESTS}/{version}.json", wholetext=True).first()[0])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one asked for."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no such version in {path}: {version if known else 'none is published'}")
    return spark.read.parquet(f"{path}/{_manifest(spark, path, known[-1] if version is None else version)['folder']}")


def write(rows: DataFrame, path: str, partition_by: Sequence[str] = (), base: int | None = None) -> int:
    """Publish the rows as the next version and return its number. base: the version that they are made from, if a newer one
    must not have come since."""
    spark = rows.sparkSession
    known = versions(spark, path)
    newest = known[-1] if known else 0
    if base is not None and base != newest:
        raise VersionConflict(f"{path} is at version {newest}, not {base}")
    folder = f"data-{newest + 1}-{uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    fs, at = _file_system(spark, path)
    fs.mkdirs(at(f"{path}/{MANIFESTS}"))
    draft, final = at(f"{path}/{MANIFESTS}/.{folder}"), at(f"{path}/{MANIFESTS}/{newest + 1}.json")
    out = fs.create(draft, False)
    out.write(json.dumps({"version": newest + 1, "folder": folder, "before": newest}).encode())
    out.close()
    # some file systems replace the target of a rename, others refuse; neither may hide another writer's version
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise VersionConflict(f"{path} has a version {newest + 1} already")
    return newest + 1


def merge(updates: DataFrame, path: str, on: Sequence[str], insert: bool = True) -> int:
    """Publish a version in which the updates' columns replace those of the rows with equal keys; rows with new keys are added,
    unless insert is False. Columns that the updates lack stay; keys of the updates must be distinct, none null."""
    spark = updates.sparkSession
    known = versions(spark, path)
    if not known:
        return write(updates, path)
    old = read(spark, path, known[-1])
    changed = [c for c in updates.columns if c not in on]
    new = updates.select(*on, *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_hit"))
    both = old.join(new, list(on), "full" if insert else "left")
    value = lambda c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in old.columns else F.col(f"_new_{c}")
    columns = [*old.columns, *[c for c in changed if c not in old.columns]]
    return write(both.select(*[F.col(c) if c in on or c not in changed else value(c).alias(c) for c in columns]), path, base=known[-1])


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the newest `keep` versions, and what failed writes have left; the folders that went. No writer may be
    at work."""
    known = versions(spark, path)
    fs, at = _file_system(spark, path)
    for v in known[: max(0, len(known) - max(1, keep))]:
        fs.delete(at(f"{path}/{MANIFESTS}/{v}.json"), False)
    kept = {_manifest(spark, path, v)["folder"] for v in known[-max(1, keep) :]}
    gone = [s.getPath().getName() for s in fs.listStatus(at(path)) if s.getPath().getName().startswith("data-")] if known else []
    gone = sorted(set(gone) - kept)
    for name in gone:
        fs.delete(at(f"{path}/{name}"), True)
    return gone
