"""What several operators of this subpackage share: columns, words, checkpoints and packed arrays."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but ASCII white space. Valid in Java, Python and RE2 patterns.
WORD = "[^\\x20\\x09-\\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % m, F.lit(-1)).cast("int")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary folder will do if
    the executors are threads of this process; on a cluster it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
    return f"{tempfile.gettempdir()}/etholake-{os.getuid()}-checkpoints"


#: Folders written by this process and not yet removed.
_WRITTEN: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the process ends, if not before."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


def remove(*paths: str) -> None:
    """Delete what was written to these paths, through Spark's own file systems."""
    for path in paths:
        spark = _WRITTEN.pop(path, None)
        if spark is not None:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


#: Lists that take down what is written, the innermost last.
_OWNERS: list[list[str]] = []


@contextmanager
def temporary() -> Iterator[list[str]]:
    """What is written inside goes at the end: for what only serves a result that has itself been written by then (to a path
    of scratch() from before). Nothing that others wrote is touched."""
    mine: list[str] = []
    _OWNERS.append(mine)
    try:
        yield mine
    finally:
        _OWNERS.remove(mine)
        remove(*mine)


@atexit.register
def _remove_all() -> None:
    for path in list(_WRITTEN):
        try:
            remove(path)
        except Exception:  # the JVM may be gone before us
            return


def written(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Cut the lineage: write the rows as Parquet to the shared folder and read them again.

    A lost executor then costs a read of these files, not the stages before them."""
    return written_at(df, name, path)[0]


def written_at(df: DataFrame, name: str = "stage", path: str | None = None) -> tuple[DataFrame, str]:
    """As written, with the path (a new one, if none is given), for remove() after the last read."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a, dtype=kind).tobytes()


def unpack(b: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(b or b"", dtype=kind)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method on standardised columns; mean, scale, weights (the last is the bias)."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), l2 * len(x))
    ridge[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return mean, scale, w


def apply_logistic(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -35, 35)))


def chunks(texts: list[str | None], max_chars: int = 1_500_000):
    """(first index, texts) in order, of about max_chars each, so that Python objects stay few; a longer text is alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > max_chars:
            yield start, texts[start:i]
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, texts[start:]
