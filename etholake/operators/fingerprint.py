"""Histograms: where in space, and at which values, sessions spend their frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import percentiles

RANGES = ("robust", "full")


def position_heatmap(frames: DataFrame, by: Sequence[str], x: str, y: str, bins: int = 50) -> DataFrame:
    """by, xbin, ybin, pdf: share of a key's frames in each cell of a grid over the range of all frames (empty cells are
    left out)."""
    r = frames.agg(*[f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("min", F.min), ("max", F.max))])

    def cell(c: str):
        at = F.floor(F.try_divide(F.col(c) - F.col(f"min_{c}"), F.col(f"max_{c}") - F.col(f"min_{c}")) * bins)
        return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")

    # one row of ranges
    ranges = r.first().asDict()
    d = frames.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({k: F.lit(v) for k, v in ranges.items()})
    cells = d.groupBy(*by, cell(x).alias("xbin"), cell(y).alias("ybin")).agg(F.count("*").alias("_n"))
    return cells.withColumn("pdf", F.col("_n") / F.sum("_n").over(Window.partitionBy(*by))).drop("_n")


def mean_heatmap(maps: DataFrame, level: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Mean over the keys of a level of their pdf in each cell; a key without a cell counts 0 there."""
    n = maps.select(*level, *keys).distinct().groupBy(*level).agg(F.count("*").alias("_keys"))
    sums = maps.groupBy(*level, "xbin", "ybin").agg(F.sum("pdf").alias("_sum"))
    return sums.join(n, list(level)).select(*level, "xbin", "ybin", (F.col("_sum") / F.col("_keys")).alias("pdf"))


def histograms(frames: DataFrame, scalars: Sequence[str], bins: int = 100, ranges: str = "robust", by: str = "uuid") -> DataFrame:
    """by, scalar, bin, share: share of a session's frames in each bin between percentiles 1 and 99 ('robust') or the
    least and greatest value ('full') of all frames; values outside are left out of the bins, not of the frames."""
    if ranges not in RANGES:
        raise ValueError(f"ranges must be one of {RANGES}, not {ranges!r}")
    each = frames.select(by, F.explode(F.array(*[F.struct(F.lit(c).alias("scalar"), F.col(c).cast("double").alias("v")) for c in scalars])).alias("x")).select(by, "x.*")
    if ranges == "robust":
        limits = percentiles(each, ["scalar"], "v", (0.01, 0.99)).groupBy("scalar").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    else:
        limits = each.groupBy("scalar").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # one row for each scalar
    long = each.join(F.broadcast(limits), "scalar", "left")
    at = F.least(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    inside = F.col("v").between(F.col("lo"), F.col("hi"))
    n = long.groupBy(by, "scalar", F.when(inside, at).alias("bin")).agg(F.count("*").alias("_n"))
    return n.withColumn("share", F.col("_n") / F.sum("_n").over(Window.partitionBy(by, "scalar"))).where("bin IS NOT NULL").drop("_n")


def scaled(table: DataFrame, by: Sequence[str], value: str, how: str = "minmax") -> DataFrame:
    """value scaled within each key to 0..1 ('minmax') or to mean 0 and deviation 1 ('standard')."""
    w = Window.partitionBy(*by)
    if how == "minmax":
        new = F.try_divide(F.col(value) - F.min(value).over(w), F.max(value).over(w) - F.min(value).over(w))
    elif how == "standard":
        new = F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_pop(value).over(w))
    else:
        raise ValueError(f"how must be 'minmax' or 'standard', not {how!r}")
    return table.withColumn(value, F.coalesce(new, F.lit(0.0)))


def fingerprint(frames: DataFrame, stats: DataFrame, scalars: Sequence[str], bins: int = 100, ranges: str = "robust") -> DataFrame:
    """uuid, scalar, bin, share: histograms of the scalars, and the sessions' syllable usages as one more block."""
    usage = stats.select("uuid", F.lit("usage").alias("scalar"), F.col("syllable").cast("int").alias("bin"), F.col("usage").alias("share"))
    return histograms(frames, scalars, bins, ranges).unionByName(usage)
