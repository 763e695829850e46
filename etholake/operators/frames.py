"""Frames, labels and bouts.

A frame table has one row per frame: uuid, grp, frame (its order within the session) and syllable (its label), and any
number of scalar columns. All windows here are partitioned by uuid, so one shuffle serves them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def session() -> WindowSpec:
    """A session's frames in order."""
    return Window.partitionBy("uuid").orderBy("frame")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """frame: each row's place in its session in the order given, from 0."""
    return rows.withColumn("frame", F.row_number().over(Window.partitionBy("uuid").orderBy(*order)).cast("long") - 1)


def nan_as_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Missing scalars as NULL, which aggregates skip."""
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def labelled(rows: DataFrame) -> DataFrame:
    """Frames that carry a label: the first few of a session have a negative one."""
    return rows.where(F.col("syllable") >= 0)


def usage_order(rows: DataFrame, label: str = "syllable", count: str = "frames") -> DataFrame:
    """(label, n, sorted_id): labels by descending usage, ties by label. count 'frames' counts rows, 'usage' bouts.

    One row per label, so the ranking window is small."""
    if count not in ("frames", "usage"):
        raise ValueError(f"count must be 'frames' or 'usage', not {count!r}")
    base = rows if count == "frames" else bouts(rows, label)
    sizes = base.groupBy(label).agg(F.count("*").alias("n"))
    return sizes.withColumn("sorted_id", (F.row_number().over(Window.orderBy(F.desc("n"), label)) - 1).cast("int"))


def relabelled(rows: DataFrame, label: str = "syllable", count: str = "frames", into: str = "syllable") -> DataFrame:
    """Labels replaced by their place in usage_order; the map has one row per label."""
    order = usage_order(rows, label, count).select(F.col(label).alias("_label"), F.col("sorted_id").alias("_id"))
    return rows.join(F.broadcast(order), rows[label] == F.col("_label")).withColumn(into, F.col("_id")).drop("_label", "_id")


def with_runs(rows: DataFrame, label: str = "syllable") -> DataFrame:
    """run: the number of the run of equal labels that a frame is in, from 0, within its session."""
    changed = F.coalesce((F.col(label) != F.lag(label).over(session())).cast("int"), F.lit(0))
    return rows.withColumn("_new", changed).withColumn("run", F.sum("_new").over(session().rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def bouts(rows: DataFrame, label: str = "syllable", keep: tuple[str, ...] = ("grp",), means: tuple[str, ...] = (), more: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per run of equal labels: uuid, keep, run, label, start, frames, means of scalars, and more aggregates."""
    kept = [c for c in keep if c in rows.columns]
    aggs = [F.min("frame").alias("start"), F.count("*").alias("frames"), *[F.avg(c).alias(c) for c in means], *[a.alias(n) for n, a in (more or {}).items()]]
    return with_runs(rows, label).groupBy("uuid", *kept, "run", label).agg(*aggs)


def explained_cutoff(rows: DataFrame, percent: float = 99.0, label: str = "syllable") -> DataFrame:
    """max_syllables: the least number of labels, by usage, that cover so many percent of the frames."""
    o = usage_order(rows, label)
    order = Window.orderBy("sorted_id").rowsBetween(Window.unboundedPreceding, 0)
    share = o.withColumn("covered", F.sum("n").over(order) / F.sum("n").over(Window.partitionBy()))
    return share.where(F.col("covered") * 100 >= percent).agg((F.min("sorted_id") + 1).cast("long").alias("max_syllables"))


def bout_examples(b: DataFrame, most: int = 20, least_frames: int = 3, most_frames: int = 60, by_median: bool = False, pad: int = 10) -> DataFrame:
    """Up to `most` example bouts of each label with a duration in range: nearest the label's median duration, or in the
    order of a portable hash; with the padded frame range of each."""
    ok = b.where(F.col("frames").between(least_frames, most_frames))
    if by_median:
        medians = ok.groupBy("syllable").agg(F.percentile("frames", 0.5).alias("_median"))
        ok = ok.join(F.broadcast(medians), "syllable").withColumn("_rank", F.abs(F.col("frames") - F.col("_median")))
    else:
        ok = ok.withColumn("_rank", portable_hash(F.col("uuid") * 1000 + F.col("run"), 1_000_003))
    w = Window.partitionBy("syllable").orderBy("_rank", "uuid", "run")
    out = ok.withColumn("example", F.row_number().over(w)).where(F.col("example") <= most)
    return out.withColumns({"from_frame": F.greatest(F.col("start") - pad, F.lit(0)), "to_frame": F.col("start") + F.col("frames") + pad})


def portable_hash(x: Column, modulus: int) -> Column:
    """An arithmetic hash that other SQL engines compute alike."""
    return F.pmod(F.pmod(x, F.lit(2_147_483_647)) * 48_271, F.lit(modulus))


def portable_mix(rows: DataFrame, x: Column, into: str) -> DataFrame:
    """rows with a better mixed hash of a whole number into 0..2^31-2 that other SQL engines compute alike: two rounds of
    squaring modulo a prime, each a column of its own, as each reads the one before it three times."""
    m = F.lit(2_147_483_647)
    y = F.col(into)
    once = F.pmod(y * y + F.lit(12_345) * y + 1_013_904_223, m)
    return rows.withColumn(into, F.pmod(x, m)).withColumn(into, F.pmod(once + 374_761_393, m)).withColumn(into, once)
