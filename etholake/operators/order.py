"""Order statistics without sorting a group in one task.

A number is cut into digits that keep its order: its sign and binary exponent, then two digits of its mantissa, then itself. The
windows below run over one digit's values under one prefix, so each holds a bounded number of rows (some 6,000 exponents,
131,072 values of a digit, at most 262,144 numbers that share all digits), however many rows a group has. The digits are plain
arithmetic: computed again after a lost executor they are the same, unlike the bounds of a sampled range partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = ("_o1", "_o2", "_o3")


def digits(value: Column) -> dict[str, Column]:
    """Three digits; of two numbers the larger never has the smaller digit under equal earlier ones."""
    v = value.cast("double")
    size = F.abs(v)
    exponent = F.least(F.greatest(F.floor(F.when(size > 0, F.log2(size)).otherwise(0.0)), F.lit(-1022)), F.lit(1023)).cast("int")
    scaled = v / F.pow(F.lit(2.0), exponent)
    return {
        "_o1": F.when(v > 0, exponent + 2000).when(v < 0, -(exponent + 2000)).otherwise(0),
        "_o2": F.floor(scaled * (1 << 17)), "_o3": F.floor(scaled * (1 << 34)),
    }


def _before(d: DataFrame, prefix: Sequence[str], digit: str, n: str) -> Column:
    w = Window.partitionBy(*prefix).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0).cast("long"))


def below(counts: DataFrame, by: Sequence[str], value: str, n: str) -> DataFrame:
    """counts (one row for each of by and value, n how many share it) with `below`: how many under the same keys are smaller.

    A sum of each digit's earlier siblings, from the exponent down; values must not be null."""
    keys = list(by)
    d = counts.withColumns(digits(F.col(value)))
    upper: DataFrame | None = None
    for i, digit in enumerate(_DIGITS):
        path = [*keys, *_DIGITS[: i + 1]]
        level = d.groupBy(*path).agg(F.sum(n).alias("_n"))
        level = level.withColumn("_at", _before(level, [*keys, *_DIGITS[:i]], digit, "_n")).drop("_n")
        if upper is not None:
            level = level.join(upper.withColumnRenamed("_at", "_up"), [*keys, *_DIGITS[:i]]).withColumn("_at", F.col("_at") + F.col("_up")).drop("_up")
        upper = level
    d = d.withColumn("_in", _before(d, [*keys, *_DIGITS], value, n))
    return d.join(upper, [*keys, *_DIGITS]).withColumn("below", F.col("_at") + F.col("_in")).select(*counts.columns, "below")


def percentiles(rows: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], many_keys: bool = False) -> DataFrame:
    """by, share, value: exact percentiles, interpolated between neighbours, for every key; nulls are left out.

    The first pass counts cells (exponent and first digit); the second counts the numbers of the few cells that hold
    the wanted places. Rows are never sorted, and what is joined back is two cells for each key and share: broadcast, unless
    there may be many keys."""
    keys = list(by)
    kept = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*keys, F.col(value).cast("double").alias("_v"))
    found = digits(F.col("_v"))
    cell = kept.withColumns({k: found[k] for k in ("_o1", "_o2")})
    cells = cell.groupBy(*keys, "_o1", "_o2").agg(F.count("*").alias("_n"))
    first = cells.groupBy(*keys, "_o1").agg(F.sum("_n").alias("_t"))
    first = first.withColumn("_up", _before(first, keys, "_o1", "_t"))
    total = first.groupBy(*keys).agg(F.sum("_t").alias("_all"))
    at = cells.withColumn("_in", _before(cells, [*keys, "_o1"], "_o2", "_n")).join(first.drop("_t"), [*keys, "_o1"])
    at = at.withColumn("_from", F.col("_up") + F.col("_in")).select(*keys, "_o1", "_o2", "_n", "_from")
    every = F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.lit(end).alias("end")) for s in shares for end in (0, 1)])).alias("_s")
    place = F.col("share") * (F.col("_all") - 1)
    wanted = total.select(*keys, "_all", every).select(*keys, "_all", "_s.*").withColumn("_place", F.least(F.floor(place) + F.col("end"), F.col("_all") - 1).cast("long"))
    on = [at[k].eqNullSafe(wanted[k]) for k in keys]
    holds = (F.col("_from") <= F.col("_place")) & (F.col("_place") < F.col("_from") + F.col("_n"))
    cond = holds
    for c in on:
        cond = c & cond
    hits = wanted.join(at, cond).select(*[wanted[k] for k in keys], "share", "end", "_all", "_place", "_o1", "_o2", "_from")
    # the cells that are wanted, once each, go back to the rows
    few = hits.select(*keys, "_o1", "_o2", "_from").distinct()
    inside = cell.join(few if many_keys else F.broadcast(few), [*keys, "_o1", "_o2"]).groupBy(*keys, "_o1", "_o2", "_from", "_v").agg(F.count("*").alias("_n"))
    inside = inside.withColumn("_o3", found["_o3"])
    third = inside.groupBy(*keys, "_o1", "_o2", "_o3").agg(F.sum("_n").alias("_t"))
    third = third.withColumn("_mid", _before(third, [*keys, "_o1", "_o2"], "_o3", "_t")).drop("_t")
    inside = inside.withColumn("_in", _before(inside, [*keys, "_o1", "_o2", "_o3"], "_v", "_n")).join(third, [*keys, "_o1", "_o2", "_o3"])
    inside = inside.select(*keys, "_o1", "_o2", "_v", "_n", (F.col("_from") + F.col("_mid") + F.col("_in")).alias("_first"))
    got = hits.drop("_from").join(inside, [*keys, "_o1", "_o2"]).where((F.col("_first") <= F.col("_place")) & (F.col("_place") < F.col("_first") + F.col("_n")))
    part = F.first(F.col("share") * (F.col("_all") - 1)) - F.floor(F.first(F.col("share") * (F.col("_all") - 1)))
    low, high = (F.max(F.when(F.col("end") == e, F.col("_v"))) for e in (0, 1))
    return got.groupBy(*keys, "share").agg((low + (high - low) * part).alias("value"))
