"""Behavioural statistics: usage, duration and scalars of each syllable by session and by group, orderings, error bars."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import portable_mix, session

COUNTS = ("usage", "frames")
ERRORBARS = ("None", "SEM", "STD", "CI 95%")
LEVELS = ("grp", "SessionName", "SubjectName")


def behavioural_stats(frames: DataFrame, by: Sequence[str], scalars: Sequence[str] = (), count: str = "usage", fps: float = 30.0, normalise: bool = True, aggregates: Sequence[str] = ("mean", "std", "min", "max")) -> DataFrame:
    """One row per key and syllable that occurs under it: bouts, frames, usage, duration (seconds), scalar aggregates.

    usage is the key's share of bouts (count 'usage') or frames ('frames'), or their number without normalise."""
    if count not in COUNTS:
        raise ValueError(f"count must be one of {COUNTS}, not {count!r}")
    keys = list(by)
    # a bout is where its first frame is, so frames add up to syllables in one pass; deviations are Spark's (n, mean, M2) states,
    # merged pairwise from task to task, which large values do not upset
    changed = F.lit(False)
    for c in dict.fromkeys(["syllable", *[k for k in keys if k != "uuid"]]):
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(session()))
    flagged = frames.withColumn("_first", changed | (F.row_number().over(session()) == 1))
    value = lambda c: F.col(c).cast("double")
    pick = {"mean": lambda c: F.avg(value(c)), "std": lambda c: F.stddev_samp(value(c)), "min": F.min, "max": F.max}
    values = [pick[a](c).alias(f"{c}_{a}") for c in scalars for a in aggregates]
    b, n = F.count_if("_first"), F.count("*")
    sizes = flagged.groupBy(*keys, "syllable").agg(b.alias("bouts"), n.alias("frames"), (F.try_divide(n.cast("double"), b) / fps).alias("duration"), *values)
    n_of = F.col("bouts") if count == "usage" else F.col("frames")
    usage = n_of / F.sum(n_of).over(Window.partitionBy(*keys)) if normalise else n_of.cast("double")
    names = [f"{c}_{a}" for c in scalars for a in aggregates]
    return sizes.withColumn("usage", usage).select(*keys, "syllable", "bouts", "frames", "duration", "usage", *names)


def zero_filled(stats: DataFrame, by: Sequence[str], syllables: DataFrame) -> DataFrame:
    """A row for every key and every syllable of the (small) table: absent ones have numbers of 0.

    A key's rows, one for each syllable, are gathered and filled in their place."""
    rest = [f for f in stats.schema.fields if f.name not in (*by, "syllable")]
    every = F.lit(syllables.select(F.collect_set("syllable")).first()[0])
    g = stats.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("syllable", F.struct(*[f.name for f in rest])))).alias("_m"))
    d = g.withColumn("syllable", F.explode(every)).withColumn("_s", F.try_element_at("_m", F.col("syllable")))
    number = lambda f: f.dataType.typeName() in ("double", "long", "integer", "float")
    zero = lambda f: F.coalesce(F.col("_s")[f.name], F.lit(0).cast(f.dataType)) if number(f) else F.col("_s")[f.name]
    return d.select(*by, F.col("syllable").cast(stats.schema["syllable"].dataType).alias("syllable"), *[zero(f).alias(f.name) for f in rest])


def mean_of_sessions(stats: DataFrame, level: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of the sessions' values by level and syllable: every session counts alike, whatever its length."""
    return stats.groupBy(*level, "syllable").agg(*[F.avg(c).alias(c) for c in columns], F.count("*").alias("sessions"))


def roll_up(stats: DataFrame, levels: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The means of all levels in one pass: level (which one), key, syllable, columns."""
    sets = ", ".join(f"({c}, syllable)" for c in levels)
    cols = ", ".join(f"avg({c}) AS {c}" for c in columns)
    level = "CASE " + " ".join(f"WHEN grouping({c}) = 0 THEN '{c}'" for c in levels) + " END AS level"
    key = f"coalesce({', '.join(f'cast({c} AS string)' for c in levels)}) AS key"
    return stats.sparkSession.sql(f"SELECT {level}, {key}, syllable, {cols} FROM {{s}} GROUP BY GROUPING SETS ({sets})", s=stats)


def error_bars(stats: DataFrame, level: str, stat: str, kind: str = "SEM") -> DataFrame:
    """level, syllable, mean, error, low, high. 'None' has no error, and bounds at the mean."""
    if kind not in ERRORBARS:
        raise ValueError(f"kind must be one of {ERRORBARS}, not {kind!r}")
    if kind == "CI 95%":
        return bootstrap(stats, [level, "syllable"], stat)
    err: Column = {"SEM": F.stddev_samp(stat) / F.sqrt(F.count(stat)), "STD": F.stddev_samp(stat), "None": F.lit(None).cast("double")}[kind]
    out = stats.groupBy(level, "syllable").agg(F.avg(stat).alias("mean"), err.alias("error"))
    e = F.coalesce("error", F.lit(0.0))
    return out.withColumns({"low": F.col("mean") - e, "high": F.col("mean") + e})


#: The distribution function of a Poisson variable with mean 1, in six digits.
POISSON = (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406, 0.999917, 0.999990)


#: Units, resamples and groups that a task weighs at a time, and groups whose sums it keeps at most.
UNITS_A_STEP, BOOTS_A_STEP, GROUPS_A_STEP, GROUPS_KEPT = 1024, 128, 64, 256
_PRIME = 2_147_483_647


def _mersenne(v: np.ndarray) -> np.ndarray:
    """v modulo 2**31 - 1, in place; v under 2**63."""
    for _ in range(2):
        high = v >> 31
        v &= _PRIME
        v += high
    v -= _PRIME * (v >= _PRIME)
    return v


def poisson_weights(units: np.ndarray, boots: np.ndarray) -> np.ndarray:
    """The weight of each (mixed) unit in each resample: portable_mix of unit + resample * 104729, cut at POISSON."""
    y = _mersenne(units.astype(np.int64)[:, None] + boots.astype(np.int64) * 104_729)
    for more in (374_761_393, 0):
        v = y + 12_345
        v *= y
        v += 1_013_904_223
        y = _mersenne(v)
        if more:
            y += more
            y = _mersenne(y)
    y = y.astype(np.int32)
    out = np.zeros(y.shape, dtype=np.int8)
    for c in POISSON:
        out += y > int(c * _PRIME)
    return out.astype(np.float64)


def _add_resamples(code: np.ndarray, x: np.ndarray, units: np.ndarray, sums: np.ndarray) -> None:
    """Add to sums (group, 2, resample) the rows' weighted values and weights. A unit's weights serve all its rows."""
    n_boots = sums.shape[2]
    for first in range(0, len(sums), GROUPS_A_STEP):
        here = np.flatnonzero((code >= first) & (code < first + GROUPS_A_STEP))
        if not len(here):
            continue
        width = min(GROUPS_A_STEP, len(sums) - first)
        distinct, of = np.unique(units[here], return_inverse=True)
        for start in range(0, len(distinct), UNITS_A_STEP):
            own = here[(of >= start) & (of < start + UNITS_A_STEP)]
            place = of[(of >= start) & (of < start + UNITS_A_STEP)] - start
            part = distinct[start : start + UNITS_A_STEP]
            values = np.zeros((2, width, len(part)))
            np.add.at(values[0], (code[own] - first, place), x[own])
            np.add.at(values[1], (code[own] - first, place), 1.0)
            for b in range(0, n_boots, BOOTS_A_STEP):
                boots = np.arange(b, min(b + BOOTS_A_STEP, n_boots)) + 1
                w = poisson_weights(part, boots)
                for i in (0, 1):
                    sums[first : first + width, i, b : b + len(boots)] += values[i] @ w


def _weighted_sums(rows: DataFrame, keys: Sequence[str], n_boots: int) -> DataFrame:
    """keys, _b, _wx, _w: for each task's part of a group and each resample, sums of the weighted values and of the weights."""
    names = [*keys, "_b", "_wx", "_w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple, int] = {}
        firsts: list[list[pa.Array]] = []
        sums = np.zeros((0, 2, n_boots))

        def sent() -> Iterator[pa.RecordBatch]:
            again = pa.array(np.zeros(n_boots, dtype=np.int64))
            for first, (wx, w) in zip(firsts, sums):
                yield pa.RecordBatch.from_arrays([*(k.take(again) for k in first), pa.array(np.arange(n_boots) + 1), pa.array(wx), pa.array(w)], names)

        for t in batches:
            own = list(zip(*(t.column(k).to_pylist() for k in keys))) or [()] * t.num_rows
            x, units, start = t.column("_x").to_numpy(), t.column("_u").to_numpy(), 0
            while start < len(own):
                code = []
                for i in range(start, len(own)):
                    k = own[i]
                    if k not in codes:
                        if len(codes) == GROUPS_KEPT:
                            break
                        codes[k] = len(codes)
                        firsts.append([t.column(c).slice(i, 1) for c in keys])
                    code.append(codes[k])
                here = slice(start, start + len(code))
                sums = np.concatenate([sums, np.zeros((len(codes) - len(sums), 2, n_boots))])
                _add_resamples(np.array(code), x[here], units[here], sums)
                start += len(code)
                if start < len(own):
                    yield from sent()
                    codes, firsts, sums = {}, [], sums[:0]
        yield from sent()

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.select(*keys, "_x", "_u").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "_b long, _wx double, _w double"]))


def merged_bootstrap(stats: DataFrame, by: Sequence[str], stat: str, n_boots: int = 10_000, percent: float = 5.0, seed: int = 0, unit: Column | None = None, function: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """by, mean, low, high: percentile interval over resamples whose rows have Poisson weights (Chamandy et al. 2012).

    A row's weight in a resample is a hash of its unit (a whole number; the hash of the row if none is given), the resample
    and the seed, so weights are the same wherever the row is. Resamples are sums over rows: each task adds up its own, and
    only one row for each group, resample and task is shuffled. For the weighted mean, a unit's weights are worked out once
    for all its rows, as arrays. function(weight, value) gives another aggregate; null values are left out, and a group of
    only nulls has null bounds."""
    keys, x, w = list(by), F.col("_x"), F.col("_w")
    spark = stats.sparkSession
    one = F.try_divide(F.sum(w * x), F.sum(w)) if function is None else function(w, x)
    rows = stats.select(*keys, F.col(stat).cast("double").alias("_x"), (F.xxhash64(*stats.columns) if unit is None else unit).cast("long").alias("_u"))
    drawn = portable_mix(rows.where("_x IS NOT NULL"), F.pmod("_u", F.lit(_PRIME)) * 7919 + seed, "_u")
    if function is None:
        # a few parts for each core, as each sends a row for every group and resample
        parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
        summed = _weighted_sums(drawn.repartition(parts, "_u"), keys, n_boots)
        resampled = summed.groupBy(*keys, "_b").agg(F.try_divide(F.sum("_wx"), F.sum("_w")).alias("_m"))
    else:
        drawn = drawn.withColumn("_b", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n_boots).cast("long"))))
        drawn = portable_mix(drawn, F.col("_u") + F.col("_b") * 104_729, "_u")
        weight = F.lit(0)
        for c in POISSON:
            weight = weight + (F.col("_u") > int(c * _PRIME)).cast("int")
        # no filter on the weight: pushed down, it would write the hash out many times over
        drawn = drawn.withColumn("_w", weight)
        resampled = drawn.groupBy(*keys, "_b").agg(one.alias("_m"))
    # the resamples of a group are as many as asked for, whatever its rows
    ends = resampled.groupBy(*keys).agg(F.percentile("_m", F.array(F.lit(percent / 200), F.lit(1 - percent / 200))).alias("_p"))
    whole = rows.withColumn("_w", F.when(x.isNotNull(), 1).otherwise(0)).groupBy(*keys).agg(one.alias("mean"))
    a, b = whole.alias("a"), ends.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, same, "left").select(*[F.col(f"a.{k}") for k in keys], "mean", F.get("_p", 0).alias("low"), F.get("_p", 1).alias("high"))


def bootstrap(stats: DataFrame, by: Sequence[str], stat: str, n_boots: int = 10_000, percent: float = 5.0, seed: int = 0, function: Callable | None = None) -> DataFrame:
    """by, mean, low, high: percentile interval of the mean over resamples (merged_bootstrap), or of another function of an
    array and an axis, which need not merge: then a group, the sessions of one level and syllable, is resampled in one task,
    in steps of bounded size, seeded by its key."""
    if function is None:
        return merged_bootstrap(stats, by, stat, n_boots, percent, seed)
    keys = list(by)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(pdf[stat].dropna().to_numpy(dtype=float))
        if not len(x):
            return pd.DataFrame([[*key, None, None, None]], columns=[*keys, "mean", "low", "high"])
        rng = np.random.default_rng([seed, *map(int, np.frombuffer(repr(key).encode(), dtype=np.uint8))])
        step = max(1, 2_000_000 // len(x))
        means = np.concatenate([function(x[rng.integers(0, len(x), (min(step, n_boots - i), len(x)))], 1) for i in range(0, n_boots, step)])
        low, high = np.percentile(means, [percent / 2, 100 - percent / 2])
        return pd.DataFrame([[*key, float(function(x[None, :], 1)[0]), low, high]], columns=[*keys, "mean", "low", "high"])

    kinds = {f.name: f.dataType.simpleString() for f in stats.schema.fields}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", mean double, low double, high double"
    return stats.select(*keys, stat).groupBy(*keys).applyInPandas(one, schema)


def hashed_bootstrap(stats: DataFrame, by: Sequence[str], stat: str, order: Sequence[str], n_boots: int = 100, percent: float = 5.0, function: Callable[[Column], Column] | None = None) -> DataFrame:
    """The same interval with draws from an arithmetic hash, in SQL functions only: any SQL engine gives the same numbers.

    Draw i of resample b takes the value at place hash(b, i) of the group in the order given. function gives a resample's
    (an array's) statistic, the mean by default."""
    groups = stats.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(stat).alias("_v")))).alias("_s")).withColumn("_x", F.col("_s._v"))
    draws = groups.withColumn("_b", F.explode(F.sequence(F.lit(1), F.lit(n_boots))))
    pick = lambda i: F.get(F.col("_x"), F.pmod(F.pmod(F.col("_b").cast("long") * 7919 + i.cast("long") * 104_729, F.lit(2_147_483_647)) * 48_271, F.lit(1_000_003)) % F.size("_x"))
    total = F.aggregate(F.sequence(F.lit(1), F.size("_x")), F.lit(0.0), lambda s, i: s + pick(i))
    one = total / F.size("_x") if function is None else function(F.transform(F.sequence(F.lit(1), F.size("_x")), pick))
    means = draws.withColumn("_m", one)
    lo, hi = percent / 200, 1 - percent / 200
    return means.groupBy(*by).agg(F.percentile("_m", lo).alias("low"), F.percentile("_m", hi).alias("high"))


def long_form(stats: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, stat (the column's name), value: several statistics as rows, so that what takes one takes them all."""
    every = F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("value")) for c in columns])
    return stats.select(*keys, F.explode(every).alias("_s")).select(*keys, "_s.*")


def sort_by_stat(stats: DataFrame, stat: str) -> DataFrame:
    """syllable, value (mean over sessions), pos: descending by value, ties by syllable."""
    means = stats.groupBy("syllable").agg(F.avg(stat).alias("value"))
    return means.withColumn("pos", (F.row_number().over(Window.orderBy(F.desc("value"), "syllable")) - 1).cast("int"))


def sort_by_difference(stats: DataFrame, stat: str, control: str, experiment: str, group: str = "grp") -> DataFrame:
    """syllable, value (experiment's mean less control's), pos: descending."""
    mean = lambda g: F.avg(F.when(F.col(group) == g, F.col(stat)))
    diff = stats.groupBy("syllable").agg((mean(experiment) - mean(control)).alias("value"))
    return diff.withColumn("pos", (F.row_number().over(Window.orderBy(F.desc("value"), "syllable")) - 1).cast("int"))


def ordered_by(rows: DataFrame, order: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """pos of each row's syllable in an ordering, joined by syllable, never by row number; only the wanted ones, if given."""
    kept = rows if wanted is None else rows.join(F.broadcast(wanted.select("syllable")), "syllable", "left_semi")
    return kept.join(F.broadcast(order.select("syllable", "pos")), "syllable")


def threshold(stats: DataFrame, stat: str, low: float, high: float) -> DataFrame:
    return stats.where(F.col(stat).between(low, high))


def search(stats: DataFrame, info: DataFrame, text: str) -> DataFrame:
    """Statistics joined with the syllables' labels, of those whose label contains the text, in any case."""
    return stats.join(F.broadcast(info), "syllable").where(F.contains(F.lower("label"), F.lit(text.lower())))


def group_info(means: DataFrame, metrics: Sequence[str], group: str = "grp") -> DataFrame:
    """syllable, group_info: map of group to its metrics."""
    entry = F.struct(F.col(group), F.struct(*metrics))
    return means.groupBy("syllable").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("group_info"))
