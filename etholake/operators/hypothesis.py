"""Tests of whether groups differ in a statistic, syllable by syllable. Statistics come from SQL aggregates and ranks over
all sessions; p-values are computed on the result, one row per syllable or pair of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import p_chi2, p_normal, p_student
from .order import below

TESTS = ("Kruskal-Wallis", "Z-test", "T-test", "Mann-Whitney")


def value_ranks(stats: DataFrame, stat: str, group: str = "grp") -> DataFrame:
    """syllable, value, group, k (sessions of the group with the value), ties (of all groups), rank (ties averaged).

    Ranks come from counts of distinct values and sums of what lies below, so no task holds a syllable's sessions."""
    each = stats.where(F.col(stat).isNotNull()).groupBy("syllable", F.col(stat).cast("double").alias("value"), F.col(group)).agg(F.count("*").alias("k"))
    # a value has one entry for each group
    at = each.groupBy("syllable", "value").agg(F.sum("k").alias("ties"), F.collect_list(F.struct(group, "k")).alias("_g"))
    placed = below(at, ["syllable"], "value", "ties").withColumn("rank", F.col("below") + (F.col("ties") + 1) / 2)
    return placed.select("syllable", "value", "ties", "rank", F.explode("_g").alias("_g")).select("syllable", "value", "_g.*", "ties", "rank")


def ranked(stats: DataFrame, stat: str, group: str = "grp") -> DataFrame:
    """rank: of each row's value within its syllable, ties averaged; ties: how many share it. Rows without a value go."""
    at = value_ranks(stats, stat, group).select(F.col("syllable").alias("_s"), F.col("value").alias("_v"), "ties", "rank").distinct()
    return stats.join(at, (F.col("syllable") == F.col("_s")) & (F.col(stat).cast("double") == F.col("_v"))).drop("_s", "_v")


def _tie_term() -> Column:
    return F.sum(F.col("k") * (F.col("ties") * F.col("ties") - 1))


def kruskal(stats: DataFrame, stat: str, group: str = "grp", p_values: bool = True) -> DataFrame:
    """syllable, h (corrected for ties), groups, and p."""
    r = value_ranks(stats, stat, group)
    per = r.groupBy("syllable", group).agg(F.sum(F.col("rank") * F.col("k")).alias("_sum"), F.sum("k").alias("_n"), _tie_term().alias("_ties"))
    s = per.groupBy("syllable").agg(F.sum("_n").alias("n"), F.sum(F.col("_sum") * F.col("_sum") / F.col("_n")).alias("_q"), F.sum("_ties").alias("_t"), F.count("*").alias("groups"))
    n = F.col("n").cast("double")
    correction = 1 - F.col("_t") / F.nullif(n * n * n - n, F.lit(0.0))
    h = F.try_divide(12 / (n * (n + 1)) * F.col("_q") - 3 * (n + 1), correction)
    out = s.select("syllable", h.alias("h"), "groups", "n")
    return out.withColumn("p", p_chi2("h", F.col("groups").cast("double") - 1)) if p_values else out


def dunn(stats: DataFrame, stat: str, group: str = "grp", alpha: float = 0.05) -> DataFrame:
    """syllable, a, b (groups), z, p, adjusted (Holm over each syllable's pairs), is_sig."""
    r = value_ranks(stats, stat, group)
    per = r.groupBy("syllable", group).agg(F.sum(F.col("rank") * F.col("k")).alias("_sum"), F.sum("k").alias("k"), _tie_term().alias("t"))
    # a syllable has one entry for each group
    entry = F.struct(F.col(group).alias("g"), (F.col("_sum") / F.col("k")).alias("m"), F.col("k").alias("k"))
    whole = per.groupBy("syllable").agg(F.sum("k").cast("double").alias("n"), F.sum("t").alias("t"), F.array_sort(F.collect_list(entry)).alias("_g"))
    one = whole.select("syllable", "n", "t", "_g", F.posexplode("_g").alias("_i", "x"))
    pairs = one.select("syllable", "n", "t", "x", F.explode(F.expr("slice(_g, _i + 2, size(_g))")).alias("y")).select("syllable", "n", "t", F.col("x.g").alias("a"), F.col("y.g").alias("b"), F.col("x.m").alias("ma"), F.col("y.m").alias("mb"), F.col("x.k").alias("ka"), F.col("y.k").alias("kb"))
    spread = (F.col("n") * (F.col("n") + 1) / 12 - F.col("t") / (12 * F.nullif(F.col("n") - 1, F.lit(0.0)))) * (1 / F.col("ka") + 1 / F.col("kb"))
    z = F.try_divide(F.col("ma") - F.col("mb"), F.sqrt(spread))
    out = pairs.select("syllable", "a", "b", z.alias("z")).withColumn("p", p_normal("z"))
    by_p = Window.partitionBy("syllable").orderBy("p", "a", "b")
    m = F.count("*").over(Window.partitionBy("syllable"))
    out = out.withColumn("_step", F.least(F.lit(1.0), F.col("p") * (m - F.row_number().over(by_p) + 1)))
    out = out.withColumn("adjusted", F.max("_step").over(by_p.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")
    return out.withColumn("is_sig", F.coalesce(F.col("adjusted") < alpha, F.lit(False)))


def moments(stats: DataFrame, stat: str, a: str, b: str, group: str = "grp") -> DataFrame:
    """syllable, and count, mean and variance of either group."""
    of = lambda g: F.when(F.col(group) == g, F.col(stat))
    return stats.groupBy("syllable").agg(*[f(of(g)).alias(f"{n}_{x}") for x, g in (("a", a), ("b", b)) for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))])


def pairwise(stats: DataFrame, stat: str, a: str, b: str, test: str, group: str = "grp", alpha: float = 0.05, p_values: bool = True) -> DataFrame:
    """syllable, statistic, and p and is_sig (Holm over syllables) of a test of groups a and b."""
    if test not in TESTS[1:]:
        raise ValueError(f"test must be one of {TESTS[1:]}, not {test!r}")
    if test == "Mann-Whitney":
        r = value_ranks(stats.where(F.col(group).isin(a, b)), stat, group)
        first, k = F.col(group) == a, F.col("k")
        of = lambda f, x: F.coalesce(F.sum(F.when(f, x)), F.lit(0)).cast("double")
        s = r.groupBy("syllable").agg(F.sum(F.when(first, F.col("rank") * k)).alias("_r"), of(first, k).alias("_a"), of(~first, k).alias("_b"), _tie_term().alias("_t"))
        n, ab = F.col("_a") + F.col("_b"), F.col("_a") * F.col("_b")
        u = F.col("_r") - F.col("_a") * (F.col("_a") + 1) / 2
        spread = F.sqrt(ab / 12 * (n + 1 - F.try_divide(F.col("_t").cast("double"), n * (n - 1))))
        out = s.select("syllable", u.alias("statistic"), F.try_divide(u - ab / 2, spread).alias("_z"))
        p = p_normal("_z")
    else:
        m = moments(stats, stat, a, b, group)
        na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
        gap = F.col("mean_a") - F.col("mean_b")
        if test == "Z-test":
            value = F.try_divide(gap, F.sqrt(F.col("var_a") / na + F.col("var_b") / nb))
        else:
            pooled = F.try_divide((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b"), na + nb - 2)
            value = F.try_divide(gap, F.sqrt(pooled * (1 / na + 1 / nb)))
        out = m.select("syllable", value.alias("statistic"), (na + nb - 2).alias("_df"))
        p = p_normal("statistic") if test == "Z-test" else p_student("statistic", "_df")
    if not p_values:
        return out.select("syllable", "statistic")
    out = out.withColumn("p", p).select("syllable", "statistic", "p")
    # Holm's correction over the syllables: a small table, one row each
    order = Window.orderBy("p", "syllable")
    step = F.least(F.lit(1.0), F.col("p") * (F.count("p").over(Window.partitionBy()) - F.row_number().over(order) + 1))
    out = out.where("p IS NOT NULL").withColumn("_step", step).withColumn("adjusted", F.max("_step").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")
    return out.withColumn("is_sig", F.col("adjusted") < alpha)


def significant(stats: DataFrame, stat: str, test: str, a: str, b: str, group: str = "grp") -> DataFrame:
    """The syllables in which groups a and b differ."""
    if test == "Kruskal-Wallis":
        lo, hi = sorted((a, b))
        hit = kruskal(stats, stat, group).where("p < 0.05").select("syllable")
        return dunn(stats, stat, group).where((F.col("a") == lo) & (F.col("b") == hi) & F.col("is_sig")).join(hit, "syllable", "left_semi").select("syllable")
    return pairwise(stats, stat, a, b, test, group).where("is_sig").select("syllable")
