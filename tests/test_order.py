"""Ranks, percentiles, resamples and deviations that no task gathers, against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from etholake.functions import aliases
from etholake.operators import fingerprint, hypothesis, order
from etholake.operators import stats as st
from etholake.operators import transitions as tr
from etholake.sources import sessions

ODD = [0.0, -0.0, 1.0, 1.0, 1.0, -1.0, 2.0**-1074, -(2.0**-1074), 1e300, -1e300, 1.7e9, 1.7e9 + 1, 0.1, 0.1 + 1e-17, math.nextafter(0.1, 1), 3.0, 4.0, 8.0, 8.0, math.nextafter(8.0, 0), -8.0]


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(4)
    rows = [("odd", x) for x in ODD] + [("unit", rng.random()) for _ in range(500)] + [("ties", float(rng.randrange(6))) for _ in range(300)] + [("one", 5.0), ("null", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(3)


def plain(d):
    out = defaultdict(list)
    for r in d.collect():
        if r["v"] is not None:
            out[r["k"]].append(r["v"])
    return out


def test_below(values):
    counts = values.where("v IS NOT NULL").withColumn("v", F.col("v") + F.lit(0.0)).groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {(r["k"], r["v"]): r["below"] for r in order.below(counts, ["k"], "v", "n").collect()}
    want = {(k, v): sum(x < v for x in xs) for k, xs in plain(values).items() for v in xs}
    assert got == want


def test_percentiles(values):
    shares = (0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0)
    got = {(r["k"], r["share"]): r["value"] for r in order.percentiles(values, ["k"], "v", shares).collect()}
    want = plain(values)
    assert {k for k, _ in got} == set(want)
    for k, xs in want.items():
        for s in shares:
            assert got[k, s] == pytest.approx(np.percentile(xs, 100 * s), rel=1e-12, abs=1e-12), (k, s)


def test_ranks(spark):
    rng = random.Random(2)
    rows = [(s, "abc"[i % 3], float(rng.randrange(8)) if i % 9 else None) for s in range(3) for i in range(60)]
    d = spark.createDataFrame(rows, "syllable int, grp string, usage double")
    got = {(r["syllable"], r["value"], r["grp"]): (r["k"], r["ties"], r["rank"]) for r in hypothesis.value_ranks(d, "usage").collect()}
    for s in range(3):
        own = [(v, g) for t, g, v in rows if t == s and v is not None]
        at, ties = Counter(own), Counter(v for v, _ in own)
        for (v, g), k in at.items():
            assert got[s, v, g] == (k, ties[v], sum(x < v for x, _ in own) + (ties[v] + 1) / 2)
    assert len(got) == sum(len({(v, g) for t, g, v in rows if t == s and v is not None}) for s in range(3))


@pytest.mark.parametrize("shift", [0.0, 1.7e9, -1e12])
def test_deviation_of_large_values(spark, shift):
    """Sums of squares would cancel here."""
    rows = [(i % 4, "a", i // 4, (i // 8) % 2, shift + i % 60) for i in range(240)]
    d = spark.createDataFrame(rows, "uuid long, grp string, frame long, syllable int, v double").repartition(5)
    for by in (["grp"], ["uuid", "grp"]):
        for r in st.behavioural_stats(d, by, ("v",)).collect():
            xs = [v for u, g, _, s, v in rows if s == r["syllable"] and ("uuid" not in by or u == r["uuid"])]
            assert r["v_std"] == pytest.approx(np.std(xs, ddof=1), rel=1e-6)
            assert r["frames"] == len(xs) and r["duration"] == pytest.approx(len(xs) / r["bouts"] / 30)


def test_merged_bootstrap(spark):
    """Against the same weights in plain Python; where the rows lie does not matter."""
    m = 2_147_483_647
    once = lambda y: (y * y + 12_345 * y + 1_013_904_223) % m
    mix = lambda x: once((once(x % m) + 374_761_393) % m)
    rng = random.Random(1)
    rows = [(u, "ab"[u % 2], rng.random() if u % 7 else None) for u in range(40)] + [(99, "n", None)]
    d = spark.createDataFrame(rows, "uuid long, grp string, x double")
    got = {r["grp"]: r for r in st.merged_bootstrap(d.repartition(3), ["grp"], "x", 200, unit=F.col("uuid")).collect()}
    for g in "ab":
        own = [(u, x) for u, h, x in rows if h == g and x is not None]
        means = []
        for b in range(1, 201):
            w = [sum(mix(mix(u * 7919) + b * 104_729) > int(c * m) for c in st.POISSON) for u, _ in own]
            if sum(w):
                means.append(sum(k * x for k, (_, x) in zip(w, own)) / sum(w))
        low, high = np.percentile(means, [2.5, 97.5])
        assert (got[g]["mean"], got[g]["low"], got[g]["high"]) == pytest.approx((np.mean([x for _, x in own]), low, high))
        assert low < got[g]["mean"] < high
    assert got["n"]["mean"] is None and got["n"]["low"] is None
    most = {r["grp"]: r for r in st.merged_bootstrap(d.where("grp = 'a'"), ["grp"], "x", 50, unit=F.col("uuid"), function=lambda w, x: F.max(F.when(w > 0, x))).collect()}
    assert most["a"]["mean"] == max(x for _, g, x in rows if g == "a" and x is not None)
    other = st.merged_bootstrap(d, ["grp"], "x", 200, seed=5, unit=F.col("uuid")).where("grp = 'a'").first()
    assert other["low"] != got["a"]["low"]


def test_resamples_are_added_up_as_arrays(spark):
    """No row for each value and resample; weights are portable_mix's; more groups than a task keeps lose nothing."""
    rows = spark.createDataFrame([(u, g, u * 0.37 % 1) for u in range(30) for g in range(20)], "uuid long, grp long, x double")
    plan = st.merged_bootstrap(rows, ["grp"], "x", 100, unit=F.col("uuid"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    m = 2_147_483_647
    once = lambda y: (y * y + 12_345 * y + 1_013_904_223) % m
    want = [[sum(once((once((u + b * 104_729) % m) + 374_761_393) % m) > int(c * m) for c in st.POISSON) for b in (1, 2, 10_000)] for u in (0, 5, m - 1)]
    assert st.poisson_weights(np.array([0, 5, m - 1]), np.array([1, 2, 10_000])).tolist() == want
    d = spark.createDataFrame([(u, u % 600, float(u)) for u in range(1800)], "uuid long, grp long, x double").coalesce(1)
    got = {r["grp"]: r for r in st.merged_bootstrap(d, ["grp"], "x", 40, unit=F.col("uuid")).collect()}
    mixed = lambda f: {r["grp"]: r for r in st.merged_bootstrap(d, ["grp"], "x", 40, unit=F.col("uuid"), function=f).collect()}
    same = mixed(lambda w, x: F.try_divide(F.sum(w * x), F.sum(w)))
    assert len(got) == 600 and all((got[g]["low"], got[g]["high"]) == pytest.approx((same[g]["low"], same[g]["high"])) for g in same)


@pytest.mark.parametrize("smoothing", [0.0, 1.0, 0.25])
def test_entropy_of_smoothed_rows(spark, smoothing):
    rng = random.Random(3)
    rows = [(u, "ab"[u % 2], rng.randrange(4), rng.randrange(4)) for u in range(6) for _ in range(9)]
    k = 5
    got = {(r["grp"], r["syllable"]): (r["ent_out"], r["ent_in"]) for r in tr.entropies(spark.createDataFrame(rows, "uuid long, grp string, src int, dst int"), smoothing=smoothing, k=k).collect()}
    for g in "ab":
        for s in range(k):
            for side in (0, 1):
                each = []
                for u in {r[0] for r in rows if r[1] == g}:
                    m = np.full((k, k), smoothing)
                    for r in rows:
                        if r[0] == u:
                            m[r[2], r[3]] += 1
                    row = m[s] if side == 0 else m[:, s]
                    if row.sum():
                        p = row[row > 0] / row.sum()
                        each.append(-(p * np.log2(p)).sum())
                if each:
                    assert got[g, s][side] == pytest.approx(np.mean(each))
                else:
                    assert (g, s) not in got or got[g, s][side] is None
    with pytest.raises(ValueError):
        tr.entropies(spark.createDataFrame(rows, "uuid long, grp string, src int, dst int"), smoothing=1.0)


def test_smoothed_shares(spark):
    e = spark.createDataFrame([("a", 0, 1, 3), ("a", 1, 0, 1)], "grp string, src int, dst int, n long")
    p = {how: {(r["src"], r["dst"]): r["p"] for r in tr.normalised(e, how, smoothing=1.0, k=2).collect()} for how in tr.NORMALISATIONS}
    assert p == {"bigram": {(0, 1): 0.5, (1, 0): 0.25}, "rows": {(0, 1): 0.8, (1, 0): pytest.approx(2 / 3)}, "columns": {(0, 1): 0.8, (1, 0): pytest.approx(2 / 3)}}


def test_colours_of_differences(spark):
    e = spark.createDataFrame([("b-a", 0, 1, 0.5, 0.5), ("b-a", 1, 0, -0.5, -0.5)], "series string, src int, dst int, p double, usage double")
    assert [r["colour"] for r in tr.edge_style(e, True).orderBy("src").collect()] == ["blue", "red"]
    assert [r["colour"] for r in tr.node_style(e, True).orderBy("src").collect()] == ["blue", "red"]
    assert {r["colour"] for r in tr.node_style(e).collect()} == {"red"}
    assert aliases.SHOWN["distance to center"] == "dist_to_center_px_mean"


def test_infra_red_films_go_by_any_name(spark):
    files = spark.createDataFrame([("s/depth.dat", None, 1), ("t/my_ir.dat", None, 1), ("t/ir.avi", None, 1), ("u/a.ir.avi", None, 1)], "path string, modificationTime timestamp, length long")
    assert [r["path"] for r in sessions.name_sessions(files, ["dat", "avi"]).collect()] == ["s/depth.dat"]


def test_ranges_of_histograms(spark):
    rng = random.Random(8)
    xs = [rng.gauss(0, 1) for _ in range(400)]
    d = spark.createDataFrame([(i % 3, x, None) for i, x in enumerate(xs)], "uuid long, a double, b double")
    got = fingerprint.histograms(d, ("a", "b"), 10)
    lo, hi = np.percentile(xs, [1, 99])
    want = Counter((i % 3, min(int((x - lo) / (hi - lo) * 10), 9)) for i, x in enumerate(xs) if lo <= x <= hi)
    n = Counter(i % 3 for i in range(400))
    assert {(r["uuid"], r["bin"]): r["share"] for r in got.where("scalar = 'a'").collect()} == {k: pytest.approx(v / n[k[0]]) for k, v in want.items()}
    assert got.where("scalar = 'b'").count() == 0
    assert math.isfinite(lo)
