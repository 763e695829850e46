"""Robust outliers against the same steps in plain numpy."""

import numpy as np
import pytest

from etholake.functions.distributions import chi2_quantile, chi2_tail
from etholake.operators import quality


def plain(x, contamination=0.1):
    n, d = x.shape
    h = (n + d + 1) // 2
    spread = np.subtract(*np.percentile(x, [75, 25], axis=0))
    starts = [(np.median(x, 0), np.diag(1 / spread**2)), (x.mean(0), np.linalg.inv(np.cov(x.T, bias=True)))]
    form = lambda m, inv: np.einsum("ij,jk,ik->i", x - m, inv, x - m)
    best = None
    for m, inv in starts:
        last = np.inf
        for _ in range(30):
            part = x[np.argsort(form(m, inv), kind="stable")[:h]]
            m, cov = part.mean(0), np.cov(part.T, bias=True)
            inv, det = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
            if best is None or det < best[0]:
                best = (det, m, inv)
            if det >= last - 1e-12:
                break
            last = det
    raw = form(*best[1:])
    near = x[raw < chi2_quantile(0.975, d) * np.median(raw) / chi2_quantile(0.5, d)]
    dist = form(near.mean(0), np.linalg.inv(np.cov(near.T, bias=True)))
    return dist, dist > np.percentile(dist, 100 * (1 - contamination))


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_as_plain(spark, shift):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 3)) @ rng.normal(size=(3, 3)) + shift
    x[:12] += [9.0, -7.0, 8.0]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(999, None, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "uuid long, a double, b double, c double").repartition(4)
    got = {r["uuid"]: r for r in quality.robust_outliers(d, ("a", "b", "c")).collect()}
    dist, bad = plain(x)
    assert [got[i]["outlier"] for i in range(150)] == bad.tolist() and bad[:12].all() and not got[999]["outlier"]
    assert [got[i]["distance"] for i in range(150)] == pytest.approx(dist.tolist(), rel=1e-4)


def test_nothing_to_compare(spark):
    schema = "uuid long, a double, b double"
    same = spark.createDataFrame([(i, 1.0, float(i)) for i in range(30)], schema)
    for d in (same, same.limit(0), spark.createDataFrame([(1, None, None)], schema), spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(30)], schema)):
        got = quality.robust_outliers(d, ("a", "b")).collect()
        assert len(got) == d.count() and not any(r["outlier"] for r in got)


def test_chi2_quantiles():
    for k in (1, 2, 3, 6):
        for p in (0.01, 0.5, 0.975):
            assert chi2_tail(chi2_quantile(p, k), k) == pytest.approx(1 - p)
    assert chi2_quantile(0.5, 2) == pytest.approx(2 * np.log(2))
