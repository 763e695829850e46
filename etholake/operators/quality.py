"""Quality of sessions: dropped frames, missing and odd values, and sessions unlike the others."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import chi2_quantile
from ..sources.scratch import cut
from .frames import session
from .order import percentiles
from .stats import long_form

FLAGS = ("missing", "size_anomaly", "stationary", "corrupted", "dropped_frames")


def dropped_frames(frames: DataFrame, ts: str = "ts", fps: float = 30.0, millis_over: float = 10.0) -> DataFrame:
    """uuid, dropped: how far the frame rate that the time stamps tell is from the nominal one, as a share of it.

    A mean step over `millis_over` is in milliseconds. A session of one frame has none."""
    step = frames.withColumn("_d", F.col(ts) - F.lag(ts).over(session())).groupBy("uuid").agg(F.avg("_d").alias("_d"))
    seconds = F.when(F.col("_d") > millis_over, F.col("_d") / 1000).otherwise(F.col("_d"))
    return step.select("uuid", (F.abs(fps - F.try_divide(F.lit(1.0), seconds)) / fps).alias("dropped"))


def counts(frames: DataFrame, area: str, speed: str, scalars: Sequence[str], slow: float = 0.1) -> DataFrame:
    """uuid, n, and numbers of frames with any NULL scalar, without area, with an area under twice its session's
    deviation, and slow (less one: the first frame's speed is 0)."""
    spread = F.stddev_samp(area).over(Window.partitionBy("uuid"))
    bad = F.lit(False)
    for c in scalars:
        bad = bad | F.col(c).isNull()
    return frames.withColumn("_spread", spread).groupBy("uuid").agg(
        F.count("*").alias("n"), F.count_if(bad).alias("nan_rows"), F.count_if(F.col(area) == 0).alias("missing_rows"),
        F.count_if(F.col(area) < 2 * F.col("_spread")).alias("small_rows"), (F.count_if(F.col(speed) < slow) - 1).alias("slow_rows"),
    )


def flags(counted: DataFrame, dropped: DataFrame, share: float = 0.05) -> DataFrame:
    """Per session, each flag's share of the frames and whether it is raised."""
    d = counted.join(dropped, "uuid", "left")
    parts = {"missing": "missing_rows", "size_anomaly": "small_rows", "stationary": "slow_rows", "corrupted": "nan_rows"}
    d = d.withColumns({f"{k}_pct": F.col(v) / F.col("n") for k, v in parts.items()} | {"dropped_frames_pct": F.col("dropped")})
    return d.withColumns({k: F.coalesce(F.col(f"{k}_pct") >= share, F.lit(False)) for k in FLAGS}).select("uuid", *[x for k in FLAGS for x in (f"{k}_pct", k)])


def warnings(flagged: DataFrame) -> DataFrame:
    """Sessions, and those with any flag raised."""
    raised = F.lit(False)
    for k in FLAGS:
        raised = raised | F.col(k)
    return flagged.agg(F.count("*").alias("sessions"), F.count_if(raised).alias("raised"))


def summary(frames: DataFrame, scalars: Sequence[str], keys: Sequence[str] = ("uuid", "grp")) -> DataFrame:
    """Mean and sample deviation of each scalar by session."""
    return frames.groupBy(*keys).agg(*[f(c).alias(f"{c}_{n}") for c in scalars for n, f in (("mean", F.avg), ("std", F.stddev_samp))])


def iqr_outliers(means: DataFrame, scalars: Sequence[str], factor: float = 1.5) -> DataFrame:
    """uuid, outlier: sessions with a mean outside the quartiles by `factor` times their distance; one row of quartiles."""
    q = means.agg(*[F.percentile(c, p).alias(f"{c}_{n}") for c in scalars for n, p in (("q1", 0.25), ("q3", 0.75))]).first()
    bad = F.lit(False)
    for c in scalars:
        lo, hi = q[f"{c}_q1"], q[f"{c}_q3"]
        if lo is not None:
            bad = bad | ~F.col(c).between(lo - factor * (hi - lo), hi + factor * (hi - lo))
    return means.select("uuid", F.coalesce(bad, F.lit(False)).alias("outlier"))


def _form(columns: Sequence[str], mean: np.ndarray, inverse: np.ndarray) -> Column:
    """The squared Mahalanobis distance."""
    gap = [F.col(c) - float(m) for c, m in zip(columns, mean)]
    total = F.lit(0.0)
    for i, a in enumerate(gap):
        for j, b in enumerate(gap[: i + 1]):
            total = total + a * b * float(inverse[i, j] * (1 if i == j else 2))
    return total


def _moments(rows: DataFrame, columns: Sequence[str], picks: Sequence[tuple[np.ndarray, Column]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(count, mean, covariance) of the rows that each condition picks: one pass of counts, sums and cross products about a
    point near the mean, added up from task to task."""
    d, aggs = len(columns), []
    for k, (near, wanted) in enumerate(picks):
        gap = [F.when(wanted, F.col(c) - float(m)) for c, m in zip(columns, near)]
        aggs += [F.count_if(wanted).alias(f"n{k}"), *[F.sum(g).alias(f"s{k}_{i}") for i, g in enumerate(gap)]]
        aggs += [F.sum(gap[i] * gap[j]).alias(f"p{k}_{i}_{j}") for i in range(d) for j in range(i + 1)]
    r, out = rows.agg(*aggs).first(), []
    for k, (near, _) in enumerate(picks):
        n = r[f"n{k}"]
        s = np.array([r[f"s{k}_{i}"] or 0.0 for i in range(d)]) / max(n, 1)
        p = np.array([[r[f"p{k}_{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(d)] for i in range(d)]) / max(n, 1)
        out.append((n, near + s, p - np.outer(s, s)))
    return out


def _inverse(cov: np.ndarray) -> tuple[float, np.ndarray] | None:
    """(log of the determinant, inverse), or nothing where the covariance is singular."""
    scale = np.sqrt(np.diag(cov))
    if not np.isfinite(cov).all() or (scale <= 0).any():
        return None
    r = cov / np.outer(scale, scale)
    sign, det = np.linalg.slogdet(r)
    if sign <= 0 or det < -30 * len(cov):
        return None
    return det + 2 * np.log(scale).sum(), np.linalg.inv(r) / np.outer(scale, scale)


def robust_outliers(means: DataFrame, scalars: Sequence[str], contamination: float = 0.1, rounds: int = 30) -> DataFrame:
    """uuid, distance, outlier: Mahalanobis distances under a robust covariance; the farthest share are outliers.

    The covariance is that of the half of all sessions at which concentration steps (Rousseeuw and Van Driessen 1999) end,
    from two fixed starts, of which the lesser determinant counts; then that of the sessions within its 97.5 % ellipsoid. A step
    is two passes over all sessions: the distance at the half's end, by order statistics, and sums over what is nearer; the
    driver has only these sums. Too few sessions, or a singular covariance: all are inliers, as are sessions without a value."""
    columns, d = list(scalars), len(scalars)
    rows = cut(means.select("uuid", *[F.col(c).cast("double").alias(c) for c in columns]), "session-means")
    none = rows.select("uuid", F.lit(0.0).alias("distance"), F.lit(False).alias("outlier"))
    whole = rows
    for c in columns:
        whole = whole.where(F.col(c).isNotNull() & ~F.isnan(c))
    quarters: dict[str, dict[float, float]] = {}
    for r in percentiles(long_form(whole, ["uuid"], columns), ["stat"], "value", (0.25, 0.5, 0.75)).collect():
        quarters.setdefault(r["stat"], {})[r["share"]] = r["value"]
    if not quarters:
        return none
    middle = np.array([quarters[c][0.5] for c in columns])
    ((n, mean, cov),) = _moments(whole, columns, [(middle, F.lit(True))])
    every = _inverse(cov)
    if n <= 2 * d or every is None:
        return none
    spread = np.array([(quarters[c][0.75] - quarters[c][0.25]) or np.sqrt(cov[i, i]) for i, c in enumerate(columns)])
    fits, best = [(middle, np.diag(1 / spread**2), np.inf), (mean, every[1], np.inf)], None
    share = ((n + d + 1) // 2 - 0.5) / (n - 1)
    for _ in range(rounds):
        forms = [_form(columns, m, inv) for m, inv, _ in fits]
        ends = {r["start"]: r["value"] for r in percentiles(whole.select(F.explode(F.array(*[F.struct(F.lit(k).alias("start"), f.alias("value")) for k, f in enumerate(forms)])).alias("x")).select("x.*"), ["start"], "value", (share,)).collect()}
        found, going = _moments(whole, columns, [(m, f <= ends[k]) for k, (f, (m, _, _)) in enumerate(zip(forms, fits))]), []
        for (_, m, c), (_, _, before) in zip(found, fits):
            inv = _inverse(c)
            if inv is None:
                continue
            if best is None or inv[0] < best[0]:
                best = (inv[0], m, inv[1])
            if inv[0] < before - 1e-12:
                going.append((m, inv[1], inv[0]))
        if not (fits := going):
            break
    if best is None:
        return none
    _, mean, inv = best
    raw = _form(columns, mean, inv)
    scale = percentiles(whole.select(F.lit(0).alias("k"), raw.alias("value")), ["k"], "value", (0.5,)).first()["value"] / chi2_quantile(0.5, d)
    ((_, near_mean, near_cov),) = _moments(whole, columns, [(mean, raw < chi2_quantile(0.975, d) * scale)])
    if (near := _inverse(near_cov)) is not None:
        mean, inv = near_mean, near[1]
    distance = _form(columns, mean, inv)
    limit = percentiles(whole.select(F.lit(0).alias("k"), distance.alias("value")), ["k"], "value", (1 - contamination,)).first()["value"]
    return rows.select("uuid", distance.alias("distance"), F.coalesce(distance > limit, F.lit(False)).alias("outlier"))
