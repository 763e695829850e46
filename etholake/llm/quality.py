"""Operator 9: quality rules and an isolation forest on their statistics.

Rule statistics are counted over whole texts. Documents that fail the base rules go; of the others, an isolation
forest (Liu, Ting and Zhou 2008) tells how soon random splits of the statistics isolate a document, and a threshold
calibrated on all labelled rows tells which path lengths are anomalous. The labels also weigh the statistics.

Texts are read once: their statistics are written, and ranges, medians, weights and the threshold come from aggregates of
Spark over the statistics of all labelled rows. Only the trees grow on fewer, as the method has it: TREES times SUBSAMPLE.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import WORD, chunks, mix64, written

_WORDS = re.compile(WORD)
SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
SPAN = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Trees, and rows that each of them grows on.
TREES, SUBSAMPLE = 100, 256
#: Bins of a step of the search for a rank, and bins for each doubling of a distance.
BINS, BINS_A_DOUBLING = 4_096, 64
FEATURES = 5
#: Weight, in the random choice of a split's statistic, of one that tells nothing of the labelled rows.
LEAST_WEIGHT = 0.02
#: Share of labelled good rows that the forest may reject at most.
MAX_FALSE = 0.005


def rule_stats(texts: list[str | None]) -> np.ndarray:
    """One row of STATS for each whole text; null counts as empty."""
    out = np.zeros((len(texts), len(STATS)), dtype=np.int64)
    for first, part in chunks(texts):
        words: list[str] = []
        ends = np.zeros(len(part) + 1, dtype=np.int64)
        for i, t in enumerate(part):
            if t:
                words += _WORDS.findall(t)
                lines = [x for x in t.split("\n") if x.strip(SPACES)]
                row = out[first + i]
                row[1] = len(t) - sum(map(t.count, SPACES))
                row[2] = sum(map(t.count, SYMBOLS))
                row[3], row[5] = len(lines) - len(set(lines)), len(lines)
            ends[i + 1] = len(words)
        out[first : first + len(part), 0] = np.diff(ends)
        out[first : first + len(part), 4] = _repeated(words, ends)
    return out


def _repeated(words: list[str], ends: np.ndarray) -> np.ndarray:
    """For each text, the words that lie in a window of SPAN words found twice or more in the text."""
    n = len(words)
    if n < SPAN:
        return np.zeros(len(ends) - 1, dtype=np.int64)
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.uint64) + np.uint64(1)
    codes = mix64(codes)
    h = np.zeros(n - SPAN + 1, dtype=np.uint64)
    for j in range(SPAN):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j : n - SPAN + 1 + j]
    text = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends))
    inside = text[: n - SPAN + 1] == text[SPAN - 1 :]
    h = mix64(h) ^ mix64(text[: n - SPAN + 1].astype(np.uint64) + np.uint64(0x51ED2701))
    at = np.flatnonzero(inside)
    at = at[pd.Series(h[at]).duplicated(keep=False).to_numpy()]
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + SPAN, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[ends[1:]] - covered[ends[:-1]]


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT_PERCENT * stats[:, 0])


def features(stats: np.ndarray) -> np.ndarray:
    """Rates, so that a long text is no anomaly for its length."""
    n, lines = np.maximum(stats[:, 0], 1.0), np.maximum(stats[:, 5], 1.0)
    return np.column_stack([stats[:, 1] / n, np.log1p(100 * stats[:, 2] / n), stats[:, 3] / lines, stats[:, 4] / n, np.log(np.minimum(n / lines, 200.0))])


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Trees as arrays; a leaf's value is its depth plus the mean path of the points left in it.

    Random cuts lie anywhere in a node's region, a part of the given box, so a branch may be empty: what falls there is
    isolated at once. So a statistic counts that is the same for all rows that the trees grow on. Statistics are chosen
    at random by the given weights."""

    def __init__(self, x: np.ndarray, box: np.ndarray | None = None, weights: np.ndarray | None = None, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.size = min(subsample, len(x))
        depth = int(np.ceil(np.log2(max(2, self.size))))
        box = np.array([x.min(0), x.max(0)]) if box is None and len(x) else box
        weights = np.ones(x.shape[1]) if weights is None else weights
        grow = lambda: self._grow(x[rng.choice(len(x), self.size, replace=False)], depth, box, weights / weights.sum(), rng)
        self.trees = [grow() for _ in range(trees)] if len(x) > 1 else []

    def _grow(self, x: np.ndarray, limit: int, box: np.ndarray, weights: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, value = [], [], [], []

        def node() -> int:
            for a, v in ((feature, -1), (cut, 0.0), (left, 0), (value, 0.0)):
                a.append(v)
            return len(feature) - 1

        todo = [(node(), x, box, 0)]
        while todo:
            k, part, region, depth = todo.pop()
            if depth >= limit or len(part) <= 1:
                value[k] = depth + float(_mean_path(len(part)))
                continue
            f = int(rng.choice(len(weights), p=weights))
            c = float(rng.uniform(region[0, f], region[1, f]))
            feature[k], cut[k], left[k] = f, c, node()
            under, low, high = part[:, f] <= c, region.copy(), region.copy()
            low[1, f] = high[0, f] = c
            todo += [(left[k], part[under], low, depth + 1), (node(), part[~under], high, depth + 1)]
        return np.array(feature), np.array(cut), np.array(left), np.array(value)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, higher: isolated sooner."""
        if not self.trees or not len(x):
            return np.full(len(x), 0.5)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                f = feature[at]
                at = np.where(inner, left[at] + (x[rows, np.maximum(f, 0)] > cut[at]), at)
            total += value[at]
        return np.exp2(-total / len(self.trees) / max(float(_mean_path(self.size)), 1e-9))


def _at_ranks(rows: DataFrame, ranks: dict[int, int]) -> dict[int, float]:
    """Of rows (f, v), for each f the value at a rank (from 0) in ascending order: exactly, by counts in ever finer bins."""
    v, found, span = F.col("v"), {}, {}
    for r in rows.where(F.col("f").isin(list(ranks))).groupBy("f").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        span[r["f"]] = (r["lo"], r["hi"], ranks[r["f"]])
    while span:
        found |= {f: lo for f, (lo, hi, _) in span.items() if lo == hi}
        span = {f: x for f, x in span.items() if f not in found}
        if not span:
            break
        parts = [rows.where((F.col("f") == f) & v.between(lo, hi)).select("f", "v", F.floor((v - lo) / (hi - lo) * BINS).alias("bin")) for f, (lo, hi, _) in span.items()]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionAll(p)
        bins: dict[int, list] = {}
        for r in whole.groupBy("f", "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            bins.setdefault(r["f"], []).append((r["bin"], r["n"], r["lo"], r["hi"]))
        for f, (_, _, k) in list(span.items()):
            for _, n, lo, hi in sorted(bins[f]):
                if k < n:
                    span[f] = (lo, hi, k)
                    break
                k -= n
    return found


def _weights(rows: DataFrame, medians: dict[int, float]) -> np.ndarray:
    """How well each statistic's distance from the good rows' median tells bad rows from good ones: twice the area under
    the curve less one, LEAST_WEIGHT at least. Of all rows; distances within about a hundredth of each other count as equal."""
    middle = F.element_at(F.create_map(*[F.lit(x) for f, m in medians.items() for x in (f, m)]), F.col("f"))
    away = F.abs(F.col("v") - middle)
    place = F.when(away > 0, F.floor(F.log2(F.greatest(away, F.lit(2.0**-60))) * BINS_A_DOUBLING)).otherwise(-(10**6))
    counts = rows.groupBy("f", place.alias("bin")).agg(F.count_if(F.col("y") == 0).alias("bad"), F.count_if(F.col("y") == 1).alias("good"))
    of = counts.toPandas().sort_values(["f", "bin"])
    out = np.ones(FEATURES)
    for f, g in of.groupby("f"):
        bad, good = g["bad"].to_numpy(dtype=float), g["good"].to_numpy(dtype=float)
        area = (bad * (np.cumsum(good) - good / 2)).sum() / (bad.sum() * good.sum())
        out[f] = max(LEAST_WEIGHT, 2 * area - 1)
    return out


class QualityModel:
    """Base rules, then the forest's verdict. Without labelled rows that pass the rules there is no threshold and the rules decide alone."""

    def __init__(self, forest: IsolationForest | None = None, threshold: float = np.inf) -> None:
        self.forest, self.threshold = forest, threshold

    def verdict(self, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, anomaly score, kept."""
        failed = base_failed(stats)
        s = self.forest.score(features(stats)) if self.forest is not None else np.full(len(stats), 0.5)
        return failed, s, ~failed & (s <= self.threshold)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of every row's whole text; a null text counts as empty; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = rule_stats(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(stats[:, i]) for i in range(len(STATS)))], ["doc_id", *STATS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATS))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in STATS]).astype(np.int64) if b.num_rows else np.zeros((0, len(STATS)), dtype=np.int64)


def fit_statistics(stats: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE) -> QualityModel:
    """Forest and threshold from all labelled rows (of statistics()) that pass the base rules."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    known = known.groupBy("_id").agg(F.min("_y").alias("y"))

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b)
            keep = ~base_failed(m)
            x = features(m[keep])
            y, h = (b.column(c).filter(pa.array(keep)) for c in ("y", "h"))
            yield pa.RecordBatch.from_arrays([y, h, *(pa.array(x[:, i]) for i in range(FEATURES))], ["y", "h", *names])

    names = [f"x{i}" for i in range(FEATURES)]
    some = stats.join(known, stats["doc_id"] == known["_id"]).select("y", F.xxhash64("_id").alias("h"), *STATS)
    x = written(some.mapInArrow(rates, "y int, h long, " + ", ".join(f"{c} double" for c in names)), "quality-labelled")
    row = x.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0), *(g(c) for g in (F.min, F.max) for c in names)).first()
    n_good, n_bad = row[:2]
    if n_good < 2:
        return QualityModel()
    lo, hi = np.array(row[2 : 2 + FEATURES]), np.array(row[2 + FEATURES :])
    weights = np.ones(FEATURES)
    if n_bad:
        long = x.select("y", F.posexplode(F.array(*names)).alias("f", "v"))
        medians = _at_ranks(long.where("y = 1").select("f", "v"), {i: (n_good - 1) // 2 for i in range(FEATURES)})
        weights = _weights(long, medians)
    # as many good rows as the trees take in all, drawn by a hash; they grow on good ones, so that a common kind of junk is
    # no part of the ordinary
    pool = x.where("y = 1").orderBy("h", *names).limit(TREES * SUBSAMPLE).select(*names).toPandas().to_numpy()
    forest = IsolationForest(pool, np.array([lo, np.where(hi > lo, hi, lo + 1)]), weights)

    def anomaly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = forest.score(np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in names]))
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(s)], ["y", "v"])

    scored = written(x.mapInArrow(anomaly, "y int, v double"), "quality-scored")
    rank = min(n_good - 1, int(np.ceil(n_good * (1 - max_false))))
    floor = _at_ranks(scored.where("y = 1").select(F.lit(0).alias("f"), "v"), {0: rank})[0]
    # among the thresholds that keep enough of the good: half-way from the good rows' edge to the next bad row above
    above = scored.where((F.col("y") == 0) & (F.col("v") > floor)).agg(F.min("v")).first()[0]
    return QualityModel(forest, floor + 1e-9 if above is None else (floor + above) / 2)


def judge_statistics(stats: DataFrame, model: QualityModel) -> DataFrame:
    """judge() of rows of statistics()."""
    names = ["doc_id", *STATS[:-1], "base_failed", "anomaly", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(b.column(c) for c in STATS[:-1]), *map(pa.array, model.verdict(_matrix(b)))], names)

    kind = stats.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATS[:-1]) + ", base_failed boolean, anomaly double, kept boolean"
    return stats.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Forest and threshold from all labelled rows."""
    return fit_statistics(statistics(docs), labels)


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, rule statistics, base_failed, anomaly and kept for every row. A null text counts as empty and fails the
    base rules; repeated rows are judged each; other columns are not read."""
    return judge_statistics(statistics(docs), model)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """judge() by fit() on the same rows, whose texts are read once."""
    stats = written(statistics(docs), "quality-statistics")
    return judge_statistics(stats, fit_statistics(stats, labels))
