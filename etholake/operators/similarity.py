"""Distances between syllables and their hierarchical clustering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("euclidean", "cosine")
#: Vectors of a block of a distance matrix.
BLOCK_ROWS = 512
#: Clustering is for the syllables of a model; more items than this are refused rather than gathered.
MOST_ITEMS = 2_000


def centroids(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key, dim, value: mean of each component."""
    return vectors.select(key, F.posexplode(vector).alias("dim", "_v")).groupBy(key, "dim").agg(F.avg("_v").alias("value"))


def _cell(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Distances of all rows of one block to all of another, over the components that both have (NaN: none); NaN without any."""
    out = np.full((len(left), len(right)), np.nan)
    for i, x in enumerate(left):
        both = ~np.isnan(x) & ~np.isnan(right)
        if metric == "euclidean":
            d = np.sqrt(np.where(both, (x - right) ** 2, 0.0).sum(1))
        else:
            dot, a, b = (np.where(both, v, 0.0).sum(1) for v in (x * right, np.broadcast_to(x * x, right.shape), right * right))
            with np.errstate(divide="ignore", invalid="ignore"):
                d = 1 - dot / (np.sqrt(a) * np.sqrt(b))
        out[i] = np.where(both.any(1), d, np.nan)
    return out


def pair_distances(components: DataFrame, key: str, metric: str = "euclidean", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """a, b, dist for a < b, from (key, dim, value): vectors are gathered once and dealt into blocks of about block_rows; each two
    blocks meet in one task as matrices. What is shuffled is a vector for each block, not a row for each pair and component.

    Components that only one of two items has do not count; items without a common one have no row."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    vectors = components.groupBy(F.col(key).alias("item")).agg(F.array_sort(F.collect_list(F.struct("dim", F.col("value").cast("double").alias("value")))).alias("v"))
    sized = vectors.sparkSession.sql("SELECT *, (SELECT greatest(1, ceil(count(*) / {n})) FROM {v}) AS blocks FROM {v}", v=vectors, n=int(block_rows))
    dealt = sized.withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    cells = dealt.select("item", "own", F.col("v.dim").alias("dims"), F.col("v.value").alias("values"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    kind = components.schema[key].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        own, dims = np.array(t.column("own")), t.column("dims").to_pylist()
        place = {d: i for i, d in enumerate(sorted({d for row in dims for d in row}))}
        x = np.full((t.num_rows, len(place)), np.nan)
        for row, ds, vs in zip(x, dims, t.column("values").to_pylist()):
            row[[place[d] for d in ds]] = [np.nan if v is None else v for v in vs]
        low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
        i, j = np.flatnonzero(own == low), np.flatnonzero(own == high)
        d = _cell(x[i], x[j], metric)
        if low == high:
            d[np.tril_indices(len(i))] = np.nan
        at = np.nonzero(~np.isnan(d))
        names = t.column("item").to_pylist()
        pairs = [(names[a], names[b]) for a, b in zip(i[at[0]].tolist(), j[at[1]].tolist())]
        first, second = ([f(p) for p in pairs] for f in (min, max))
        return pa.table({"a": pa.array(first, t.schema.field("item").type), "b": pa.array(second, t.schema.field("item").type), "dist": pa.array(d[at], pa.float64())})

    return cells.groupBy("low", "high").applyInArrow(run, f"a {kind}, b {kind}, dist double")


def complete_linkage(pairs: DataFrame) -> DataFrame:
    """step, left, right, height, size: merges of complete linkage over the pair list of a model's syllables.

    Items are numbered in order from 0; the k-th merge makes cluster n + k."""
    found = pairs.select("a", "b", "dist").limit(MOST_ITEMS * MOST_ITEMS // 2 + 1).collect()
    if len(found) > MOST_ITEMS * MOST_ITEMS // 2:
        raise ValueError(f"more than {MOST_ITEMS} items to cluster")
    items = sorted({x for r in found for x in (r["a"], r["b"])})
    at = {x: i for i, x in enumerate(items)}
    n = len(items)
    d = np.full((n, n), np.inf)
    for r in found:
        d[at[r["a"]], at[r["b"]]] = d[at[r["b"]], at[r["a"]]] = r["dist"]
    names, sizes, live, rows = list(range(n)), [1] * n, list(range(n)), []
    for step in range(n - 1):
        sub = d[np.ix_(live, live)]
        i, j = divmod(int(np.argmin(sub)), len(live))
        i, j = sorted((live[i], live[j]))
        lo, hi = sorted((names[i], names[j]))
        rows.append((step, lo, hi, float(d[i, j]), sizes[i] + sizes[j]))
        d[i] = d[:, i] = np.maximum(d[i], d[j])
        d[i, i] = np.inf
        sizes[i] += sizes[j]
        names[i] = n + step
        live.remove(j)
    return pairs.sparkSession.createDataFrame(rows, "step int, `left` int, `right` int, height double, size int")


def leaves(merges: DataFrame, share: float = 0.7) -> list[tuple[int, int]]:
    """(item, cluster) in dendrogram order: items that merge at under `share` of the last merge's height are one cluster."""
    rows = merges.orderBy("step").collect()
    n = len(rows) + 1
    kids = {n + r["step"]: (r["left"], r["right"], r["height"]) for r in rows}
    limit = share * rows[-1]["height"] if rows else 0.0
    order, cluster, todo = [], -1, [(n + len(rows) - 1, False)] if rows else [(0, False)]
    while todo:
        x, inside = todo.pop()
        if x in kids:
            left, right, height = kids[x]
            whole = inside or height < limit
            cluster += whole and not inside
            todo += [(right, whole), (left, whole)]
        else:
            cluster += not inside
            order.append((x, cluster))
    return order


def leaf_order(merges: DataFrame) -> list[int]:
    """Items in dendrogram order."""
    return [x for x, _ in leaves(merges)]


def leaf_labels(syllables: DataFrame, info: DataFrame | None) -> DataFrame:
    """'label-id' of each syllable; the id alone where there is no label."""
    if info is None:
        return syllables.withColumn("text", F.col("syllable").cast("string"))
    d = syllables.join(F.broadcast(info.select("syllable", "label")), "syllable", "left")
    return d.withColumn("text", F.concat_ws("-", F.when(F.length("label") > 0, F.col("label")), F.col("syllable").cast("string")))
