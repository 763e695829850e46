"""Distances by blocks, spring layouts and versioned data sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from etholake.operators import similarity
from etholake.operators import transitions as tr
from etholake.sources import versions


@pytest.mark.parametrize("metric", similarity.METRICS)
@pytest.mark.parametrize("block_rows", [3, 512])
def test_distances_by_blocks(spark, metric, block_rows):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(17, 5)) + 1e4 * (metric == "euclidean")
    rows = [(f"s{i}", d, float(x[i, d])) for i in range(17) for d in range(5) if (i, d) != (2, 1)] + [("lone", 9, 1.0)]
    got = {(r["a"], r["b"]): r["dist"] for r in similarity.pair_distances(spark.createDataFrame(rows, "k string, dim int, value double"), "k", metric, block_rows).collect()}
    want = {}
    for i in range(17):
        for j in range(17):
            if f"s{i}" < f"s{j}":
                a, b = (np.delete(x[k], 1) if 2 in (i, j) else x[k] for k in (i, j))
                want[f"s{i}", f"s{j}"] = np.linalg.norm(a - b) if metric == "euclidean" else 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    assert set(got) == set(want) and all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


def plain_layout(p, a, rounds):
    p, n = p.copy(), len(p)
    k, t = np.sqrt(1 / n), np.ptp(p, axis=0).max() * 0.1
    for r in range(rounds):
        delta = p[:, None] - p[None]
        far = np.maximum(np.linalg.norm(delta, axis=2), 0.01)
        f = np.einsum("ijk,ij->ik", delta, k * k / far**2 - a * far / k)
        p += f * (t * (1 - r / (rounds + 1)) / np.maximum(np.linalg.norm(f, axis=1), 0.01))[:, None]
    p -= p.mean(0)
    return p / np.abs(p).max()


def test_spring_layout(spark):
    nodes = spark.createDataFrame([("a", i) for i in range(6)] + [("b", i) for i in range(3)] + [("c", 4)], "grp string, syllable int")
    rows = [("a", 0, 1, 0.5), ("a", 1, 2, 0.3), ("a", 3, 4, 0.2), ("b", 0, 2, 0.9), ("b", 2, 0, 0.1)]
    e = spark.createDataFrame(rows, "grp string, src int, dst int, p double")
    got = {(r["grp"], r["syllable"]): (r["x"], r["y"]) for r in tr.spring_layout(nodes, e).collect()}
    start = {r["syllable"]: (r["x"], r["y"]) for r in spark.range(6).select(F.col("id").cast("int").alias("syllable")).withColumns({n: F.pmod(F.xxhash64("syllable", F.lit(0), F.lit(s)), F.lit(1_000_003)) / 1_000_003.0 for s, n in enumerate("xy")}).collect()}
    for g, n in (("a", 6), ("b", 3)):
        a = np.zeros((n, n))
        for h, s, d, p in rows:
            if h == g:
                a[s, d] = p
        assert np.array([got[g, i] for i in range(n)]) == pytest.approx(plain_layout(np.array([start[i] for i in range(n)]), a, 50), abs=1e-6)
    assert got["c", 4] == (0, 0)
    again = {(r["grp"], r["syllable"]): (r["x"], r["y"]) for r in tr.spring_layout(nodes.repartition(3), e).collect()}
    other = {(r["grp"], r["syllable"]): (r["x"], r["y"]) for r in tr.spring_layout(nodes, e, seed=3).collect()}
    assert again == got and other != got


def test_versions(spark, tmp_path):
    path = str(tmp_path / "angles")
    frames = spark.createDataFrame([(u, f, 0.0) for u in (1, 2) for f in range(3)], "uuid long, frame long, angle double")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.write(frames, path) == 1
    turned = frames.where("uuid = 2").select("uuid", "frame", F.lit(3.0).alias("angle"), F.lit(True).alias("flip"))
    assert versions.merge(turned, path, ["uuid", "frame"], insert=False) == 2
    rows = lambda v=None: sorted((r["uuid"], r["frame"], r["angle"]) for r in versions.read(spark, path, v).collect())
    assert rows() == [(u, f, 3.0 * (u - 1)) for u in (1, 2) for f in range(3)] and {a for _, _, a in rows(1)} == {0.0}
    assert versions.read(spark, path).columns == ["uuid", "frame", "angle", "flip"]
    assert versions.merge(spark.createDataFrame([(3, 0, 1.0)], "uuid long, frame long, angle double"), path, ["uuid", "frame"]) == 3
    assert len(rows()) == 7 and versions.versions(spark, path) == [1, 2, 3]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "set")
    versions.write(spark.range(4), path)
    with pytest.raises(Exception, match="boom"):
        versions.write(spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("boom")).cast("long")).alias("id")), path)
    assert versions.versions(spark, path) == [1] and versions.read(spark, path).count() == 4
    versions.write(spark.range(9), path, base=1)
    with pytest.raises(versions.VersionConflict):
        versions.write(spark.range(2), path, base=1)
    assert versions.read(spark, path).count() == 9
    assert len(versions.vacuum(spark, path)) >= 1 and versions.versions(spark, path) == [2] and versions.read(spark, path).count() == 9
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 1)
