"""Small hand-computed cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from etholake.functions import distributions, images, text
from etholake.operators import fingerprint, flips, hypothesis, quality, similarity
from etholake.operators import frames as fr
from etholake.operators import stats as st
from etholake.operators import transitions as tr
from etholake.sources import catalog, sessions
from etholake.streaming import bouts as stream

LABELS = [-5, -5, -5, 0, 0, 1, 1, 1, 0, 2]


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(1, "a", i, x, float(i)) for i, x in enumerate(LABELS)] + [(2, "b", i, x, 1.0) for i, x in enumerate([0, 1, 0, 1])]
    return spark.createDataFrame(rows, "uuid long, grp string, frame long, syllable int, v double")


def rows(d, *order):
    return [tuple(r) for r in (d.orderBy(*order) if order else d).collect()]


def test_bouts(frames):
    b = fr.bouts(fr.labelled(frames).where("uuid = 1"))
    assert rows(b.select("syllable", "start", "frames"), "start") == [(0, 3, 2), (1, 5, 3), (0, 8, 1), (2, 9, 1)]


def test_transitions(frames):
    e = tr.edges(tr.steps(fr.bouts(frames.where("uuid = 1"))))
    assert rows(e.select("src", "dst", "n"), "src", "dst") == [(0, 1, 1), (0, 2, 1), (1, 0, 1)]
    assert rows(tr.normalised(e, "rows").select("src", "dst", "p"), "src", "dst") == [(0, 1, 0.5), (0, 2, 0.5), (1, 0, 1.0)]
    assert tr.dense(tr.normalised(e), 3).count() == 9
    assert rows(tr.bidirectional(e).select("src", "dst"), "src") == [(0, 1), (1, 0)]
    with pytest.raises(ValueError):
        tr.normalised(e, "both")


def test_entropy(frames):
    got = {(r["grp"], r["syllable"]): r for r in tr.entropies(tr.steps(fr.bouts(frames))).collect()}
    assert got["a", 0]["ent_out"] == pytest.approx(1.0) and got["a", 1]["ent_out"] == 0


def test_usage_and_zero_fill(frames):
    s = st.behavioural_stats(fr.labelled(frames), ["uuid", "grp"], ("v",))
    assert rows(s.where("uuid = 1").select("syllable", "usage"), "syllable") == [(0, 0.5), (1, 0.25), (2, 0.25)]
    full = st.zero_filled(s, ["uuid", "grp"], fr.labelled(frames).select("syllable").distinct())
    assert rows(full.where("uuid = 2 AND syllable = 2").select("usage", "v_mean")) == [(0.0, 0.0)]
    with pytest.raises(ValueError):
        st.behavioural_stats(frames, ["uuid"], count="x")


def test_relabel(frames):
    assert rows(fr.usage_order(fr.labelled(frames)).select("syllable", "sorted_id"), "sorted_id") == [(0, 0), (1, 1), (2, 2)]
    assert fr.explained_cutoff(fr.labelled(frames), 90).first()[0] == 2


def test_bootstrap_is_seeded(spark):
    d = spark.createDataFrame([("a", 0, float(i)) for i in range(20)], "grp string, syllable int, usage double")
    a, b = (st.bootstrap(d, ["grp", "syllable"], "usage", 500).first() for _ in range(2))
    assert a == b and a["low"] < a["mean"] == 9.5 < a["high"]
    assert st.error_bars(d, "grp", "usage", "None").first()["error"] is None


def test_dropped_frames_units(spark):
    d = spark.createDataFrame([(u, i, i * step) for u, step in ((1, 33.3), (2, 0.0333)) for i in range(10)] + [(3, 0, 1.0)], "uuid int, frame long, ts double")
    got = dict(rows(quality.dropped_frames(d)))
    assert got[1] == pytest.approx(got[2]) == pytest.approx(abs(30 - 1 / 0.0333) / 30) and got[3] is None


def test_quality_counts_and_flags(spark):
    d = spark.createDataFrame([(1, 0.0, 0.0), (1, 10.0, 1.0), (1, 12.0, None), (2, 5.0, 5.0)], "uuid int, area double, speed double")
    c = quality.counts(d, "area", "speed", ("area", "speed"))
    assert rows(c, "uuid") == [(1, 3, 1, 1, 3, 0), (2, 1, 0, 0, 0, -1)]
    f = quality.flags(c, spark.createDataFrame([(1, 0.5)], "uuid int, dropped double"))
    assert [(r["missing"], r["dropped_frames"]) for r in f.orderBy("uuid").collect()] == [(True, True), (False, False)]
    assert tuple(quality.warnings(f).first()) == (2, 1)


def test_robust_outliers(spark):
    rng = np.random.default_rng(0)
    d = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(60, 2)))] + [(99, 30.0, -30.0)], "uuid int, x double, y double")
    got = {r["uuid"]: r["outlier"] for r in quality.robust_outliers(d, ("x", "y")).collect()}
    assert got[99] and sum(got.values()) <= 8
    assert not quality.robust_outliers(d.limit(2), ("x", "y")).where("outlier").count()


def test_tails():
    assert distributions.normal_tail(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert distributions.chi2_tail(5.991465, 2) == pytest.approx(0.05, abs=1e-6)
    assert distributions.chi2_tail(18.307038, 10) == pytest.approx(0.05, abs=1e-6)
    assert distributions.student_tail(2.228139, 10) == pytest.approx(0.05, abs=1e-6)


def test_hypothesis_with_ties(spark):
    d = spark.createDataFrame([("a", 0, x) for x in (1.0, 2.0, 2.0, 3.0)] + [("b", 0, x) for x in (2.0, 5.0, 6.0, 7.0)], "grp string, syllable int, usage double")
    assert rows(hypothesis.ranked(d, "usage").select("usage", "rank"), "usage", "rank")[:4] == [(1.0, 1.0), (2.0, 3.0), (2.0, 3.0), (2.0, 3.0)]
    u = hypothesis.pairwise(d, "usage", "a", "b", "Mann-Whitney").first()
    assert u["statistic"] == 2.0 and 0.05 < u["p"] < 0.1
    t = hypothesis.pairwise(d, "usage", "a", "b", "T-test").first()
    assert t["statistic"] == pytest.approx(-2.5980762) and t["p"] == pytest.approx(0.0408, abs=1e-3)
    k = hypothesis.kruskal(d, "usage").first()
    assert k["p"] == pytest.approx(math.erfc(math.sqrt(k["h"] / 2)))
    assert hypothesis.dunn(d, "usage").first()["z"] == pytest.approx(-math.sqrt(k["h"]))


def test_linkage(spark):
    d = spark.createDataFrame([(0, 1, 1.0), (0, 2, 5.0), (1, 2, 4.0)], "a int, b int, dist double")
    m = similarity.complete_linkage(d)
    assert rows(m.select("left", "right", "height", "size"), "step") == [(0, 1, 1.0, 2), (2, 3, 5.0, 3)]
    assert similarity.leaf_order(m) == [2, 0, 1]


def test_graph_grid():
    assert tr.graph_grid(["a", "b", "c", "b-a", "c-b", "c-a"], ["a", "b", "c"]) == [["a", "b-a", "c-b"], [None, "b", "c-a"], [None, None, "c"]]


@pytest.mark.parametrize("value, factor, out", [("#111111", -1, "111111"), ("#DF3C3C", 0.5, "#6f1e1e"), ("#52D24F", 1.6, "#83ff7e"), ("#4F75D2", 1, "#4f75d2"), ("#12", 1, "12")])
def test_colorscale(spark, value, factor, out):
    assert spark.createDataFrame([(value,)], "c string").select(text.colorscale(F.col("c"), factor)).first()[0] == out


def test_images(spark):
    d = spark.createDataFrame([(1, 0, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "uuid long, frame long, pixels array<double>")
    p = F.col("pixels")
    got = d.select(images.flip_x(p, 3), images.flip_y(p, 3), images.flip_xy(p)).first()
    assert got[0] == [3, 2, 1, 6, 5, 4] and got[1] == [4, 5, 6, 1, 2, 3] and got[2] == [6, 5, 4, 3, 2, 1]
    assert rows(flips.augmented(d, 3).select("kind", "label"), "kind") == [("none", 0.0), ("x", 1.0), ("xy", 1.0), ("y", 0.0)]


def test_ranges_once(spark):
    r = spark.createDataFrame([(1, False, 0, 4), (1, False, 2, 6), (1, True, 8, 8)], "uuid long, left boolean, start long, stop long")
    assert flips.selected(r).count() == 6 and flips.selected_total(r, 8).first()[1]


def test_smoothing(spark):
    d = spark.createDataFrame([(1, i, int(i == 4 or i > 6)) for i in range(12)], "uuid int, frame int, flip int")
    assert [r["flip"] for r in flips.smoothed(d, kernel=3).orderBy("frame").collect()] == [0] * 7 + [1] * 5


def test_heatmap_sums_to_one(frames):
    m = fingerprint.position_heatmap(frames, ["uuid"], "v", "frame", 5)
    assert all(r[1] == pytest.approx(1) for r in m.groupBy("uuid").agg(F.sum("pdf")).collect())
    h = fingerprint.histograms(frames, ("v",), 4, "full")
    assert all(r[1] == pytest.approx(1) for r in h.groupBy("uuid").agg(F.sum("share")).collect())


def test_index_round_trip(spark):
    doc = "files:\n- {uuid: u1, group: g, path: [/x/a.h5, /x/a.yaml], metadata: {SessionName: [012517], SubjectName: 7}}\n- {uuid: u2, path: []}\n"
    d = sessions.index_from_yaml(spark, doc)
    assert rows(d.select("uuid", "group", "SubjectName", "filename"), "uuid") == [("u1", "g", "7", "a.h5"), ("u2", "default", None, None)]
    again = sessions.index_from_yaml(spark, sessions.index_to_yaml(d))
    assert rows(again.select("uuid", "SubjectName"), "uuid") == [("u1", "7"), ("u2", None)]
    assert rows(sessions.with_groups(d, spark.createDataFrame([("u2", "new")], "uuid string, group string")).select("group"), "group") == [("g",), ("new",)]


def test_discovery(spark, tmp_path):
    for p in ("s1/depth.dat", "s2/a.avi", "s2/b.avi", "s2/ir.avi", "s3/x.txt"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_bytes(b"1")
    assert rows(sessions.find_sessions(spark, str(tmp_path)).select("name"), "name") == [("a.avi",), ("b.avi",), ("s1",)]


def test_upsert_and_sets(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert rows(sessions.upserted(old, new, "k"), "k") == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(sessions.upserted(old, new, "k", True), "k") == [("a", 1), ("b", 9), ("c", 3)]
    assert tuple(sessions.same_keys(old.where("k = 'a'"), old, "k").first()) == (True, False)


def test_progress(tmp_path):
    p = catalog.Progress()
    q = p.updated("model_path", "/m/model.p")
    assert q.snapshot != p.snapshot and q.updated("model_path", "/m/model.p") is q
    q.save(str(tmp_path / "p.json"))
    assert catalog.Progress.load(str(tmp_path / "p.json")) == q
    assert catalog.merged_config({"threads": 0}, {"fps": 30}) == {"fps": 30, "threads": 1}


def test_stream_equals_batch(spark, tmp_path):
    d = spark.createDataFrame([(1, f"2024-01-01 00:{m:02d}:00", 0) for m in (0, 5, 30, 31)], "uuid int, ts string, syllable int").withColumn("ts", F.to_timestamp("ts"))
    d.write.parquet(str(tmp_path / "in"))
    batch = rows(stream.usage_by_window(d, size="10 minutes"), "start")
    q = stream.usage_by_window(spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")), size="10 minutes").writeStream.outputMode("complete").format("memory").queryName("usage").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("usage"), "start") == batch
    assert stream.label_sessions(d).count() == 2
