"""Aliases, descriptions, aligned tables and what a user asks for in one call."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from etholake.functions import aliases
from etholake.operators import aligned as al
from etholake.operators import stats as st
from etholake.plans import tasks
from etholake.sources import catalog, descriptions, sessions


def rows(d, *order):
    return [tuple(r) for r in (d.orderBy(*order) if order else d).collect()]


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(3)
    out = []
    for u in range(8):
        labels = rng.integers(0, 4, 40)
        out += [(u, "ab"[u % 2], f"s{u}", f"m{u // 2}", i, int(x), float(x) + (u % 2) + 0.01 * u, float(i), i / 30) for i, x in enumerate(labels)]
    return spark.createDataFrame(out, "uuid long, grp string, SessionName string, SubjectName string, frame long, syllable int, v double, w double, ts double")


def test_aliases(spark):
    d = spark.createDataFrame([(1, 0.5, 2.0)], "syllable int, usage double, velocity_2d_mm_mean double")
    assert rows(aliases.aliased(d, aliases.DRAWN, "syllable")) == [(1, 0.5, None, 2.0, None, None, None)]
    assert aliases.column_of("2d velocity") == "velocity_2d_mm_mean"
    with pytest.raises(ValueError):
        aliases.column_of("speed")


def test_descriptions_round_trip(spark):
    info = descriptions.described(descriptions.initial(spark, 3), spark.createDataFrame([(1, "rear \"up\" é")], "syllable int, label string"))
    text = descriptions.document(info.withColumn("group_info", F.lit("left out")))
    assert "group_info" not in text and rows(descriptions.parsed(spark, text), "syllable") == [(0, "", "", ""), (1, 'rear "up" é', "", ""), (2, "", "", "")]
    assert rows(descriptions.parsed(spark, "3: {label: walk, group_info: {a: 1}}\n4: null")) == [(3, "walk", "", ""), (4, "", "", "")]


def test_saved_statistics_follow_their_size(spark, tmp_path):
    d = spark.createDataFrame([(0, 0.5)], "syllable int, usage double")
    descriptions.save_statistics(d, str(tmp_path), 10)
    assert rows(descriptions.saved_statistics(spark, str(tmp_path), 10)) == [(0, 0.5)]
    assert descriptions.saved_statistics(spark, str(tmp_path), 11) is None


def test_model_labels_and_scalars(spark):
    models = spark.createDataFrame([(1, [-5, 3]), (2, [])], "uuid long, labels array<int>")
    scalars = spark.createDataFrame([(1, 0, 0.1), (1, 1, 0.2), (1, 2, 0.3)], "uuid long, frame long, v double")
    assert rows(al.with_labels(scalars, al.model_labels(models)), "frame") == [(1, 0, 0.1, -5), (1, 1, 0.2, 3), (1, 2, 0.3, None)]


def test_batches_overlap(spark):
    d = al.batches(spark.range(10).select(F.lit(1).alias("uuid"), F.col("id").alias("frame")), 4, 1)
    got = {r["batch"]: r["f"] for r in d.groupBy("batch").agg(F.sort_array(F.collect_list("frame")).alias("f")).collect()}
    assert got == {0: [0, 1, 2, 3], 1: [3, 4, 5, 6], 2: [6, 7, 8, 9], 3: [9]}
    with pytest.raises(ValueError):
        al.batches(d, 4, 4)


def test_progress(spark):
    s = spark.createDataFrame([("a", "/a"), ("b", "/b"), ("c", "/c")], "name string, path string")
    e = spark.createDataFrame([("a", "/a/old.mp4", False), ("a", "/a/new.mp4", True), ("b", "/b/x.mp4", None)], "name string, path string, complete boolean")
    p = al.extraction_progress(s, e)
    assert rows(p, "name") == [("a", "/a/new.mp4", "extracted"), ("b", "/b/x.mp4", "incomplete"), ("c", "/c", "missing")]
    assert rows(al.progress_counts(p)) == [(3, 1, 1, 1)]


def test_node_vectors(spark):
    n = spark.createDataFrame([("a", 3), ("a", 1), ("a", 9)], "grp string, syllable int")
    s = spark.createDataFrame([("a", 1, float("nan")), ("a", 3, 0.5)], "grp string, syllable int, usage double")
    assert rows(al.node_vectors(n, s, ["usage"]).select("pos", "syllable", "usage"), "pos") == [(0, 1, 0.0), (1, 3, 0.5)]


def test_counter_and_colon(spark):
    r = spark.createDataFrame([(1, 0, 10, 1), (1, 5, 9, 2), (1, 9, 5, 3)], "uuid int, start long, stop long, at int")
    d = al.running_selected(r)
    assert rows(d.select("selected", al.number_after_colon(F.col("shown"))), "at") == [(10, 10), (14, 14), (14, 14)]
    assert rows(d.select(al.number_after_colon(F.lit("none"))).limit(1)) == [(None,)]


def test_best_model(spark):
    m = spark.createDataFrame([("x", 0.4, 0.2, -5.0), ("y", 0.9, 0.1, -9.0), ("z", None, None, None)], "model string, duration double, jsd double, median_loglikelihood double")
    assert [al.best_model(m, o, 0.5).first()["model"] for o in al.OBJECTIVES] == ["x", "y", "x"]
    for bad in (("speed", 1.0), ("duration", None)):
        with pytest.raises(ValueError):
            al.best_model(m, *bad)


def test_session_paths(spark):
    files = spark.createDataFrame([(p,) for p in ("/d/s1/depth.dat", "/d/s1/proc/r.mp4", "/d/s1/proc/r_flipped.mp4", "/d/s2/a_depth.dat", "/d/s2/b_depth.dat", "/d/s3/rgb.avi", "/d/s4/x.mkv")], "path string")
    assert rows(sessions.session_paths(files), "path") == [("/d/s1/depth.dat", "s1"), ("/d/s2/a_depth.dat", "a_depth.dat"), ("/d/s2/b_depth.dat", "b_depth.dat"), ("/d/s4/x.mkv", "s4")]
    assert rows(sessions.session_paths(files, True)) == [("/d/s1/proc/r.mp4", "s1")]
    assert rows(sessions.session_paths(files, True, True)) == [("/d/s1/proc/r_flipped.mp4", "s1")]
    a, b = (spark.createDataFrame(x, "name string, path string") for x in ([("s1", "/p/1.h5")], [("s1", "/a/1.h5"), ("s2", "/a/2.h5")]))
    names = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "name string")
    assert rows(sessions.resolved(names, a, b), "name") == [("s1", "/p/1.h5"), ("s2", "/a/2.h5")]


def test_project_state(spark):
    paths = ["/d/s1/depth.dat", "/d/s1/ir.dat", "/d/s1/metadata.json", "/d/s1/proc/results_00.h5", "/d/s1/proc/results_00.yaml", "/d/s2/depth.avi", "/d/s2/proc/results_00.h5", "/d/s3/x.mkv", "/d/s4/notes.txt", "/d/s5/proc/results_00.h5", "/d/s5/proc/results_00_flipped.mp4", "/d/_pca/pca.h5", "/d/models/m.p", "/d/models/m.txt"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["folder"]: tuple(r)[1:] for r in sessions.session_states(files).collect()}
    assert got == {"/d/s1": (1, True, True, True, False), "/d/s2": (1, False, True, False, False), "/d/s3": (1, False, False, False, False), "/d/s5": (0, False, True, False, True)}
    r = sessions.project_state(files).first()
    assert (r["sessions"], r["with_metadata"], r["extracted"], r["complete"], r["flipped"], r["models"]) == (4, 1, 3, 1, 1, 1) and r["pca"] and not r["changepoints"]
    assert sessions.project_state(files.limit(0)).first()["sessions"] == 0


def test_where_results_are(spark):
    paths = ["/p/a/depth.dat", "/p/a/proc/results_00.h5", "/q/b.h5", "/q/c.mp4", "/q/c.h5", "/q/d.mp4", "/q/e.h5"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    own = [("a", "/p/a/depth.dat"), ("b", "/q/b.h5"), ("c", "/q/c.mp4"), ("d", "/q/d.mp4"), ("e", "/q/e.mp4"), ("a_flipped", "/p/a/depth.dat"), ("gone", "/q/gone.h5")]
    got = rows(sessions.results_of(spark.createDataFrame(own, "name string, path string"), files), "name")
    assert got == [("a", "/p/a/proc/results_00.h5"), ("b", "/q/b.h5"), ("c", "/q/c.h5")]


def test_metadata_take_the_folder(spark):
    m = catalog.with_metadata_defaults({"StartTime": "now"}, "/data/mouse_7", "day1")
    assert (m["SubjectName"], m["SessionName"], m["StartTime"], m["NidaqChannels"]) == ("mouse_7", "day1", "now", 0)
    assert "session_config" in catalog.PROGRESS_KEYS and "model_session_path" not in catalog.PROGRESS_KEYS


def test_bootstrap_with_a_function(spark):
    d = spark.createDataFrame([("a", 0, float(i)) for i in range(50)], "grp string, syllable int, usage double")
    mean, most = (st.bootstrap(d, ["grp", "syllable"], "usage", 500, function=f).first() for f in (np.mean, np.max))
    assert mean["low"] < 24.5 < mean["high"] and mean["mean"] == 24.5 and most["mean"] == 49 and most["low"] > 40


def test_tasks(frames, tmp_path):
    checked = tasks.validate_extractions(frames, ["v", "w"], "w", "v")
    assert checked["flags"].count() == 8 and checked["outliers"].count() == 8 and checked["warnings"].count() == 1
    models = frames.groupBy("uuid").agg(F.array_sort(F.collect_list(F.struct("frame", "syllable")))["syllable"].alias("labels"))
    again = tasks.labelled_frames(frames.drop("syllable"), models, 3)
    assert {r[0] for r in again.select("syllable").distinct().collect()} == {0, 1, 2}
    s = tasks.syllable_stats(frames, ["v"], "v_mean", "a", "b", test="T-test")
    assert s["stats"].count() == 32 and s["bars"].count() == 8 and s["significant"].count() == 4
    with pytest.raises(ValueError):
        tasks.syllable_stats(frames, ["v"], test="T-test")
    g = tasks.transition_graphs(frames)
    assert {r["grp"] for r in g["edges"].collect()} == {"a", "b"} and g["nodes"].count() == g["vectors"].count() == 8 and g["differences"].count() > 0
    assert tasks.compare_positions(frames, "v", "w").count() > 0
    assert tasks.label_syllables(frames, frames.select("syllable").distinct())["info"].count() == 4
    assert tasks.dendrogram(frames.groupBy("syllable").agg(F.array(F.avg("v"), F.avg("w")).alias("x")), "syllable", "x").count() == 3


def test_tasks_take_the_users_choices(frames):
    every = tasks.transition_graphs(frames)
    few = tasks.transition_graphs(frames, usage=(0.3, 1.0), keep_orphans=True, layout="spring")
    assert few["edges"].count() < every["edges"].count()
    ends = {(r["grp"], s) for r in few["edges"].collect() for s in (r["src"], r["dst"])}
    alone = {(r["grp"], r["syllable"]) for r in few["orphans"].collect()}
    assert {(r["grp"], r["syllable"]) for r in few["nodes"].collect()} == ends | alone and not ends & alone
    anchored = tasks.transition_graphs(frames, p=(0.1, 1.0), anchor="a")
    shape = {(r["src"], r["dst"]) for r in tasks.transition_graphs(frames, p=(0.1, 1.0))["edges"].where("grp = 'a'").collect()}
    assert {(r["src"], r["dst"]) for r in anchored["edges"].collect()} == shape
    with pytest.raises(ValueError):
        tasks.transition_graphs(frames, layout="square")
    info = frames.select("syllable").distinct().withColumn("label", F.concat(F.lit("Run "), F.col("syllable").cast("string")))
    bars = tasks.syllable_stats(frames, ["v"], info=info, text="RUN 1")["bars"]
    assert {r["syllable"] for r in bars.collect()} == {1}
    assert tasks.syllable_stats(frames, ["v"], between=(2.0, 3.0))["bars"].count() == 0
    whole = tasks.label_syllables(frames, info)["examples"]
    some = tasks.label_syllables(frames, info, max_syllables=2, select_median_duration_instances=True)
    assert {r["syllable"] for r in some["examples"].select("syllable").distinct().collect()} == {r["syllable"] for r in whole.where("syllable < 2").select("syllable").distinct().collect()}
    assert some["info"].where("group_info IS NOT NULL").count() == 2
    moved = tasks.scalar_summary(frames, ["v"], frames.where("uuid = 1").select("uuid", F.lit("new").alias("grp")).distinct())
    assert {r["grp"] for r in moved.where("uuid = 1").collect()} == {"new"} and moved.where("grp <> 'new'").count() == 7
    with pytest.raises(ValueError):
        tasks.validate_extractions(frames, ["v", "w"], "w", "v", outliers="none")


def test_leaves_of_a_dendrogram(spark):
    at = {0: 0.0, 1: 10.0, 2: 0.5, 3: 10.4, 4: 30.0}
    d = spark.createDataFrame([(k, [x, 0.0]) for k, x in at.items()], "syllable int, x array<double>")
    info = spark.createDataFrame([(0, "rest"), (1, "")], "syllable int, label string")
    rows = tasks.dendrogram_leaves(d, "syllable", "x", info=info, color_by_cluster=True).orderBy("pos").collect()
    assert sorted(r["syllable"] for r in rows) == [0, 1, 2, 3, 4] and {r["syllable"]: r["text"] for r in rows}[0] == "rest-0"
    together = {}
    for r in rows:
        together.setdefault(r["cluster"], set()).add(r["syllable"])
    assert sorted(map(sorted, together.values())) == [[0, 1, 2, 3], [4]]
    assert [r["cluster"] for r in rows] == sorted(r["cluster"] for r in rows)
    assert tasks.dendrogram_leaves(d.where("syllable = 1"), "syllable", "x").collect()[0]["syllable"] == 1


def test_flip_classifier_on_separable_images(spark, tmp_path):
    """Images that are bright on one side are told apart, also after the model was written and read."""
    rng = np.random.default_rng(0)
    px = lambda: [float(10 * (c < 4) + rng.random()) for _ in range(8) for c in range(8)]
    images = spark.createDataFrame([(1, i, px()) for i in range(150)], "uuid long, frame long, pixels array<double>")
    ranges = spark.createDataFrame([(1, False, 0, 150)], "uuid long, left boolean, start long, stop long")
    model, accuracy = tasks.train_flip_classifier(images, ranges, 8, str(tmp_path / "model"))
    assert accuracy.first()["accuracy"] > 90
    from etholake.operators import flips

    turned = flips.apply(tasks.load_flip_classifier(str(tmp_path / "model")), images.withColumn("angle", F.lit(0.0)))
    assert turned.where("flip = 1").count() == 0
