"""Configurations in YAML and JSON, and the life of a progress file."""

import datetime

import pytest

from etholake.sources import catalog


@pytest.mark.parametrize("name", ["c.yaml", "c.json"])
def test_configurations(tmp_path, name):
    path = str(tmp_path / name)
    catalog.write_document(path, {"fps": 30, "name": "Mäuse", "bg_roi_erode": (2, 2)})
    assert catalog.read_config(path) == {"fps": 30, "name": "Mäuse", "bg_roi_erode": [2, 2], "bg_roi_dilate": [1, 1], "threads": 8}
    with pytest.raises(KeyError), catalog.editing(path) as config:
        config["threads"] = 0
        raise KeyError("after the change")
    assert catalog.read_document(path)["threads"] == 0 and catalog.read_config(path)["threads"] == 1
    assert [p.name for p in tmp_path.iterdir()] == [name]


def test_empty_configuration(tmp_path):
    for name in ("c.yaml", "c.json"):
        (tmp_path / name).write_text("")
        assert catalog.read_config(str(tmp_path / name)) == catalog.CONFIG_DEFAULTS


def listing(spark, *paths):
    day = lambda i: datetime.datetime(2024, 1, 1 + i)
    return spark.createDataFrame([(p, day(i)) for i, p in enumerate(paths)], "path string, modificationTime timestamp")


def test_progress_is_found(spark):
    p = catalog.Progress({**dict.fromkeys(catalog.PROGRESS_KEYS, ""), "base_dir": "/b", "plot_path": "/kept"})
    files = listing(spark, "file:/b/config.yaml", "/b/moseq2-index.yaml", "/b/aggregate_results/x.h5", "/b/_pca/pca_scores.h5", "/b/m1/old.p", "/b/m1/syll_info.yaml", "/b/m2/new.p", "/b/m2/crowd_movies/a.mp4", "/elsewhere/session_config.yaml")
    q = p.found(files)
    assert q.snapshot != p.snapshot and q.found(files) is q
    assert q.paths == {
        "base_dir": "/b", "config_file": "/b/config.yaml", "session_config": "", "index_file": "/b/moseq2-index.yaml", "train_data_dir": "/b/aggregate_results/",
        "pca_dirname": "/b/_pca", "scores_filename": "pca_scores.h5", "scores_path": "/b/_pca/pca_scores.h5", "changepoints_path": "", "model_path": "/b/m2/new.p",
        "crowd_dir": "/b/m2/crowd_movies/", "syll_info": "", "plot_path": "/kept",
    }


def test_configured_paths_come_first(spark):
    p = catalog.Progress({**dict.fromkeys(catalog.PROGRESS_KEYS, ""), "base_dir": "/b"})
    files = listing(spark, "/b/_pca/pca_scores.h5", "/b/_pca/changepoints.h5", "/b/other/s.h5")
    got = p.found(files, {"pca_file_scores": "/b/other/s.h5", "changepoint_file": "/b/absent.h5"}).paths
    assert (got["scores_path"], got["scores_filename"], got["pca_dirname"], got["changepoints_path"]) == ("/b/other/s.h5", "s.h5", "/b/other", "/b/_pca/changepoints.h5")
    assert p.found(listing(spark, "/b/_pca/x")).paths["scores_filename"] == "pca_scores"
    assert p.found(files.limit(0)) is p


def test_generated_and_restored(spark, tmp_path):
    path, files = str(tmp_path / "progress.yaml"), listing(spark, f"{tmp_path}/model.p")
    first = catalog.Progress.restored(path, files)
    assert first.paths["model_path"] == f"{tmp_path}/model.p" and first.paths["plot_path"] == f"{tmp_path}/plots"
    assert catalog.Progress.restored(path, files) == first
    again = catalog.Progress.restored(path, files, init=True)
    assert again.paths == first.paths and again.snapshot != first.snapshot
