"""Configurations and progress: small documents on the driver."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Endings of files that hold YAML.
YAML = (".yaml", ".yml")


def read_document(path: str) -> dict[str, Any]:
    """A configuration of YAML or, by any other ending, JSON; an empty file is an empty configuration."""
    text = Path(path).read_text()
    if not path.endswith(YAML):
        return json.loads(text) if text.strip() else {}
    import yaml

    return yaml.safe_load(text) or {}


def write_document(path: str, values: Mapping[str, Any]) -> None:
    """Written beside its place and renamed into it, so a reader never sees half of it."""
    if path.endswith(YAML):
        import yaml

        text = yaml.safe_dump(json.loads(json.dumps(values)), sort_keys=False, allow_unicode=True)
    else:
        text = json.dumps(values, indent=1, ensure_ascii=False)
    draft = Path(f"{path}.{uuid.uuid4().hex}")
    draft.write_text(text)
    os.replace(draft, path)


#: The keys of a progress file.
PROGRESS_KEYS = (
    "base_dir", "config_file", "session_config", "index_file", "train_data_dir", "pca_dirname", "scores_filename",
    "scores_path", "changepoints_path", "model_path", "crowd_dir", "syll_info", "plot_path",
)


#: Where a configuration names the files of scores and of change points.
CONFIG_PATHS = ("pca_file_scores", "changepoint_file")


@dataclass
class Progress:
    """Where a project's files are; each change gets a new snapshot."""

    paths: dict[str, str] = field(default_factory=lambda: dict.fromkeys(PROGRESS_KEYS, "TBD"))
    snapshot: str = field(default_factory=lambda: str(uuid.uuid4()))

    def updated(self, key: str, value: str) -> Progress:
        if not isinstance(value, str):
            raise TypeError("progress values are text")
        if self.paths.get(key) == value:
            return self
        return Progress({**self.paths, key: value})

    def save(self, path: str) -> None:
        write_document(path, {**self.paths, "snapshot": self.snapshot})

    @classmethod
    def load(cls, path: str) -> Progress:
        found = read_document(path)
        return cls({k: v for k, v in found.items() if k != "snapshot"}, found.get("snapshot", ""))

    @classmethod
    def generated(cls, path: str, files: DataFrame, config: Mapping[str, Any] | None = None) -> Progress:
        """A new progress file at path, from what a listing shows of its folder."""
        p = cls({**dict.fromkeys(PROGRESS_KEYS, ""), "base_dir": str(Path(path).parent), "plot_path": f"{Path(path).parent}/plots"}).found(files, config)
        p.save(path)
        return p

    @classmethod
    def restored(cls, path: str, files: DataFrame, config: Mapping[str, Any] | None = None, init: bool = False) -> Progress:
        """The progress file at path; a new one where init asks for it, or there is none."""
        return cls.load(path) if Path(path).is_file() and not init else cls.generated(path, files, config)

    def found(self, files: DataFrame, config: Mapping[str, Any] | None = None) -> Progress:
        """With the paths that a listing (path, modificationTime) of the base folder shows; what it does not show stays.

        Scores and change points are those that the configuration names, if the listing has them, else those of the PCA folder.
        Of several models the newest counts, with the descriptions and films beside it."""
        base, named = self.paths["base_dir"].rstrip("/"), dict(config or {})
        scores, changes = (named.get(k) for k in CONFIG_PATHS)
        path, model = F.regexp_replace("path", "^file:/*", "/"), F.endswith("path", F.lit(".p"))
        newest = files.where(model).agg(F.max_by(path, F.struct("modificationTime", "path"))).first()[0]
        folder = newest.rsplit("/", 1)[0] if newest else None
        wanted = {
            "config_file": f"{base}/config.yaml", "session_config": f"{base}/session_config.yaml", "index_file": f"{base}/moseq2-index.yaml",
            "_named_scores": scores, "_scores": f"{base}/_pca/pca_scores.h5", "_named_changes": changes, "_changes": f"{base}/_pca/changepoints.h5",
            "syll_info": folder and f"{folder}/syll_info.yaml",
        }
        folders = {"train_data_dir": f"{base}/aggregate_results/", "_pca": f"{base}/_pca/", "crowd_dir": folder and f"{folder}/crowd_movies/"}
        # one row: is there such a file, are there files in such a folder
        tests = [F.max(path == p).alias(k) for k, p in wanted.items() if p] + [F.max(F.startswith(path, F.lit(p))).alias(k) for k, p in folders.items() if p]
        there = {k for k, v in files.agg(*tests).first().asDict().items() if v}
        new = {k: p for k, p in {**wanted, **folders}.items() if k in there and not k.startswith("_")}
        score_file = scores if "_named_scores" in there else wanted["_scores"] if "_scores" in there else None
        if score_file:
            new |= {"scores_path": score_file, "pca_dirname": str(Path(score_file).parent), "scores_filename": Path(score_file).name}
        elif "_pca" in there:
            new |= {"pca_dirname": folders["_pca"], "scores_filename": "pca_scores"}
        change_file = changes if "_named_changes" in there else wanted["_changes"] if "_changes" in there else None
        if change_file:
            new["changepoints_path"] = change_file
        if newest:
            new["model_path"] = newest
        return self if all(self.paths.get(k) == v for k, v in new.items()) else Progress({**self.paths, **new})

    def suspicious(self, words: Mapping[str, str]) -> list[str]:
        """Keys whose path lacks the word expected of it."""
        return [k for k, w in words.items() if self.paths.get(k, "TBD") != "TBD" and w not in self.paths[k]]


def merged_config(user: Mapping[str, Any], defaults: Mapping[str, Any]) -> dict[str, Any]:
    """The user's values over the defaults; at least one thread."""
    out = {**defaults, **user}
    if "threads" in out:
        out["threads"] = max(1, int(out["threads"]))
    return out


#: What a configuration holds of these unless it says otherwise.
CONFIG_DEFAULTS = {"bg_roi_erode": [1, 1], "bg_roi_dilate": [1, 1], "threads": 8}


def read_config(path: str) -> dict[str, Any]:
    """A configuration with what it lacks from the defaults."""
    return merged_config(read_document(path), CONFIG_DEFAULTS)


@contextmanager
def editing(path: str) -> Iterator[dict[str, Any]]:
    """A configuration, YAML or JSON, that is written back at the end, also after an error."""
    config = read_document(path)
    try:
        yield config
    finally:
        write_document(path, config)


#: What a session's metadata hold where nothing is known.
METADATA_DEFAULTS = {"NidaqChannels": 0, "NidaqSamplingRate": 0.0, "DepthResolution": [512, 424], "ColorDataType": "Byte[]", "StartTime": ""}


def with_metadata_defaults(found: Mapping[str, Any] | None, folder: str = "", name: str = "") -> dict[str, Any]:
    """A session's metadata, with what is missing from the defaults; subject and session are named after its folder."""
    return {"SubjectName": Path(folder).name, "SessionName": name or Path(folder).name, **METADATA_DEFAULTS, **(found or {})}


def model_paths(models: list[str], chosen: str) -> dict[str, str]:
    """Where a chosen model's files are: its own folder, named after it."""
    if chosen not in models:
        raise ValueError(f"{chosen} is not among the models")
    folder = str(Path(chosen).with_suffix(""))
    return {"model_path": chosen, "plot_path": f"{folder}/plots", "crowd_dir": f"{folder}/crowd_movies", "syll_info": f"{folder}/syll_info.json", "index_file": f"{folder}/index.yaml"}
